"""Every registered query against its DuckDB twin (the driver's correctness gate).

Runs on sf0.001 by default; set ORACLE_SF_DIR=/root/testdata/sf0.01 to check at
the driver's scale.
"""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from clinlake.oracle_sql import ORACLE_SQL  # noqa: E402
from clinlake.plans.queries import QUERIES  # noqa: E402
from oracle_check import compare  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

SF_DIR = os.environ.get("ORACLE_SF_DIR", SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    rep = compare(spark, SF_DIR, [name], verbose=False)[name]
    assert rep["ok"], rep
    assert not rep["type_diff"], rep["type_diff"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["condition_category", "is_survivor", "patient_count", "total_group_population", "rate_percentage"]
    assert df.count() > 0
