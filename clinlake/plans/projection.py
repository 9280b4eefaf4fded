"""Typed projection of a source table by a declared column table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clinlake.functions.identifiers import normalize_gender, normalize_identifier
from clinlake.functions.temporal import as_date, as_decimal, as_string, as_timestamp

#: How a column of each kind is typed, and its type where the source has none.
KINDS: dict[str, tuple[Callable[[DataFrame, str], Column], str]] = {
    "text": (as_string, "string"),
    "key": (lambda df, name: normalize_identifier(as_string(df, name)), "string"),
    "gender": (lambda df, name: normalize_gender(as_string(df, name)), "string"),
    "date": (as_date, "date"),
    "time": (as_timestamp, "timestamp_ntz"),
    "money": (lambda df, name: as_decimal(df, name, 12, 2), "decimal(12,2)"),
    "degrees": (lambda df, name: as_decimal(df, name, 10, 6), "decimal(10,6)"),
}


@dataclass(frozen=True)
class Field:
    """A cleaned column: its source name (or names, the first present is taken),
    its kind, whether rows without it are dropped, and whether the source may
    lack it (then it is a typed NULL)."""

    name: str
    source: str | tuple[str, ...]
    kind: str = "text"
    required: bool = False
    optional: bool = False


def project(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """``df`` as the declared columns; source names are matched without regard to case."""
    present = {c.lower(): c for c in reversed(df.columns)}

    def column(f: Field) -> Column:
        names = (f.source,) if isinstance(f.source, str) else f.source
        found = next((present[n] for n in names if n in present), None)
        convert, missing_type = KINDS[f.kind]
        if found is None and not f.optional:
            raise ValueError(f"no column {' / '.join(names)} for {f.name} among {df.columns}")
        return F.lit(None).cast(missing_type) if found is None else convert(df, found)

    typed = df.select(*[column(f).alias(f.name) for f in fields])
    needed = [F.col(f.name).isNotNull() for f in fields if f.required]
    return typed.filter(reduce(lambda a, b: a & b, needed)) if needed else typed
