"""Full history of a table that is loaded again and again, in plain tables.

Every load brings a whole snapshot. A row's lifetime is an interval of loads
[valid_from, valid_to); snapshots are bags, so each distinct row is kept once
with the number of its copies. Two tables hold the history of ``name``:

* ``<name>_open``: the rows of the last load, with ``copies``, ``valid_from``
  and ``load`` (the load that wrote it), refreshed as a whole by every load;
* ``<name>_closed``: rows that ended, partitioned by ``valid_to``; a load
  writes its own partition and touches no other.

A load writes the closed partition first and then refreshes the open table,
which is one catalog change. Readers count a closed partition only up to the
load that the open table is from, so a load that fails in between leaves the
history as it was, and doing it again replaces the same partition.

The snapshot and the open table meet in one aggregate by all columns of a row
(NULLs are equal): one shuffle of distinct rows and numbers, no join, no sort. A
row that a third of the snapshot repeats leaves each map task once. Tables and
the scratch copy hold the rows' own columns and numbers, compressed by zstd.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinlake.session import delete_path, scratch_path
from clinlake.sources import catalog

OWN = ["copies", "valid_from", "load", "valid_to"]
_NOW, _BEFORE, _SINCE = "__copies_now", "__copies_before", "__valid_from"
_COMPRESSED = {"compression": "zstd"}


def _met(snapshot: DataFrame, open_rows: DataFrame | None) -> DataFrame:
    """Every distinct row of the snapshot and of the open table: its columns, its copies
    now (0: none) and before (NULL: none), and since which load the open table has it."""
    columns, none = snapshot.columns, F.lit(None).cast("bigint")
    rows = snapshot.select(*columns, F.lit(1).cast("bigint").alias(_NOW), none.alias(_BEFORE), none.alias(_SINCE))
    if open_rows is not None:
        rows = rows.union(open_rows.select(*columns, F.lit(0).cast("bigint").alias(_NOW), F.col("copies").alias(_BEFORE),
                                           F.col("valid_from").alias(_SINCE)))
    return rows.groupBy(*columns).agg(F.sum(_NOW).alias(_NOW), F.max(_BEFORE).alias(_BEFORE), F.max(_SINCE).alias(_SINCE))


def last_load(spark: SparkSession, name: str) -> int | None:
    """The last complete load; None before the first."""
    if not spark.catalog.tableExists(f"{name}_open"):
        return None
    found = spark.table(f"{name}_open").agg(F.max("load")).first()[0]
    if found is None and spark.catalog.tableExists(f"{name}_closed"):  # the last snapshot was empty
        found = spark.table(f"{name}_closed").agg(F.max("valid_to")).first()[0]
    return 0 if found is None else int(found)


def record_load(snapshot: DataFrame, name: str, load: int, path: str | None = None) -> dict[str, int]:
    """Take ``snapshot`` as load number ``load`` (ascending, 1 at least) of the history
    ``name``; returns the numbers of distinct rows opened, closed and unchanged.

    The columns of the snapshots may not change nor be named as the history's own."""
    spark, columns = snapshot.sparkSession, snapshot.columns
    clash = sorted({c.lower() for c in columns} & set(OWN))
    if clash:
        raise ValueError(f"{name}: the history has its own columns {clash}")
    before = last_load(spark, name)
    if load <= (before or 0):
        raise ValueError(f"{name}: load {load} does not follow load {before}")
    opened, closed = f"{name}_open", f"{name}_closed"
    open_rows = None
    if before is not None:
        open_rows = spark.table(opened)
        if open_rows.columns != [*columns, "copies", "valid_from", "load"]:
            raise ValueError(f"{name}: its columns are {open_rows.columns}, not {columns}")
    met, staged = _met(snapshot, open_rows), None
    if open_rows is not None:  # both tables come from it: the rows meet once
        staged = scratch_path(spark, "history")
        met.write.options(**_COMPRESSED).parquet(staged)
        met = spark.read.schema(met.schema).parquet(staged)
    same = F.col(_NOW).eqNullSafe(F.col(_BEFORE))
    ends = F.col(_BEFORE).isNotNull() & ~same
    ended = met.filter(ends).select(*columns, F.col(_BEFORE).alias("copies"), F.col(_SINCE).alias("valid_from"), F.lit(load).cast("bigint").alias("valid_to"))
    current = met.filter(F.col(_NOW) > 0).select(
        *columns, F.col(_NOW).alias("copies"), F.when(same, F.col(_SINCE)).otherwise(F.lit(load)).cast("bigint").alias("valid_from"),
        F.lit(load).cast("bigint").alias("load"))
    if spark.catalog.tableExists(closed):  # what a failed attempt at this load may have left
        spark.sql(f"ALTER TABLE {closed} DROP IF EXISTS PARTITION (valid_to = {load})")
    folder = f"{path.rstrip('/')}/{name.rsplit('.', 1)[-1]}" if path else None
    if staged and not ended.isEmpty():
        catalog.overwrite_partitions(ended, closed, ["valid_to"], path=folder and f"{folder}_closed", options=_COMPRESSED)
    rows = catalog.write_table(current, opened, path=folder and f"{folder}_open", options=_COMPRESSED)
    if not staged:
        return {"opened": rows, "closed": 0, "unchanged": 0}
    counts = met.agg(F.count_if(same).alias("unchanged"), F.count_if(ends).alias("closed")).first()
    delete_path(spark, staged)
    return {"opened": rows - counts["unchanged"], "closed": counts["closed"], "unchanged": counts["unchanged"]}


def lifetimes(spark: SparkSession, name: str) -> DataFrame:
    """Every distinct row of every complete load: its columns, copies, valid_from and valid_to (NULL: still there)."""
    last = last_load(spark, name)
    if last is None:
        raise RuntimeError(f"{name} has no load")
    now = spark.table(f"{name}_open")
    columns = [c for c in now.columns if c not in OWN]
    out = now.select(*columns, "copies", "valid_from", F.lit(None).cast("bigint").alias("valid_to"))
    if spark.catalog.tableExists(f"{name}_closed"):
        ended = spark.table(f"{name}_closed").filter(F.col("valid_to") <= last)  # a partition filter
        out = out.unionByName(ended.select(*columns, "copies", "valid_from", "valid_to"))
    return out


def as_of(spark: SparkSession, name: str, load: int) -> DataFrame:
    """The snapshot as ``load`` brought it, copies and all."""
    alive = lifetimes(spark, name).filter((F.col("valid_from") <= load) & (F.col("valid_to").isNull() | (F.col("valid_to") > load)))
    columns = [c for c in alive.columns if c not in OWN]
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("__copy")
    return alive.select(*columns, copy).drop("__copy")


def changes(spark: SparkSession, name: str, load: int, keys: Sequence[str]) -> DataFrame:
    """The keyed change set of a load: keys, change (insert, update or delete) and the
    rows that ended and that began. A key is updated if rows of it ended and others
    began or stayed. NULL keys are one key."""
    rows = lifetimes(spark, name)
    begun, ended = F.col("valid_from") == load, F.coalesce(F.col("valid_to") == load, F.lit(False))
    alive = (F.col("valid_from") <= load) & (F.col("valid_to").isNull() | (F.col("valid_to") > load))
    there = (F.col("valid_from") < load) & (F.col("valid_to").isNull() | (F.col("valid_to") >= load))

    def copies(of: Column) -> Column:
        return F.sum(F.when(of, F.col("copies")).otherwise(0))

    by_key = rows.groupBy(*keys).agg(copies(ended).alias("rows_ended"), copies(begun).alias("rows_begun"),
                                     F.max(alive).alias("now"), F.max(there).alias("before"))
    kind = F.when(~F.col("before"), "insert").when(~F.col("now"), "delete").otherwise("update")
    return by_key.filter("rows_ended + rows_begun > 0").select(*keys, kind.alias("change"), "rows_ended", "rows_begun")
