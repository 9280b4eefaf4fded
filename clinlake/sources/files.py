"""File sources and sinks: CSV (declared schema + header map) and Parquet."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from clinlake import schemas
from clinlake.functions.temporal import as_date, as_decimal, as_string, as_timestamp


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names absent from ``df`` are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


#: Larger than any file: a file is one split and a split one file.
_WHOLE_FILE = str(1 << 59)


def _headers(spark: SparkSession, path: str) -> dict[str, tuple[str, ...]]:
    """The header of every file under ``path``, in one job: a task for each file
    gives its first line that is not blank (numbered 0 in its task)."""
    own = spark.newSession()  # these settings are for this read only
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(key, _WHOLE_FILE)

    lines = own.read.text(path).filter(F.btrim("value", F.lit("\ufeff \t\r")) != "")
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    found = lines.filter(F.col("at").bitwiseAND((1 << 33) - 1) == 0).collect()  # a line for each file

    def names(line: str) -> tuple[str, ...]:
        row = next(csv.reader([line.removeprefix("\ufeff")], escapechar="\\"))
        return tuple(name or f"_c{i}" for i, name in enumerate(row))  # by position: Spark would rename doubled headers

    return {unquote(r["file"]): names(r["value"]) for r in sorted(found, key=lambda r: r["file"])}


#: The column that tells a row's file, where it is asked for.
_FILE = "__file"


def _read_text_columns(spark: SparkSession, path: str, names: Mapping[str, str], with_file: bool = False) -> DataFrame:
    """All files as text columns under source names (and the name of the row's file).

    Files of equal headers are read together, files of other headers (other
    order, other columns) on their own, and united by name. Headers are matched
    without regard to case; of two that mean the same column the first counts.
    """
    by_lower = {header.lower(): name for header, name in names.items()}
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in _headers(spark, path).items():
        groups.setdefault(header, []).append(file)
    parts = []
    for header, paths in groups.items():
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
        df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(paths)
        kept: dict[str, str] = {}
        for i, h in enumerate(header):
            kept.setdefault(by_lower.get(h.lower(), h), f"c{i}")
        lowered: dict[str, str] = {}
        for name in kept:  # Spark's own names are case-insensitive
            lowered.setdefault(name.lower(), name)
        file = [F.col("_metadata.file_name").alias(_FILE)] if with_file else []
        parts.append(df.select(*[F.col(kept[n]).alias(n) for n in lowered.values()], *file))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in [*names.values(), *[_FILE] * with_file]]))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


_TYPERS = {T.DateType: as_date, T.TimestampNTZType: as_timestamp, T.StringType: as_string}


def _typed(df: DataFrame, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.DecimalType):
        return as_decimal(df, field.name, field.dataType.precision, field.dataType.scale)
    return _TYPERS[type(field.dataType)](df, field.name)


def _source_text(spark: SparkSession, path: str, entity: str, with_file: bool = False) -> tuple[DataFrame, list[T.StructField]]:
    """The text of all files under the layout's names, and the layout's fields they have."""
    text = _read_text_columns(spark, path, schemas.RENAME_MAPS[entity], with_file)
    layout = schemas.SOURCE_SCHEMAS[entity]
    present = {c.lower(): c for c in text.columns}
    text = text.withColumnsRenamed({present[f.name]: f.name for f in layout.fields if f.name in present and present[f.name] != f.name})
    return text, [f for f in layout.fields if f.name in present]


def rejected_values(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Every value of an entity CSV that does not fit its column's type (``read_csv``
    makes it NULL): file, record (the row's text columns as JSON), column_name,
    value and wanted (the declared type)."""
    text, present = _source_text(spark, path, entity, with_file=True)
    checked = [f for f in present if not isinstance(f.dataType, T.StringType)]
    if not checked:
        none = F.lit(None).cast("string")
        return text.filter(F.lit(False)).select(*[none.alias(c) for c in ("file", "record", "column_name", "value", "wanted")])
    values = [F.when(_typed(text, f).isNull() & F.col(f.name).isNotNull(), F.struct(
        F.lit(f.name).alias("column_name"), F.col(f.name).alias("value"), F.lit(f.dataType.simpleString()).alias("wanted"))) for f in checked]
    record = F.to_json(F.struct(*[c for c in text.columns if c != _FILE]))
    lost = text.select(F.col(_FILE).alias("file"), record.alias("record"), F.array_compact(F.array(*values)).alias("lost"))
    return lost.select("file", "record", F.explode("lost").alias("lost")).select("file", "record", "lost.*")


def read_csv(spark: SparkSession, path: str, entity: str, observation: Observation | None = None) -> DataFrame:
    """Read an entity CSV (a file or a folder of files) in source layout.

    Every column is read as text and typed here, so no schema is inferred and
    text with an explicit zone offset is converted instead of lost. Declared
    columns that no file has are typed NULLs; unknown headers stay text. Values
    that do not fit the declared type become NULL; ``observation`` counts them
    per column while the result is written (``nullified_<column>``).
    """
    text, present = _source_text(spark, path, entity)
    layout, names = schemas.SOURCE_SCHEMAS[entity], {f.name for f in present}
    typed = [(_typed(text, f) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in layout.fields]
    extra = [F.col(c) for c in text.columns if c.lower() not in layout.fieldNames()]
    if observation is None:
        return text.select(*typed, *extra)
    checked = [f for f in present if not isinstance(f.dataType, T.StringType)]
    lost = [F.count_if(F.col(f.name).isNull() & F.col(f"__text_{f.name}").isNotNull()).alias(f"nullified_{f.name}") for f in checked]
    both = text.select(*typed, *extra, *[F.col(f.name).alias(f"__text_{f.name}") for f in checked])
    both = both.observe(observation, F.count(F.lit(1)).alias("rows"), *lost)
    return both.drop(*[f"__text_{f.name}" for f in checked])


def write_csv(df: DataFrame, path: str, entity: str | None = None, mode: str = "overwrite",
              options: Mapping[str, str | int] | None = None) -> None:
    """Write CSV with a header; with ``entity``, source names become CSV headers.

    Leading/trailing spaces are kept (Spark trims them by default on write),
    so padded identifiers survive a round trip. ``options`` go to the writer.
    """
    if entity:
        df = rename_columns(df, {v: k for k, v in schemas.RENAME_MAPS[entity].items()})
    (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**(options or {}))
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                  options: Mapping[str, str] | None = None) -> int:
    """Overwrite a Parquet directory; returns the rows written. ``options`` go to the writer.

    The count is observed during the write (no second pass over the input).
    """
    obs = Observation("rows_written")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"])
