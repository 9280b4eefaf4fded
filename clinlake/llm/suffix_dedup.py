"""Suffix-array dedup by a common-prefix-aware distributed merge sort (operator 4).

Every byte covered by a 100-byte string that also starts earlier (in a
document of smaller id, or earlier in the same one) is removed; strings are
judged on the input. Exact, for whole texts, in these steps:

1. Texts are taken in portions of about ``PORTION_BYTES`` and written as a
   table bucketed by portion (compressed), with the hashes of the seeds that
   anchor the windows of the portion (see ``suffix_runs``), by hash bucket.
2. Each bucket finds the seeds that occur in two or more portions; every
   portion is told its own. Most suffixes drop out here.
3. Each portion sorts its suffixes at repeated anchors. Equal ones are settled
   on the spot - all but the earliest are repeats - so a passage that many
   documents share leaves a portion once. The sorted runs are front-coded and
   exchanged by seed bucket.
4. Each bucket merges its runs with a tree of losers that never compares a
   known prefix again. Neighbours with a common prefix of a seed or more form
   a group; windows that are equal in a group are told apart by document and
   position, and all but the earliest are repeats.
5. The repeats go back to their portions, where the texts still lie bucketed,
   and become removed spans.

Seeds with more than ``HOT_ELEMENTS`` suffixes (a passage at whose edges many
documents differ) are dealt by the bytes that ``CLASS`` neighbouring windows
share instead of by the seed, so no bucket collects them all; windows that are
equal have equal such bytes and still meet.

Defined results: a null text counts as empty; texts below 100 bytes lose
nothing. Rows that share a doc_id are documents of their own, in the order
they are read; rows without doc_id come before all others. Matches never cross
documents. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clinlake.llm import suffix_runs as sr
from clinlake.llm.common import discard, materialize, release_memory, shuffle_partitions, table
from clinlake.session import scratch_path

PORTION_BYTES = 8 << 20
HOT_ELEMENTS = 20_000
NO_ID = -(2**63)

LONG, INT, BYTES, LONGS = T.LongType(), T.IntegerType(), T.BinaryType(), T.ArrayType(T.LongType())
PORTION_FIELDS = [T.StructField(n, t) for n, t in (
    ("portion", LONG), ("row", INT), ("doc_id", LONG), ("packed", BYTES), ("bucket", INT), ("seeds", BYTES), ("counts", BYTES))]
PORTION_ARROW = pa.schema([("portion", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("packed", pa.binary()),
                           ("bucket", pa.int32()), ("seeds", pa.binary()), ("counts", pa.binary())])
RUN_SCHEMA = "portion long, row int, first long, last long, bucket int, run binary"
RUN_ARROW = pa.schema([("portion", pa.int64()), ("row", pa.int32()), ("first", pa.int64()), ("last", pa.int64()),
                       ("bucket", pa.int32()), ("run", pa.binary())])


def _table(schema: pa.Schema, **columns) -> pa.Table:
    n = len(next(iter(columns.values())))
    return pa.table({f.name: pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema})


def _portions(docs: DataFrame, buckets: int, keep: list[str]) -> DataFrame:
    """Step 1: text rows (with the ``keep`` columns, as k0, k1, ...) and seed rows of every portion."""
    kept = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3)
        task = TaskContext.get().partitionId()
        number, ids, texts, size, schema = 0, [], [], 0, PORTION_ARROW
        others: list[list] = [[] for _ in kept]

        def emit() -> Iterator[pa.RecordBatch]:
            portion = [(task << 32) | number] * len(ids)
            for at in range(0, len(ids), 512):
                part = slice(at, at + 512)
                yield from _table(schema, portion=portion[part], row=list(range(len(ids)))[part], doc_id=ids[part],
                                  packed=[squeeze.compress(t) for t in texts[part]],
                                  **{f"k{i}": c[part] for i, c in enumerate(others)}).to_batches()
            found, counts = np.unique(sr.windows(texts).seed, return_counts=True)
            owner = (found % np.uint64(buckets)).astype(int)
            rows = [(b, found[owner == b], np.minimum(counts[owner == b], 65535).astype("<u2")) for b in np.unique(owner)]
            if rows:
                yield from _table(schema, portion=portion[:1] * len(rows), bucket=[b for b, _, _ in rows],
                                  seeds=[s.astype("<u8").tobytes() for _, s, _ in rows], counts=[c.tobytes() for _, _, c in rows]).to_batches()

        for batch in batches:
            schema = pa.schema([*PORTION_ARROW, *[pa.field(f"k{i}", f.type) for i, f in enumerate(list(batch.schema)[2:])]])
            for at, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                ids.append(doc_id)
                texts.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
                for own, column in zip(others, batch.columns[2:]):
                    own.append(column[at].as_py())
                size += len(texts[-1])
                if size >= PORTION_BYTES:
                    yield from emit()
                    number, ids, texts, size = number + 1, [], [], 0
                    others = [[] for _ in kept]
        if ids:
            yield from emit()
        ids, texts, others = [], [], []
        release_memory()

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    return chosen.mapInArrow(run, T.StructType([*PORTION_FIELDS, *kept]))


def _bucketed(spark: SparkSession, df: DataFrame, buckets: int) -> DataFrame:
    """``df`` written bucketed by portion, so that later joins by portion move no text.

    Only a catalog table can be written in buckets; its entry goes at once, the
    files (external) and the table read here, which knows its buckets, stay."""
    name = f"suffix_portions_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "portion").option("path", scratch_path(spark, "suffix-portions")).saveAsTable(name)
    written = spark.table(name)
    written.schema  # resolved now
    spark.sql(f"DROP TABLE {name}")
    return written


def _repeated_seeds(seeds: DataFrame, buckets: int) -> DataFrame:
    """Step 2: (portion, seeds, hot): the seeds of a portion that other portions have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list] = {}
        for batch in batches:
            for bucket, portion, found, counts in zip(*[c.to_pylist() for c in batch.columns]):
                rows.setdefault(bucket, []).append((portion, np.frombuffer(found, "<u8"), np.frombuffer(counts, "<u2")))
        out = []
        for own in rows.values():
            pooled, where = np.unique(np.concatenate([s for _, s, _ in own]), return_inverse=True)
            many = np.bincount(where) > 1
            total = np.bincount(where, np.concatenate([c for _, _, c in own]).astype("float64"))
            at = 0
            for portion, found, _ in own:
                mine = where[at:at + len(found)]
                at += len(found)
                hot = total[mine] > HOT_ELEMENTS
                kept = many[mine] | hot
                if kept.any():
                    out.append({"portion": portion, "seeds": found[kept].tobytes(), "hot": found[hot].tobytes()})
        schema = pa.schema([("portion", pa.int64()), ("seeds", pa.binary()), ("hot", pa.binary())])
        for at in range(0, len(out), 64):
            yield pa.RecordBatch.from_pylist(out[at:at + 64], schema)

    dealt = seeds.select("bucket", "portion", "seeds", "counts").repartitionById(buckets, F.col("bucket"))
    return dealt.mapInArrow(run, "portion long, seeds binary, hot binary")


def _texts(rows: pa.Table) -> tuple[pa.Table, list[bytes]]:
    import zstandard

    rows = rows.sort_by("row")
    unpack = zstandard.ZstdDecompressor()
    return rows, [unpack.decompress(p) for p in rows.column("packed").to_pylist()]


def _sort_runs(buckets: int):
    """Step 3 for one portion: its settled repeats and its runs by bucket."""

    def run(texts: pa.Table, repeated: pa.Table) -> pa.Table:
        rows, data = _texts(texts)
        if not len(data):
            return RUN_ARROW.empty_table()
        portion = rows.column("portion")[0].as_py()
        ids = [NO_ID if d is None else d for d in rows.column("doc_id").to_pylist()]
        numbers = rows.column("row").to_pylist()
        known = [np.frombuffer(b, "<u8") for b in repeated.column("seeds").to_pylist()]
        hot = {int(x) for b in repeated.column("hot").to_pylist() for x in np.frombuffer(b, "<u8")}
        w = sr.windows(data)
        seeds, counts = np.unique(w.seed, return_counts=True)
        again = np.concatenate([seeds[counts > 1], *known])
        kept = np.flatnonzero(np.isin(w.seed, again))
        found: dict[int, dict[tuple[bytes, bytes], tuple]] = {}
        settled: list[tuple[int, int, int]] = []  # row, first and last byte
        for d, a, first, last, seed in zip(*[c[kept].tolist() for c in w]):
            text = data[d]
            cuts = [(None, first, last)] if seed not in hot else sr.classes(first, last, a)
            for c, s, e in cuts:
                bucket = seed % buckets if c is None else xxhash.xxh3_64_intdigest(sr.core(text, a, c), c) % buckets
                element = (text[a:e + sr.LENGTH], text[s:a])
                where = (ids[d], portion, numbers[d], a)
                own = found.setdefault(bucket, {})
                before = own.get(element)
                if before is None or where < before:
                    own[element] = where
                if before is not None:  # the later one is a repeat as a whole
                    later = max(before, where)
                    settled.append((later[2], later[3] - len(element[1]), later[3] + len(element[0])))
        out = [_table(RUN_ARROW, portion=[portion] * len(settled), row=[x[0] for x in settled],
                      first=[x[1] for x in settled], last=[x[2] for x in settled])]
        runs = []
        for bucket, own in found.items():
            elements = sorted(sr.Element(r, left, where) for (r, left), where in own.items())
            runs.append((bucket, sr.encode_run(elements)))
        out.append(_table(RUN_ARROW, portion=[portion] * len(runs), bucket=[b for b, _ in runs], run=[r for _, r in runs]))
        del found, settled, runs, w, data
        release_memory()
        return pa.concat_tables(out)

    return run


def _merge(runs: DataFrame, buckets: int) -> DataFrame:
    """Step 4: (portion, row, first, last) bytes of repeats found across portions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, blob in zip(*[c.to_pylist() for c in batch.columns]):
                held.setdefault(bucket, []).append(blob)
        schema = pa.schema([(f.name, f.type) for f in RUN_ARROW][:4])
        out = []
        for blobs in held.values():
            for (_, portion, row, anchor), first, last in sr.repeated_windows(sr.merge_runs([sr.decode_run(b) for b in blobs])):
                out.append((portion, row, anchor - first, anchor - last + sr.LENGTH))
                if len(out) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        held, out = {}, []
        release_memory()

    dealt = runs.select("bucket", "run").repartitionById(buckets, F.col("bucket"))
    return dealt.mapInArrow(run, "portion long, row int, first long, last long")


def merged_spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of [first, last) intervals."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > last[:-1]
    return first[new], np.append(last[np.flatnonzero(new)[1:] - 1], last[-1:])


def _removed(n_kept: int):
    """Step 5 for one portion: spans and kept bytes of its documents."""

    def run(texts: pa.Table, repeats: pa.Table) -> pa.Table:
        rows, data = _texts(texts)
        owner = repeats.column("row").to_numpy()
        order = np.argsort(owner, kind="stable")
        owner, first, last = owner[order], repeats.column("first").to_numpy()[order], repeats.column("last").to_numpy()[order]
        spans, rest = [], []
        for row, text in zip(rows.column("row").to_pylist(), data):
            a, b = np.searchsorted(owner, [row, row + 1])
            starts, ends = merged_spans(first[a:b], last[a:b]) if b > a else (first[:0], last[:0])
            kept, at = [], 0
            for s, e in zip(starts.tolist(), ends.tolist()):
                kept.append(text[at:s])
                at = e
            kept.append(text[at:])
            spans.append((starts, ends))
            rest.append(b"".join(kept))
        longs = pa.list_(pa.int64())
        columns = [rows.column("doc_id"), pa.array([len(t) for t in data], pa.int64()), pa.array([s for s, _ in spans], longs),
                   pa.array([e for _, e in spans], longs), pa.array(rest, pa.binary()),
                   pa.array([r.decode("utf-8", "ignore") for r in rest], pa.string()),
                   *[rows.column(f"k{i}") for i in range(n_kept)]]
        return pa.table(columns, names=[f.name for f in RESULT_FIELDS] + [f"k{i}" for i in range(n_kept)])

    return run


RESULT_FIELDS = [T.StructField(n, t) for n, t in (
    ("doc_id", LONG), ("n_bytes", LONG), ("span_starts", LONGS), ("span_ends", LONGS), ("kept", BYTES), ("kept_text", T.StringType()))]


def remove_repeats(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, n_bytes, span_starts, span_ends, kept, kept_text) of every
    document, and its ``keep`` columns: the removed spans, the bytes that
    remain, and these as text (without the rest of characters cut through)."""
    spark, keep, scratch = docs.sparkSession, keep or [], []
    buckets = shuffle_partitions(spark)
    portions = _bucketed(spark, _portions(docs, buckets, keep), buckets)
    others = [f"k{i}" for i in range(len(keep))]
    texts = portions.filter("row is not null").select("portion", "row", "doc_id", "packed", *others)
    repeated = materialize(_repeated_seeds(portions.filter("bucket is not null"), buckets), "suffix-seeds", scratch)
    runs = texts.groupBy("portion").cogroup(repeated.groupBy("portion")).applyInArrow(_sort_runs(buckets), RUN_SCHEMA)
    runs = materialize(runs, "suffix-runs", scratch)
    settled = materialize(runs.filter("bucket is null").select("portion", "row", "first", "last"), "suffix-settled")
    found = materialize(_merge(runs.filter("bucket is not null"), buckets), "suffix-repeats")
    discard(spark, scratch)
    repeats = settled.unionByName(found)
    schema = T.StructType([*RESULT_FIELDS, *[T.StructField(o, docs.schema[c].dataType) for o, c in zip(others, keep)]])
    out = texts.groupBy("portion").cogroup(repeats.groupBy("portion")).applyInArrow(_removed(len(keep)), schema)
    return out.withColumnsRenamed(dict(zip(others, keep)))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed bytes of every document."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("span_starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
