"""Best-fit packing of documents into sequences by exact-complement hashing (operator 13).

1. Every document becomes ids and an end id, cut into pieces of at most ``CAP``
   ids (only longer documents; the first piece takes the odd length). Tasks
   number their pieces of each length.
2. The plan needs only the number of pieces of each length (``CAP`` numbers).
   The longest length left opens a pattern; its gap is looked up among the
   lengths left, the sums of pairs, and the sums of triples, kept in an index
   that follows the counts; where none fills it exactly, the longest length
   that fits goes in (best fit) and the smaller gap is looked up again. A
   pattern is used as often as its counts allow, so one decision stands for all
   pieces of these lengths, however many rows there are.
3. A piece's place follows from its rank among the pieces of its length: every
   slot of a pattern owns a range of ranks. Ranks come from the counts of
   (task, length); no length meets in one task, though a third of all documents
   may share one.

Every time a pattern is used up, some length can no longer be taken as often in
a pattern as before (at most ``CAP / length`` times), so there are at most
CAP * (1 + ln CAP) patterns (some 17,000 for 2,048), whatever the size of the
data; that bounds the plan the tasks receive and the driver's work.

Defined results: a null or empty text is the end id alone; rows without doc_id
and rows that share one are pieces like others (``start`` counts from each row's
own first id); repeated rows are packed as often as they occur; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clinlake.llm.byte_bpe import VOCABULARY, encoder
from clinlake.llm.common import discard, materialize, table

CAP = 2048
END_ID = 0
#: Ranks take this many bits of a plan key, lengths the bits above.
RANK_BITS = 44


class Lengths:
    """Counts of lengths and, for every sum, how many pairs of lengths make it."""

    def __init__(self, counts: Mapping[int, int], cap: int):
        self.cap = cap
        self.count = np.zeros(cap + 1, "int64")
        self.pairs = np.zeros(cap + 1, "int64")
        for length, n in counts.items():
            self.put(length, n)

    def put(self, length: int, n: int) -> None:
        """Set a length's count and keep the sums of pairs right."""
        before, self.count[length] = int(self.count[length]), n
        if (before > 0) != (n > 0):
            others = np.flatnonzero(self.count[:self.cap + 1 - length] > 0)
            others = others[others != length] + length
            self.pairs[others] += 1 if n > 0 else -1
        if 2 * length <= self.cap and (before > 1) != (n > 1):
            self.pairs[2 * length] += 1 if n > 1 else -1

    def take(self, length: int) -> None:
        self.put(length, int(self.count[length]) - 1)

    def longest(self, most: int) -> int:
        """The longest length left that is at most ``most``; 0 if none."""
        there = np.flatnonzero(self.count[:most + 1] > 0)
        return int(there[-1]) if len(there) else 0

    def pair(self, total: int) -> list[int]:
        """Two lengths of this sum, the longer as long as possible."""
        if total < 2 or not self.pairs[total]:
            return []
        longer = np.arange((total + 1) // 2, total)
        fits = (self.count[longer] > 0) & (self.count[total - longer] > (longer * 2 == total))
        found = longer[fits]
        return [int(found[-1]), total - int(found[-1])] if len(found) else []

    def triple(self, total: int) -> list[int]:
        """Three lengths of this sum, the first as long as possible."""
        if total < 3:
            return []
        first = np.arange(1, total - 1)
        first = first[(self.count[first] > 0) & (self.pairs[total - first] > 0)]
        for a in first[::-1].tolist():
            self.take(a)  # the pair may not count on the same piece
            rest = self.pair(total - a)
            self.put(a, int(self.count[a]) + 1)
            if rest:
                return [a, *rest]
        return []

    def exactly(self, gap: int) -> list[int]:
        """One, two or three lengths left that fill the gap; empty if none do."""
        return [gap] if self.count[gap] > 0 else self.pair(gap) or self.triple(gap)


def plan_patterns(counts: Mapping[int, int], cap: int = CAP) -> list[tuple[int, list[int]]]:
    """(how often, lengths) of every pattern; together they use up the counts."""
    left, patterns = Lengths(counts, cap), []
    while length := left.longest(cap):
        pattern, gap = [], cap
        while length:
            pattern.append(length)
            left.take(length)
            gap -= length
            filling = left.exactly(gap) if gap else []
            for other in filling:
                left.take(other)
            pattern += filling
            length = left.longest(gap) if gap and not filling else 0
        uses = Counter(pattern)
        more = min(int(left.count[n]) // k for n, k in uses.items())
        for n, k in uses.items() if more else ():
            left.put(n, int(left.count[n]) - more * k)
        patterns.append((1 + more, pattern))
    return patterns


class Plan:
    """Which slot each rank of each length has, as sorted arrays."""

    def __init__(self, counts: Mapping[int, int], cap: int = CAP):
        used: Counter = Counter()
        slots, sequences = [], 0
        for times, pattern in plan_patterns(counts, cap):
            offset = 0
            for length in pattern:
                slots.append(((length << RANK_BITS) + used[length], sequences - used[length], offset))
                used[length] += times
                offset += length
            sequences += times
        slots.sort()
        self.sequences = sequences
        self.keys, self.shift, self.offset = (np.array(c, "int64") for c in zip(*slots)) if slots else (np.zeros(0, "int64"),) * 3

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and ranks."""
        slot = np.searchsorted(self.keys, (lengths << RANK_BITS) + ranks, side="right") - 1
        return self.shift[slot] + ranks, self.offset[slot]


def cuts(n: int, cap: int = CAP) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: all but the first of ``cap`` ids."""
    first = n - cap * (-(-n // cap) - 1)
    return [(0, first)] + [(start, cap) for start in range(first, n, cap)]


_PIECE = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
          ("task", pa.int32()), ("at", pa.int64())]


def to_pieces(docs: DataFrame, vocabulary: str, cap: int = CAP, with_ids: bool = True) -> DataFrame:
    """Every piece: doc_id, piece, start, length, ids_crc32, and ``ids`` (packed
    little-endian 32-bit) if wanted; ``task`` and ``at`` number the pieces of a length."""
    schema = pa.schema(_PIECE + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = encoder(vocabulary), TaskContext.get().partitionId()
        kind, end = f"<u{own.width}", own.pack([END_ID])
        seen = np.zeros(cap + 1, "int64")
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(own.encode(text.as_py() or "") + end, kind).astype("<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), cap)):
                    packed = ids[start:start + length].tobytes()
                    rows.append((doc_id, piece, start, length, zlib.crc32(packed), task, int(seen[length]), packed)[:len(schema)])
                    seen[length] += 1
                    held += len(packed) if with_ids else 0
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, at long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kinds)


def place(pieces: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds sequence_id and offset to written pieces (with length, task and at)."""
    spark, scratch = pieces.sparkSession, []
    sizes = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    sizes = materialize(sizes.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))), "packing-sizes", scratch)
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("size").alias("n")).collect()}  # a row for each length
    plan = Plan(counts, cap)
    ranked = pieces.join(sizes.drop("size"), ["length", "task"]).withColumn("rank", F.col("base") + F.col("at")).drop("task", "at", "base")
    names = ranked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.places(*[batch.column(c).to_numpy() for c in ("length", "rank")])
            columns = [batch.column(c) for c in names if c != "rank"] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [c for c in names if c != "rank"] + ["sequence_id", "offset"])

    kinds = ", ".join(f"{c} {t}" for c, t in ranked.dtypes if c != "rank")
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, cap: int = CAP, with_ids: bool = True) -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset, and its ids if wanted."""
    pieces = materialize(to_pieces(docs, vocabulary, cap, with_ids), "packing-pieces")
    order = [name for name, _ in _PIECE if name not in ("task", "at")] + ["sequence_id", "offset"] + ["ids"] * with_ids
    return place(pieces, cap).select(*order)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_ids, ids (packed little-endian 32-bit)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``cap`` ids a sequence
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), parts.alias("parts")).select(
        "sequence_id", "n_ids", F.aggregate("parts", F.lit(b""), lambda out, p: F.concat(out, p["ids"])).alias("ids"))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place among the sequences."""
    return pack(table(spark, sf_dir, "documents"), vocabulary_path(), with_ids=False)
