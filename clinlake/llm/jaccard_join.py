"""N-gram Jaccard join by prefix trees (operator 7).

Two documents link when the Jaccard index of their 5-word shingle sets is at
least 0.8 (integer arithmetic, ``linked``). Documents of equal sets form one
class; the join runs on classes, so copies cost nothing beyond their hashing.

1. A first pass over all texts counts shingles inside each task's portions and
   names those that several sets of a portion share; summed up, the most frequent
   become the *heavy* shingles. A shingle of a share of the sets meets itself in
   some portions however large the table is, and then makes no large block. They
   only set the global order - rare by hash first, heavy last, the most frequent
   at the end - and any choice of them gives the same links.
2. Sets that link share a shingle among the first n - ceil(0.8 n) + 1 of that
   order (prefix filter). Shingles in the prefixes of two or more classes make
   blocks; a block is named by the smallest class (its hub), so shingles that
   bring together the same classes make one block.
   Members that no other member of their block is near enough to in size leave.
3. Within a block, bitmaps of the sets (a bit for each hash, about n bits)
   give a lower bound of the symmetric difference; classes without a possible
   partner leave before any text is moved. Only sets near in size are compared.
4. The texts of the others come together and are joined by a prefix tree: sets
   as sequences in the block's order (shingles of many sets first), sorted, so
   that sets below one tree node are neighbours. A probe walks the sequences
   that size, bitmap and the links found so far leave open, keeps the overlap of
   shared prefixes, and leaves a subtree when the overlap so far and the
   remaining lengths cannot reach the threshold.
5. A block emits a spanning forest of its links, not all pairs of a group of
   copies; components come from alternating star joins.

Blocks above ``BLOCK`` classes are never taken into one task: first every
class is compared with the smallest class left in parts; classes that one does
not link to then meet all classes of the block in pairs of parts (exact, and small where the
block is a group of near copies).

Defined results: null texts and texts without words have an empty set and are
linked with nothing. Texts of fewer than 5 words have one shingle, all their
words. Rows without doc_id take part; a component of only such rows has a null
component_id. Repeated rows are one class. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clinlake.llm.common import discard, materialize, release_memory, shuffle_partitions, table
from clinlake.llm.components import components
from clinlake.llm.shingles import shingle_sets

#: A task's shingles are counted in portions of this many.
PORTION = 400_000
#: A shingle is named by a portion that has it in this many sets, and heavy if portions name it for so many.
NAMED = 2
HEAVY = 4
#: Most frequent named shingles that are ordered last.
MAX_HEAVY = 200_000
#: Up to so many rows are compared one by one, which costs less than the arrays.
FEW = 8
#: Bits of the bitmaps that a block's probes are compared by, at most.
MAX_BITS = 1 << 13
#: Classes of a block that one task compares, and shingles that one part of a block holds.
BLOCK = 512
PART_SHINGLES = 1_000_000
#: Classes with a possible partner up to this many (8 bytes each) are broadcast
#: to pick their texts; beyond it all texts are shuffled to them.
MAX_BROADCAST_CLASSES = 1_000_000


def linked(overlap: int, n: int, m: int) -> bool:
    return 100 * overlap >= 80 * (n + m - overlap)


def needed_overlap(n: int, m: int) -> int:
    """Smallest overlap of linked sets of these sizes."""
    return -(-4 * (n + m) // 9)


def prefix_length(n: int) -> int:
    return n + (-4 * n // 5) + 1 if n else 0


def class_key(hashes: np.ndarray) -> tuple[int, int]:
    """The two halves of a 128-bit hash of a set's shingle hashes; the first names
    its class, the second tells sets apart whose first halves are equal."""
    whole = xxhash.xxh3_128_intdigest(hashes.tobytes())
    return (whole >> 64) - (1 << 63), (whole & ((1 << 64) - 1)) - (1 << 63)


def bitmap(hashes: np.ndarray) -> bytes:
    bits = 64
    while bits < len(hashes):
        bits *= 2
    out = np.zeros(bits, np.uint8)
    out[(hashes & np.uint64(bits - 1)).astype("int64")] = 1
    return np.packbits(out, bitorder="little").tobytes()


def may_link(n: int, a: int, a_bits: int, m: int, b: int, b_bits: int) -> bool:
    """False if the sizes or the bitmaps (as integers) rule a link out."""
    if 5 * min(n, m) < 4 * max(n, m):
        return False
    while a_bits > b_bits:
        a_bits //= 2
        a = (a >> a_bits) | (a & ((1 << a_bits) - 1))
    while b_bits > a_bits:
        b_bits //= 2
        b = (b >> b_bits) | (b & ((1 << b_bits) - 1))
    return (a ^ b).bit_count() <= n + m - 2 * needed_overlap(n, m)


def most_apart(n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | int:
    """Elements that linked sets of these sizes have alone, at most."""
    return n + m - 2 * -(-4 * (n + m) // 9)


def possible_partners(sizes: np.ndarray, bits: Sequence[bytes], probe: np.ndarray) -> np.ndarray:
    """Which sets sizes and bitmaps let link to a probe, or as a probe to any: ``may_link``
    of all pairs with a probe that are near in size."""
    if len(sizes) <= FEW:
        out, ints, sizes = [False] * len(sizes), [(int.from_bytes(b, "little"), 8 * len(b)) for b in bits], sizes.tolist()
        for i, j in combinations(range(len(sizes)), 2):
            if (probe[i] or probe[j]) and not (out[i] and out[j]) and may_link(sizes[i], *ints[i], sizes[j], *ints[j]):
                out[i] = out[j] = True
        return np.array(out)
    order = np.argsort(sizes, kind="stable")
    n, is_probe = sizes[order], probe[order]
    widths = np.array([8 * len(bits[i]) for i in order])
    rows: dict[int, np.ndarray] = {}  # of each width, in order
    folded: dict[int, np.ndarray] = {}  # those of twice a width, as that width
    start = {}
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        start[w] = int(at[0])
        rows[w] = np.frombuffer(b"".join(bits[i] for i in order[at]), "<u8").reshape(len(at), w // 64)
        if w > 64:
            folded[w // 2] = rows[w][:, :w // 128] | rows[w][:, w // 128:]
    last = np.searchsorted(4 * n, 5 * n, side="right")
    probes_before = np.concatenate([[0], np.cumsum(is_probe)])
    found = np.zeros(len(n), bool)
    for i in range(len(n)):
        end, w = int(last[i]), int(widths[i])
        if end == i + 1 or not (is_probe[i] or probes_before[end] > probes_before[i + 1]):
            continue
        mine = rows[w][i - start[w]]
        apart = np.bitwise_count(rows[w][i + 1 - start[w]:end - start[w]] ^ mine).sum(1, dtype=np.int64)
        if len(apart) < end - i - 1:
            apart = np.concatenate([apart, np.bitwise_count(folded[w][:end - start[2 * w]] ^ mine).sum(1, dtype=np.int64)])
        near = apart <= most_apart(n[i], n[i + 1:end])
        if not is_probe[i]:
            near &= is_probe[i + 1:end]
        if near.any():
            found[i] = True
            found[i + 1:end] |= near
    out = np.zeros(len(n), bool)
    out[order] = found
    return out


def _even_bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of one width, a row for each set."""
    bits = 64
    while bits < min(MAX_BITS, max(map(len, sets))):
        bits *= 2
    flags = np.zeros((len(sets), bits), bool)
    for row, s in zip(flags, sets):
        row[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, axis=1).view(np.uint64)


def tree_links(sets: list[np.ndarray], probes: list[int], same: Callable[[int, np.ndarray | int], np.ndarray | bool], link: Callable[[int, int], None],
               both_ways: bool = True) -> None:
    """Join each probe (an index) with all sets but itself; ``link(i, j)`` is
    called for linked pairs that ``same`` (of an index and one or many others)
    does not already hold together. Unless ``both_ways``, two probes meet once."""
    pooled = np.concatenate(sets)
    values, counts = np.unique(pooled, return_counts=True)
    rank = np.empty(len(values), "int64")
    rank[np.lexsort((values, -counts))] = np.arange(len(values))  # shingles of many sets first
    rows = [np.sort(rank[np.searchsorted(values, s)]) for s in sets]
    order = sorted(range(len(rows)), key=lambda i: rows[i].astype(">i8").tobytes())
    shared = [0]
    for i, j in zip(order, order[1:]):
        n = min(len(rows[i]), len(rows[j]))
        differ = np.flatnonzero(rows[i][:n] != rows[j][:n])
        shared.append(int(differ[0]) if len(differ) else n)
    order, shared = np.array(order), np.array(shared)
    bitmaps, sizes = _even_bitmaps([sets[i] for i in order]), np.array([len(rows[i]) for i in order])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    held, probed = np.zeros(len(values), np.int64), np.zeros(len(order), bool)
    for probe in probes:
        mine = rows[probe]
        n = len(mine)
        open_ = (5 * np.minimum(n, sizes) >= 4 * np.maximum(n, sizes)) & ~np.asarray(same(probe, order), bool)
        probed[place[probe]] = True
        open_ &= ~probed
        if both_ways:
            probed[place[probe]] = False
        met = np.flatnonzero(open_)
        if len(met):
            met = met[np.bitwise_count(bitmaps[met] ^ bitmaps[place[probe]]).sum(1, dtype=np.int64) <= most_apart(n, sizes[met])]
        if not len(met):
            continue
        # what neighbours among those share: the least that any two from one to the next share
        depths = np.minimum.reduceat(shared, np.concatenate([[0], met[:-1] + 1, met[-1:] + 1])[:len(met) + (met[-1] + 1 < len(shared))])
        held[mine] = 1
        path_overlap = np.zeros(1, "int64")  # overlap after 0, 1, ... items of the current path
        cut = None  # depth at which the current path was given up
        for at, i in enumerate(order[met].tolist()):
            depth = int(depths[at])
            if cut is not None and depth >= cut:
                continue  # still below the node that was given up
            path_overlap = path_overlap[:depth + 1]
            cut = None
            row = rows[i]
            m = len(row)
            fresh = np.cumsum(held[row[depth:]]) + path_overlap[-1]
            path_overlap = np.concatenate([path_overlap, fresh])
            if same(probe, i):
                continue
            if linked(int(path_overlap[-1]), n, m):
                link(probe, i)
                continue
            # a node is given up when no set below it can reach the threshold:
            # the smallest size the threshold allows bounds what is needed; the
            # next set to be met is below the nodes that it shares with this one
            below = int(depths[at + 1]) if at + 1 < len(met) else 0
            left_in_probe = n - np.searchsorted(mine, row[:below], side="right")
            reach = path_overlap[1:below + 1] + left_in_probe
            lost = np.flatnonzero(reach < needed_overlap(n, -(-4 * n // 5)))
            if len(lost):
                cut = int(lost[0]) + 1
                path_overlap = path_overlap[:cut]
        held[mine] = 0


class _Forest:
    """Which of a block's classes are held together, by the number of their group;
    those of ``held`` are from the start."""

    def __init__(self, n: int, held: np.ndarray | None = None):
        self.group = np.arange(n)
        if held is not None and held.any():
            self.group[held] = np.flatnonzero(held)[0]

    def same(self, i: int, j: np.ndarray | int) -> np.ndarray | bool:
        return self.group[j] == self.group[i]

    def join(self, i: int, j: int) -> None:
        self.group[self.group == self.group[i]] = self.group[j]


def _portions(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    """(doc_id, text, set) in portions of about ``PORTION`` shingles."""
    held, size = [], 0
    for pdf in batches:
        for doc_id, text, s in zip(pdf["doc_id"], pdf["text"], shingle_sets(pdf["text"])):
            held.append((None if doc_id is None else int(doc_id), text, s))
            size += len(s)
            if size >= PORTION:
                yield held
                held, size = [], 0
    if held:
        yield held
    held = []
    release_memory()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")  # text: pandas would round null-able longs


def profile(docs: DataFrame) -> DataFrame:
    """Pass 1: a row (doc_id, n, class) for every document, and rows (token,
    count) for the shingles that sets of a task's portion share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _portions(batches):
            keys = [class_key(s) if len(s) else (None, None) for _, _, s in part]
            none = pd.array([None] * len(part), "Int64")
            yield pd.DataFrame({"doc_id": pd.array([d for d, _, _ in part], "Int64"), "n": pd.array([len(s) for _, _, s in part], "Int64"),
                                "class": pd.array([k for k, _ in keys], "Int64"), "twin": pd.array([t for _, t in keys], "Int64"),
                                "token": none, "count": none})
            distinct = {k: s for k, (_, _, s) in zip(keys, part) if k[0] is not None}
            if not distinct:
                continue
            pooled = np.sort(np.concatenate(list(distinct.values())))
            first = np.flatnonzero(np.concatenate([[True], pooled[1:] != pooled[:-1]]))
            counts = np.diff(np.append(first, len(pooled)))
            named = counts >= NAMED
            if named.any():
                n = int(named.sum())
                none = pd.array([None] * n, "Int64")
                yield pd.DataFrame({"doc_id": none, "n": none, "class": none, "twin": none, "token": pd.array(pooled[first[named]].view("int64"), "Int64"),
                                    "count": pd.array(counts[named], "Int64")})

    return _texts(docs).mapInPandas(run, "doc_id long, n long, class long, twin long, token long, count long")


def _prefixes(docs: DataFrame, heavy: np.ndarray) -> DataFrame:
    """Pass 2: prefix, bitmap and packed text of each class a task meets. ``heavy``
    are the shingles ordered last, in that order."""
    by_hash = np.argsort(heavy)
    heavy = heavy[by_hash]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3)
        for part in _portions(batches):
            out = []
            for key, (_, text, s) in {class_key(p[2]): p for p in part if len(p[2])}.items():
                p = prefix_length(len(s))
                at = np.searchsorted(heavy, s) if len(heavy) else None
                last = (heavy[np.minimum(at, len(heavy) - 1)] == s) if at is not None else np.zeros(len(s), bool)
                front = s[~last][:p]
                if len(front) < p:
                    behind = np.argsort(by_hash[at[last]])[:p - len(front)]
                    front = np.concatenate([front, s[last][behind]])
                out.append((*key, len(s), front.view("int64"), bitmap(s), squeeze.compress(text.encode("utf-8", "surrogatepass"))))
            if out:
                yield pd.DataFrame(out, columns=["class", "twin", "n", "prefix", "bits", "packed"])

    return _texts(docs).mapInPandas(run, "class long, twin long, n long, prefix array<long>, bits binary, packed binary")


def _told_apart(rows: DataFrame, shared_names: DataFrame) -> DataFrame:
    """``rows`` whose class name stands for one set only: where sets of different
    second halves share a name (``shared_names``: class, keeper), all but one are renamed."""
    met = rows.join(shared_names, "class", "left")
    own = F.when(F.col("twin") != F.col("keeper"), F.xxhash64("class", "twin")).otherwise(F.col("class"))
    return met.withColumn("class", own).drop("twin", "keeper").select(*[c for c in rows.columns if c != "twin"])


def _grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The groups of a partition that is sorted by ``keys``, as arrays of their
    columns (a block has few rows: pandas would cost more than the comparisons)."""
    rest: dict[str, np.ndarray] | None = None
    for pdf in batches:
        if not len(pdf):
            continue
        columns = {c: pdf[c].to_numpy() for c in pdf.columns}
        if rest is not None:
            columns = {c: np.concatenate([rest[c], v]) for c, v in columns.items()}
        new = np.zeros(len(columns[keys[0]]), bool)
        new[0] = True
        for k in keys:
            new[1:] |= columns[k][1:] != columns[k][:-1]
        starts = np.flatnonzero(new).tolist()
        for a, b in zip(starts, starts[1:]):
            yield {c: v[a:b] for c, v in columns.items()}
        rest = {c: v[starts[-1]:] for c, v in columns.items()}
    if rest is not None:
        yield rest
    rest = None
    release_memory()


#: Rows that a task gives back at once.
OUT_ROWS = 4096


def _gathered(parts: Iterator[list[np.ndarray]], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Arrays of ``columns`` as frames of about ``OUT_ROWS`` rows."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= OUT_ROWS:
            yield pd.DataFrame({c: np.concatenate([p[k] for p in held]) for k, c in enumerate(columns)})
            held, size = [], 0
    if held:
        yield pd.DataFrame({c: np.concatenate([p[k] for p in held]) for k, c in enumerate(columns)})


BLOCK_KEYS = ["hub", "part", "other"]


def _sorted_groups(df: DataFrame) -> DataFrame:
    # by number: Spark would put small blocks, however much there is to compare in them, into few tasks
    return df.repartition(shuffle_partitions(df.sparkSession), *BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS)


def _with_partner(members: DataFrame) -> DataFrame:
    """The rows of each block part that may link to a probe of it, by bitmaps."""

    columns = [*BLOCK_KEYS, "class", "probe", "held"]

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[list[np.ndarray]]:
        for rows in _grouped(batches, BLOCK_KEYS):
            _, first = np.unique(rows["class"], return_index=True)
            if len(first) < len(rows["class"]):
                rows = {c: v[first] for c, v in rows.items()}
            keep = possible_partners(rows["n"].astype("int64"), rows["bits"], rows["probe"].astype(bool))
            if keep.any():
                yield [rows[c][keep] for c in columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _gathered(kept(batches), columns)

    return _sorted_groups(members).mapInPandas(run, "hub long, part long, other long, class long, probe boolean, held boolean")


def _tree_join(members: DataFrame) -> DataFrame:
    """A spanning forest of the links of each block part's probes, beside those that
    already hold its ``held`` rows together."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[list[np.ndarray]]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for rows in _grouped(batches, BLOCK_KEYS):
            sets = list(shingle_sets(unpack.decompress(p).decode("utf-8", "surrogatepass") for p in rows["packed"]))
            names, forest, found = rows["class"], _Forest(len(sets), rows["held"].astype(bool)), []

            def link(i: int, j: int) -> None:
                forest.join(i, j)
                found.append((i, j))

            tree_links(sets, np.flatnonzero(rows["probe"]).tolist(), forest.same, link, both_ways=False)
            if found:
                yield [names[np.array(side)] for side in zip(*found)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _gathered(links(batches), ["a", "b"])

    return _sorted_groups(members).mapInPandas(run, "a long, b long")


def _parts(count: str, shingles: str):
    """Parts a block's classes are dealt into."""
    return F.greatest(F.ceil(F.col(count) / F.lit(BLOCK)), F.ceil(F.col(shingles) / F.lit(PART_SHINGLES))).cast("long")


def class_links(sets: DataFrame, scratch: list[str]) -> DataFrame:
    """Links (a, b) that connect exactly the classes that links connect.

    ``sets`` is the written table of ``_prefixes`` (a class may come from several tasks)."""
    postings = sets.select("class", F.explode("prefix").alias("token"))
    shared = postings.groupBy("token").agg(F.min("class").alias("hub"), F.max("class").alias("last")).filter("hub < last")
    shared = materialize(shared.select("token", "hub"), "join-shared", scratch)
    member = postings.join(shared, "token").select("hub", "class").distinct()
    sizes = sets.groupBy("class").agg(F.first("n").alias("n"))
    member = materialize(_near_in_size(materialize(member.join(sizes, "class"), "join-members", scratch)), "join-near", scratch)
    blocks = member.groupBy("hub").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("shingles"), F.min("class").alias("lead"))
    sized = member.join(blocks.withColumn("parts", _parts("classes", "shingles")).select("hub", "lead", "parts"), "hub")
    sized = materialize(sized, "join-blocks", scratch)
    bits = sets.groupBy("class").agg(F.first("bits").alias("bits"))
    bits = materialize(bits.join(member.select("class").distinct(), "class", "left_semi"), "join-bits", scratch)
    zero, no = F.lit(0).cast("long"), F.lit(False)
    small = sized.filter("parts = 1").select("hub", zero.alias("part"), zero.alias("other"), "class", "n", F.lit(True).alias("probe"), no.alias("held"))
    # a large block: its classes in parts, the smallest (its lead) as the probe in each of them
    large = sized.filter("parts > 1").filter("class != lead").select(
        "hub", F.pmod(F.xxhash64("class"), F.col("parts")).alias("part"), F.lit(-1).cast("long").alias("other"),
        "class", "n", no.alias("probe"), no.alias("held"))
    leads = sized.filter("parts > 1").filter("class = lead").select(
        "hub", F.explode(F.sequence(zero, F.col("parts") - 1)).alias("part"), F.lit(-1).cast("long").alias("other"),
        "class", "n", F.lit(True).alias("probe"), no.alias("held"))
    texts = sets.select("class", "packed")
    first = materialize(_with_partner(small.unionByName(large).unionByName(leads).join(bits, "class")), "join-first", scratch)
    links = materialize(_join_texts(first, texts, scratch), "join-links")
    # classes of large blocks that their lead does not link to meet all others; those it
    # links to are one group, so a class that links to one of them need not meet the rest
    apart = sized.filter("parts > 1").filter("class != lead")
    on_lead = links.select(F.col("a").alias("lead"), F.col("b").alias("class")).unionByName(
        links.select(F.col("b").alias("lead"), F.col("a").alias("class"))).distinct()
    apart = materialize(apart.join(on_lead, ["lead", "class"], "left_anti"), "join-apart", scratch)
    if apart.isEmpty():
        return links
    counts = apart.groupBy("hub").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("shingles")).withColumn("apart_parts", _parts("classes", "shingles"))
    counts = materialize(counts.select("hub", "apart_parts"), "join-apart-parts", scratch)
    probes = apart.join(counts, "hub").select(
        "hub", F.pmod(F.xxhash64("class"), F.col("apart_parts")).alias("part"),
        F.explode(F.sequence(zero, F.col("parts") - 1)).alias("other"), "class", "n", F.lit(True).alias("probe"), no.alias("held"))
    on_lead = on_lead.withColumn("held", F.lit(True))
    others = sized.filter("class != lead").join(counts, "hub").join(on_lead, ["lead", "class"], "left").select(
        "hub", F.explode(F.sequence(zero, F.col("apart_parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("class"), F.col("parts")).alias("other"), "class", "n", no.alias("probe"), F.coalesce("held", no).alias("held"))
    both = probes.unionByName(others).groupBy(*BLOCK_KEYS, "class").agg(F.max("probe").alias("probe"), F.max("held").alias("held"), F.first("n").alias("n"))
    second = materialize(_with_partner(both.join(bits, "class")), "join-second", scratch)
    return links.unionByName(materialize(_join_texts(second, texts, scratch), "join-more-links"))


def _near_in_size(member: DataFrame) -> DataFrame:
    """The members (hub, class, n) of blocks in which another member is near enough
    in size to link: seen from the block's sizes, one row for each size."""
    of_block = Window.partitionBy("hub").orderBy("n")
    sizes = member.groupBy("hub", "n").agg(F.count(F.lit(1)).alias("same"))
    below, above = F.lag("n").over(of_block), F.lead("n").over(of_block)
    near = (F.col("same") > 1) | F.coalesce(5 * below >= 4 * F.col("n"), F.lit(False)) | F.coalesce(5 * F.col("n") >= 4 * above, F.lit(False))
    kept = sizes.withColumn("near", near).filter("near").select("hub", "n")
    return member.join(kept, ["hub", "n"], "left_semi")


def _join_texts(members: DataFrame, texts: DataFrame, scratch: list[str]) -> DataFrame:
    # a class may have texts from several tasks: any of them gives its set
    wanted = materialize(members.select("class").distinct(), "join-wanted", scratch)
    if wanted.count() <= MAX_BROADCAST_CLASSES:
        wanted = F.broadcast(wanted)
    packed = texts.join(wanted, "class", "left_semi").groupBy("class").agg(F.min("packed").alias("packed"))
    return _tree_join(members.join(packed, "class"))  # by class already: the texts are not dealt again


#: Columns that name a row's set by its 128-bit hash (null: empty set).
SET_KEY = ["set_high", "set_low"]


def with_set_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``SET_KEY``, the hash of each text's shingle set."""

    def run(texts: pd.Series) -> pd.DataFrame:
        keys = [class_key(s) if len(s) else (None, None) for s in shingle_sets(texts)]
        return pd.DataFrame({c: pd.array([k[i] for k in keys], "Int64") for i, c in enumerate(SET_KEY)})

    key = F.pandas_udf(run, "set_high long, set_low long")(F.col("text"))
    return docs.withColumn("__key", key).select(*docs.columns, *[F.col(f"__key.{c}").alias(c) for c in SET_KEY])


def near_duplicates(docs: DataFrame, with_key: bool = False) -> DataFrame:
    """(doc_id, n_shingles, class, component) of every row; ``component`` names
    the group by its smallest class, null for empty sets; ``with_key`` adds ``SET_KEY``."""
    rows = materialize(profile(docs), "join-profile")
    names = rows.filter("class is not null").groupBy("class").agg(F.min("twin").alias("keeper"), F.max("twin").alias("last"))
    shared_names = materialize(names.filter("keeper < last").select("class", "keeper"), "join-shared-names")
    heavy_rows = rows.filter("token is not null").groupBy("token").agg(F.sum("count").alias("count"))
    heavy = heavy_rows.filter(F.col("count") >= HEAVY).orderBy(F.desc("count"), "token").limit(MAX_HEAVY).select("token").collect()  # MAX_HEAVY longs at most
    scratch: list[str] = []
    sets = _prefixes(docs, np.array([r["token"] for r in reversed(heavy)], "int64").view("uint64"))
    links = class_links(materialize(_told_apart(sets, shared_names), "join-sets", scratch), scratch)
    discard(docs.sparkSession, scratch)
    found = components(links)
    key = [F.col("class").alias(SET_KEY[0]), F.col("twin").alias(SET_KEY[1])] if with_key else []
    documents = _told_apart(rows.filter("n is not null").select("doc_id", "n", "class", "twin", *key), shared_names)
    out = documents.join(materialize(found, "join-components"), F.col("class") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "class", F.coalesce("root", "class").alias("component"), *SET_KEY[:2 * with_key])


def with_smallest_id(rows: DataFrame) -> DataFrame:
    """``rows`` of ``near_duplicates`` with ``component_id``, the group's smallest doc_id."""
    rows = materialize(rows, "join-rows")
    smallest = materialize(rows.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id")), "join-smallest")
    joined = rows.filter("component is not null").join(smallest, "component")
    alone = rows.filter("component is null").withColumn("component_id", F.col("doc_id"))
    return joined.unionByName(alone)


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and near-duplicate component of every document."""
    found = with_smallest_id(near_duplicates(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_shingles", "component_id")


OP7_SQL = """
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  WHERE 5 * least(p.n, q.n) >= 4 * greatest(p.n, q.n)
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id
GROUP BY d.doc_id, s.n
"""
