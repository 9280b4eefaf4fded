"""Merkle manifest of a dataset by checkpoint and recompute (operator 12).

Every row is a leaf. The leaves of a tree (one for each value of a column, such
as the language) ascend by an id, and every ``ARITY`` consecutive nodes become
one node, until one is left: the tree's subroot. The subroots, ordered by the
column, are the leaves of the top tree, whose last node is the root.

Only every ``STRIDE``-th level is persisted: the leaves, the nodes ``STRIDE``
levels above, and so on. An aligned subtree of ``ARITY ** STRIDE`` stored nodes
is all a task needs at once: ``build`` climbs it and keeps its top, ``proofs``
regenerates its missing interior nodes from the stored ones, emits what each
stored node has beside it on its way up, and discards them. The way from the
subtree's top to the root comes down from the stored level above, once for each
subtree. Nothing but the number of levels passes the driver.

Positions are counted without a group in one task: rows are range partitioned
by (tree, id), numbered where they lie, and the partitions' counts are summed.
Rows equal in every respect are told apart by where they were read, so an id
that a third of all rows share is split as well.

Defined results: a null field is hashed as ``-``; rows without tree value form
the first tree; rows without id come first in their tree; rows that share an id
are ordered by their leaves; repeated rows are leaves of their own. A tree of
one leaf has that leaf as subroot, a single subroot is the root. Siblings of a
node alone in its run are none; the proof of a single row is empty. Missing
``documents`` columns are an error, extra ones are ignored (they are no part of
the leaf). An empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark import TaskContext

from clinlake.llm.common import discard, materialize, show_package, shuffle_partitions, table

ARITY = 8
#: Levels from one persisted level to the next: subtrees of 512 stored nodes.
STRIDE = 3
SUBTREE = ARITY**STRIDE
#: Fields of a document's leaf, in this order.
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields: ``-`` if null, else byte count, ``:``, value."""
    shown = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown]
    return F.sha2(F.concat(*parts), 256)


def tree_key(column: Column) -> Column:
    """A key never null that sorts null first, then by the bytes of the value."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def subtree_levels(digests: list[str], in_tree: int) -> list[list[str]]:
    """A subtree's stored nodes and all levels above them: ``STRIDE`` of these,
    or up to one node where the subtree holds all of the tree's ``in_tree`` nodes."""
    levels = [digests]
    while len(levels[-1]) > 1 if in_tree <= SUBTREE else len(levels) <= STRIDE:
        below = levels[-1]
        levels.append([_hash("".join(below[i:i + ARITY])) for i in range(0, len(below), ARITY)])
    return levels


def subtree_paths(levels: list[list[str]]) -> Iterator[tuple[list[int], list[str]]]:
    """For every stored node: its place in its run and the run's others (joined
    left to right), level by level up to the subtree's top."""
    beside = []
    for level in levels[:-1]:
        own = []
        for i in range(len(level)):
            start = i - i % ARITY
            own.append("".join(level[start:i]) + "".join(level[i + 1:start + ARITY]))
        beside.append(own)
    for i in range(len(levels[0])):
        at = [i // ARITY**up for up in range(len(beside))]
        yield [a % ARITY for a in at], [beside[up][a] for up, a in enumerate(at)]


def fold(leaf: str, places: Sequence[int], others: Sequence[str]) -> str:
    """The root that a leaf and its proof lead to."""
    for place, run in zip(places, others):
        leaf = _hash(run[:place * HEX] + leaf + run[place * HEX:])
    return leaf


def _numbered(rows: DataFrame, order: Sequence[str], scratch: list[str], name: str) -> DataFrame:
    """Adds ``pos``, the row's place in its tree by ``order``, and ``n``, the tree's rows.

    ``rows`` (with a column ``tree``) must be a written table."""
    spark = rows.sparkSession
    split = rows.withColumn("nth", F.monotonically_increasing_id())
    keys = ["tree", *order, "nth"]
    dealt = split.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys).drop("nth")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            local = []
            for tree in batch.column("tree").to_pylist():
                count = count + 1 if tree == last else 0
                last = tree
                local.append(count)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(local, pa.int64())],
                                             [*batch.schema.names, "part", "local"])

    kinds = ", ".join(f"{c} {t}" for c, t in dealt.dtypes)
    placed = materialize(dealt.mapInArrow(number, f"{kinds}, part int, local long"), f"{name}-placed", scratch)
    sizes = placed.groupBy("tree", "part").agg((F.max("local") + 1).alias("size"))
    of_tree = Window.partitionBy("tree")  # one row for each partition that holds rows of the tree
    before = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("tree", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"), F.sum("size").over(of_tree).alias("n"))
    sizes = materialize(sizes, f"{name}-sizes", scratch)
    return placed.join(sizes, ["tree", "part"]).withColumn("pos", F.col("base") + F.col("local")).drop("part", "local", "base")


def _in_subtrees(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("above", F.floor(F.col("pos") / SUBTREE).cast("long"))


def _climb(nodes: DataFrame) -> DataFrame:
    """The stored nodes one persisted level up: (tree, pos, digest, n)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        in_tree = int(group["n"].iloc[0])
        top = subtree_levels(group["digest"].tolist(), in_tree)[-1]
        return pd.DataFrame({"tree": group["tree"].iloc[:1], "pos": group["above"].iloc[:1], "digest": top, "n": -(-in_tree // SUBTREE)})

    parts = _in_subtrees(nodes.select("tree", "pos", "digest", "n"))
    return parts.groupBy("tree", "above").applyInPandas(run, "tree string, pos long, digest string, n long")


@dataclass
class Tree:
    """One or more trees: every persisted level, leaves first, and the subroots (tree, digest)."""

    levels: list[DataFrame]
    tops: DataFrame
    scratch: list[str] = field(default_factory=list)


def build(leaves: DataFrame, order: Sequence[str], name: str = "merkle") -> Tree:
    """Persist every ``STRIDE``-th level of the trees of ``leaves`` (written table
    with tree, digest, the columns of ``order`` and any others)."""
    scratch: list[str] = []
    nodes = materialize(_numbered(leaves, order, scratch, name), f"{name}-leaves", scratch)
    levels, tops = [nodes], None
    while True:
        above = materialize(_climb(levels[-1]), f"{name}-level{STRIDE * len(levels)}", scratch)
        done = above.filter("n = 1").select("tree", "digest")
        tops = done if tops is None else tops.unionByName(done)
        going = above.filter("n > 1")
        if going.isEmpty():
            return Tree(levels, tops, scratch)
        levels.append(going)


_WAY = "tree string, pos long, places array<int>, others array<string>, subroot string, root string"


def _way_up(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The way of every stored node to the root, its subtree's top's way being
    in ``above`` (tree, pos, places, others, subroot, root)."""

    def run(group: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame(columns=[c.split()[0] for c in _WAY.split(", ")])
        group, top = group.sort_values("pos"), top.iloc[0]
        ways = list(subtree_paths(subtree_levels(group["digest"].tolist(), int(group["n"].iloc[0]))))
        return pd.DataFrame({
            "tree": group["tree"], "pos": group["pos"], "places": [w[0] + list(top["places"]) for w in ways],
            "others": [w[1] + list(top["others"]) for w in ways], "subroot": top["subroot"], "root": top["root"]})

    parts = _in_subtrees(nodes.select("tree", "pos", "digest", "n"))
    tops = above.withColumnRenamed("pos", "above")
    return parts.groupBy("tree", "above").cogroup(tops.groupBy("tree", "above")).applyInPandas(run, _WAY)


def _ways_down(tree: Tree, tops: DataFrame, name: str) -> DataFrame:
    """The ways of the subtrees' tops right above the leaves.

    ``tops`` has the way of every tree's subroot; it joins in at the level where
    the tree has one subtree left."""
    way = tops
    for level in reversed(tree.levels[1:]):
        here = materialize(_way_up(level, way), f"{name}-ways", tree.scratch)
        deep = level.select("tree").distinct()
        way = here.unionByName(tops.join(deep, "tree", "left_anti"))
    return way


@dataclass
class Manifest:
    """The trees of a table, the tree over their subroots, and the root (one row, or none)."""

    rows: Tree
    top: Tree
    root: DataFrame

    @property
    def subroots(self) -> DataFrame:
        return self.rows.tops


def build_manifest(leaves: DataFrame, order: Sequence[str]) -> Manifest:
    """Persist the manifest of ``leaves`` (tree, digest, columns of ``order``, any others)."""
    scratch: list[str] = []
    rows = build(materialize(leaves, "merkle-hashed", scratch), order)
    subroots = materialize(rows.tops, "merkle-subroots", rows.scratch)
    over = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest")
    top = build(over, ["member"], "merkle-top")
    discard(leaves.sparkSession, scratch)
    return Manifest(rows, top, top.tops.select(F.col("digest").alias("root")))


def subroot_ways(manifest: Manifest) -> DataFrame:
    """The way of every subroot to the root, by its tree."""
    top = manifest.top
    start = top.tops.select("tree", F.lit(0).cast("long").alias("pos"), F.array().cast("array<int>").alias("places"),
                            F.array().cast("array<string>").alias("others"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    ways = _way_up(top.levels[0], _ways_down(top, start, "merkle-top"))
    members = top.levels[0].select("pos", "member", F.col("digest").alias("subroot"))
    return ways.drop("tree", "subroot").join(members, "pos").select(
        F.col("member").alias("tree"), F.lit(0).cast("long").alias("pos"), "places", "others", "subroot", "root")


def proofs(manifest: Manifest, keep: Sequence[str] = ("doc_id",), claimed: str | None = None) -> DataFrame:
    """Every row's proof: ``keep``, digest, subroot, root, places and others
    (the siblings of each level), proof_sha256 and folded_root.

    ``folded_root`` is recomputed from the leaf in column ``claimed`` (default:
    the stored digest) and the stored siblings."""
    tops = materialize(subroot_ways(manifest), "merkle-subroot-ways", manifest.top.scratch)
    above = _ways_down(manifest.rows, tops, "merkle-rows")
    leaves = manifest.rows.levels[0]
    kinds = dict(leaves.dtypes)
    kept = list(dict.fromkeys([*keep, "digest"]))
    out = ", ".join(f"{c} {kinds[c]}" for c in kept)
    out += ", subroot string, root string, places array<int>, others array<string>, proof_sha256 string, folded_root string"

    def run(group: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame(columns=[c.split()[0] for c in out.split(", ")])
        group, top = group.sort_values("pos"), top.iloc[0]
        up, rest = list(top["places"]), list(top["others"])
        tail = "".join(rest)
        places, others, digests, folded = [], [], [], []
        levels = subtree_levels(group["digest"].tolist(), int(group["n"].iloc[0]))
        for leaf, (place, beside) in zip(group[claimed or "digest"], subtree_paths(levels)):
            digests.append(_hash("".join(beside) + tail))
            places.append(place + up)
            others.append(beside + rest)
            folded.append(fold(leaf, places[-1], others[-1]))
        return group[kept].assign(subroot=top["subroot"], root=top["root"], places=places, others=others, proof_sha256=digests, folded_root=folded)

    columns = list(dict.fromkeys([*kept, *([claimed] if claimed else []), "tree", "pos", "n"]))
    parts = _in_subtrees(leaves.select(*columns))
    tops = above.withColumnRenamed("pos", "above")
    return parts.groupBy("tree", "above").cogroup(tops.groupBy("tree", "above")).applyInPandas(run, out)


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, claimed) of every document.

    ``claimed`` is the leaf of the row as someone might have changed it: where 3
    divides the CRC-32 of the decimal doc_id, with A-Z of the text lower-cased."""
    upper = "".join(map(chr, range(65, 91)))
    changed = {"text": F.translate("text", upper, upper.lower())}
    digest = leaf_hash([F.col(c) for c in LEAF_FIELDS])
    tampered = leaf_hash([changed.get(c, F.col(c)) for c in LEAF_FIELDS])
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(tree_key(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"),
                       F.when(F.coalesce(struck, F.lit(False)), tampered).otherwise(digest).alias("claimed"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and the root folded from the claimed row, of every document."""
    show_package(spark)
    manifest = build_manifest(document_leaves(table(spark, sf_dir, "documents")), ["doc_id", "digest"])
    shown = proofs(manifest, claimed="claimed")
    return shown.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(text: str) -> str:
    shown = [f"{c if c != 'text' else text}::VARCHAR" for c in LEAF_FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({s})::VARCHAR || ':' || {s}, '-')" for s in shown) + ")"


#: The twin builds every level, joins each row with the runs on its way, and folds step by step.
#: DuckDB has no CRC-32: it is computed from the polynomial's table of 256 numbers.
OP12_SQL = f"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
hashed AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_sql_leaf('text')} AS leaf,
         {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered,
         xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, crc_table),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER () AS doc, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM hashed),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // {ARITY}, sha256(string_agg(digest, '' ORDER BY pos)), (n + {ARITY - 1}) // {ARITY}
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // {ARITY}, n),
subroots AS MATERIALIZED (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // {ARITY}, sha256(string_agg(digest, '' ORDER BY pos)), (n + {ARITY - 1}) // {ARITY}
  FROM top WHERE n > 1 GROUP BY level, pos // {ARITY}, n),
ways AS MATERIALIZED (
  SELECT l.doc, x.level AS step, l.pos // ({ARITY} ** x.level)::BIGINT AS own, x.pos, x.digest FROM leaves l
  JOIN nodes x ON x.tree = l.tree AND x.n > 1 AND x.pos // {ARITY} = l.pos // ({ARITY} ** (x.level + 1))::BIGINT
  UNION ALL
  SELECT l.doc, 100 + x.level, s.pos // ({ARITY} ** x.level)::BIGINT, x.pos, x.digest FROM leaves l
  JOIN subroots s ON s.tree = l.tree JOIN top x ON x.n > 1 AND x.pos // {ARITY} = s.pos // ({ARITY} ** (x.level + 1))::BIGINT),
steps AS MATERIALIZED (
  SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY step) - 1 AS nth,
         coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos < own), '') AS before,
         coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos > own), '') AS after
  FROM ways GROUP BY doc, step),
folded AS (
  SELECT doc, 0 AS nth, CASE WHEN crc % 3 = 0 THEN lowered ELSE leaf END AS digest FROM leaves
  UNION ALL
  SELECT f.doc, f.nth + 1, sha256(before || digest || after) FROM folded f JOIN steps s ON s.doc = f.doc AND s.nth = f.nth),
proofs AS (SELECT doc, sha256(string_agg(before || after, '' ORDER BY nth)) AS proof_sha256 FROM steps GROUP BY doc)
SELECT l.doc_id, l.leaf, s.subroot, t.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.digest AS folded_root,
       f.digest = t.digest AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN (SELECT digest FROM top WHERE n = 1) t ON true
LEFT JOIN proofs p ON p.doc = l.doc
JOIN (SELECT doc, digest FROM folded QUALIFY nth = max(nth) OVER (PARTITION BY doc)) f ON f.doc = l.doc
"""
