"""Exact top-k inner product search by a Voronoi kNN join (operator 2).

1. ``PIVOTS`` vectors (smallest id hashes, a bounded sample) split the space;
   every vector goes to the cell of its nearest pivot.
2. Summaries: each cell keeps its k+1 vectors nearest to the pivot. A query's
   scores against all these (at most PIVOTS x (k+1) vectors) give a floor: its
   k-th best score is at least that. Each query cell keeps its number of
   queries, largest distance R from the pivot p, and smallest floor.
3. For a query q of a cell and any vector x, q.x = p.x + (q-p).x, at most
   p.x + R |x|. A data vector is sent to a query cell only if this reaches the
   cell's floor, so nothing that could be among the k best is left out.
4. Query cells are packed into groups of at most ``GROUP_QUERIES`` queries
   (larger cells are split); a group's data is dealt into blocks by id hash,
   so no task holds more than about ``BLOCK_ROWS`` vectors however large a
   cell is. Each block is solved by one matrix product, and what reaches the
   queries' floors is ranked by Spark.

Vectors that are unlike each other in direction cannot be pruned by any
bound; the groups keep the copies of a vector to one for each
``GROUP_QUERIES`` queries then.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows without id. Scores beyond 64 bits are held to the
largest (smallest) long, and rank as such. Only vectors of equal length are
compared. Equal scores go to the smaller id. Rows with the query's id are its
own; other repeated rows are candidates as often as they appear; repeated
query rows are answered once. With fewer than k candidates all are returned.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clinlake.llm.common import materialize, table

K = 10
PIVOTS = 64
GROUP_QUERIES = 4096
BLOCK_ROWS = 2048
#: Relative slack of the bounds, far above the rounding of their sums.
SLACK = 1e-9
#: Up to here sums of whole numbers are exact in double precision.
EXACT = float(1 << 53)


#: Larger components are held to this, so that no square of theirs overflows.
LARGEST = 2.0**300


def whole_vector(vector: Column) -> Column:
    """Components floor(1024 x) as doubles; null unless all are finite."""
    def whole(x: Column) -> Column:
        scaled = F.greatest(F.least(x.cast("double") * 1024.0, F.lit(LARGEST)), F.lit(-LARGEST))
        # doubles from 2**53 on are whole numbers, which need not fit a long
        return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled)

    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(vector, whole))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, 0))


def _whole_numbers(m: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exact whole numbers (clipped to 64 bits)."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if most < EXACT:
        return (a @ b.T).astype("int64")
    exact = _whole_numbers(a) @ _whole_numbers(b).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype("int64")


def _lengths(pdf: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    for n, own in pdf.groupby(pdf["v"].map(len)):
        yield int(n), own


def _by_length(rows: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of the collected rows of each vector length."""
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(len(r["v"]), []).append((r["id"], r["v"]))
    return {n: (np.array([i for i, _ in own]), np.array([v for _, v in own], "float64").reshape(len(own), n)) for n, own in out.items()}


def _assign(vectors: DataFrame, pivots: dict) -> DataFrame:
    """Adds ``cell`` (length and pivot) and ``far``, the distance to the pivot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for n, own in _lengths(pdf):
                m, p = _matrix(own["v"]).reshape(len(own), n), pivots[n][1]
                squared = (m * m).sum(1)[:, None] - 2 * (m @ p.T) + (p * p).sum(1)[None, :]
                cell = squared.argmin(1)
                far = np.linalg.norm(m - p[cell], axis=1)
                yield own.assign(cell=n * PIVOTS + cell, far=far)[["id", "v", "is_query", "cell", "far"]]

    return vectors.mapInPandas(run, "id long, v array<double>, is_query boolean, cell long, far double")


def _with_floor(queries: DataFrame, summary: dict, k: int) -> DataFrame:
    """Adds ``floor``: the k-th best score against the summary vectors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for n, own in _lengths(pdf):
                ids, m = summary[n]
                scores = _scores(_matrix(own["v"]).reshape(len(own), n), m).astype("float64")
                scores[own["id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
                floor = -np.sort(-scores, axis=1)[:, k - 1] if scores.shape[1] >= k else np.full(len(own), -np.inf)
                yield own.assign(floor=floor)

    return queries.mapInPandas(run, "id long, v array<double>, cell long, far double, floor double")


def _groups(cells: list, group_queries: int) -> dict[int, list[int]]:
    """The query groups of each query cell: small cells share one, large ones get several."""
    out: dict[int, list[int]] = {}
    group, held = -1, group_queries
    for r in sorted(cells, key=lambda r: (r["cell"] // PIVOTS, r["n"], r["cell"])):
        length = r["cell"] // PIVOTS
        if r["n"] > group_queries:
            parts = -(-r["n"] // group_queries)
            out[r["cell"]] = list(range(group + 1, group + 1 + parts))
            group, held = group + parts, group_queries
        elif held + r["n"] > group_queries or not out or length != last:
            group, held = group + 1, r["n"]
            out[r["cell"]] = [group]
        else:
            held += r["n"]
            out[r["cell"]] = [group]
        last = length
    return out


def _replicate(data: DataFrame, pivots: dict, cells: list, groups: dict[int, list[int]]) -> DataFrame:
    """Each data vector once for every query group whose bound it reaches."""
    by_length: dict[int, list] = {}
    for r in cells:
        by_length.setdefault(r["cell"] // PIVOTS, []).append(r)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for n, own in _lengths(pdf):
                needed = by_length.get(n, [])
                if not needed:
                    continue
                m = _matrix(own["v"]).reshape(len(own), n)
                p = pivots[n][1][[r["cell"] % PIVOTS for r in needed]]
                radius = np.array([r["radius"] for r in needed])
                floor = np.array([r["floor"] for r in needed])
                reach = radius[None, :] * np.linalg.norm(m, axis=1)[:, None]
                bound = m @ p.T + reach
                slack = SLACK * (np.abs(bound) + reach + np.linalg.norm(m, axis=1)[:, None] * np.linalg.norm(p, axis=1)[None, :] + 1)
                reached = bound + slack >= floor[None, :]
                for g in sorted({g for r in needed for g in groups[r["cell"]]}):
                    own_cells = [i for i, r in enumerate(needed) if g in groups[r["cell"]]]
                    hit = reached[:, own_cells].any(1)
                    if hit.any():
                        yield own.loc[hit, ["id", "v"]].assign(grp=g)

    return data.select("id", "v").mapInPandas(run, "id long, v array<double>, grp long")


def _solve(k: int):
    def run(key, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []})
        if not len(queries) or not len(block):
            return empty
        block = block.sort_values("id", kind="stable")
        ids = block["id"].to_numpy()
        scores = _scores(_matrix(queries["v"]).reshape(len(queries), -1), _matrix(block["v"]).reshape(len(block), -1))
        found = []
        for q, floor, own, row in zip(queries["id"], queries["floor"], queries["query"], scores):
            rows = np.flatnonzero((row >= floor) & (ids != q))
            if len(rows) > k:  # ids ascend, so a stable sort breaks ties by them
                rows = rows[np.argsort(-row[rows].astype("float64"), kind="stable")[:k]] if np.abs(row).max() < EXACT else np.array(
                    sorted(rows, key=lambda i: (-int(row[i]), int(ids[i])))[:k])
            found.append(pd.DataFrame({"query_id": q, "query": own, "vec_id": ids[rows], "score": row[rows]}))
        return pd.concat(found) if found else empty

    return run


def top_k(vectors: DataFrame, k: int = K, pivot_count: int = PIVOTS, group_queries: int = GROUP_QUERIES,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k best (query_id, rank, vec_id, score) of every query.

    ``vectors`` has id (long), v (array of whole doubles, not null) and is_query.
    """
    schema = "query_id long, rank int, vec_id long, score long"
    spark = vectors.sparkSession
    pivot_count = min(pivot_count, PIVOTS)
    sampled = vectors.select("id", "v", F.size("v").alias("n"))
    # the pivots of every length that queries have: a bounded sample by id hash
    lengths = [r["n"] for r in vectors.filter("is_query").select(F.size("v").alias("n")).distinct().limit(1001).collect()]
    if not lengths:
        return spark.createDataFrame([], schema)
    if len(lengths) > 1000:
        raise ValueError("queries of more than 1000 different lengths")
    by_hash = Window.partitionBy("n").orderBy(F.xxhash64("id"), "id")
    chosen = sampled.filter(F.col("n").isin(lengths)).withColumn("at", F.row_number().over(by_hash)).filter(F.col("at") <= pivot_count)
    pivots = _by_length(chosen.sort("id").collect())
    placed = materialize(_assign(vectors.filter(F.size("v").isin(lengths)), pivots), "topk-placed")
    nearest = Window.partitionBy("cell").orderBy("far", "id")
    summary = _by_length(placed.withColumn("at", F.row_number().over(nearest)).filter(F.col("at") <= k + 1).select("id", "v").collect())
    queries = placed.filter("is_query").select("id", "v", "cell", "far").dropDuplicates(["id", "v"])
    queries = materialize(_with_floor(queries, summary, k), "topk-queries")
    cells = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"), F.min("floor").alias("floor")).collect()
    groups = _groups(cells, group_queries)
    data = materialize(_replicate(placed, pivots, cells, groups), "topk-data")
    sizes = {r["grp"]: r["n"] for r in data.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], schema)
    blocks = F.create_map(*[F.lit(x).cast("long") for g, n in sizes.items() for x in (g, -(-n // block_rows))])
    own_groups = F.create_map(*[x for c, g in groups.items() for x in (F.lit(c).cast("long"), F.array(*[F.lit(i).cast("long") for i in g]))])
    members = own_groups[F.col("cell")]
    asked = queries.select("id", "v", "floor", F.xxhash64("v").alias("query"),
                           F.get(members, F.pmod(F.xxhash64("id"), F.size(members)).cast("int")).alias("grp"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks[F.col("grp")] - 1)))
    dealt = data.withColumn("block", F.pmod(F.xxhash64("id"), blocks[F.col("grp")]))
    found = asked.groupBy("grp", "block").cogroup(dealt.groupBy("grp", "block")).applyInPandas(
        _solve(k), "query_id long, query long, vec_id long, score long")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all rows for every query row (id divisible by 100)."""
    rows = table(spark, sf_dir, "embeddings").filter("vec_id is not null")
    vectors = rows.select(F.col("vec_id").cast("long").alias("id"), whole_vector(F.col("embedding")).alias("v"),
                          (F.col("vec_id") % 100 == 0).alias("is_query"))
    return top_k(vectors.filter("v is not null"))


OP2_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""
