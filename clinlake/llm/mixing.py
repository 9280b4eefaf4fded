"""Mixing sources to target weights (operator 1, DataFrame functions only).

Documents fall into cells of (source, language, topic). Iterative proportional
fitting rakes the cells' token weights until their sums over each dimension
meet that dimension's target shares; a document is then drawn with a
probability proportional to its cell's raked weight per token.

* Targets: the share of a category is proportional to its tokens to the power
  ``alpha`` (below 1: small sources, languages and topics gain), or given
  outright as a table (category, share). Given shares are scaled to the
  categories that have tokens.
* Raking works on the cells, one row for each combination that occurs. Each
  step scales the cells of a dimension by target over current sum (a window
  sum over cells, not documents); the cells are written to the shared folder
  every few rounds, and raking ends when all shares are within ``TOLERANCE``.
* Targets can conflict (if each source has one language, say): no weights meet
  them all, and raking stalls. The weights are then those of least summed
  divergence of the targets from the shares; ``remaining_errors`` gives what is
  left, for each category of each dimension.
* Drawing: probability = min(1, kappa * weight / tokens) with kappa chosen so
  that the expected tokens are ``budget`` of all tokens. Cells that reach 1
  are taken whole and kappa is solved for the others, so the budget stays
  exact in expectation. The document is drawn when a uniform number from the
  md5 of its id is below its probability: the same documents on every run.
* ``weight`` is the factor (raked share over drawn share, per token) that
  makes the weighted sample meet the targets in expectation also where
  probabilities were cut at 1.

There is no topic column in the given tables: the topic here is the form of
the text (``table``, ``short``, ``long``, ``prose``), see ``form_topic``.

Defined results: null source or language is a category of its own; null or
empty texts have no tokens; cells without tokens have probability 0; rows that
share a doc_id share their draw; rows without doc_id are drawn by the md5 of
the empty string; an empty table gives an empty result. Extra columns, and
columns named like the results, are kept by ``draw`` unless they clash, then
replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clinlake.llm.common import materialize, table

DIMENSIONS = ("source", "lang", "topic")
ALPHA = 0.5
BUDGET = 0.5
#: Raking ends when every share is this near its target, at the latest after ROUNDS rounds ...
TOLERANCE = 1e-10
ROUNDS = 400
ROUNDS_PER_WRITE = 4
#: ... or when the rounds between two writes leave more than this part of the error: then the targets conflict.
STALLED = 0.9
#: Rounds of the SQL twin, enough for the given tables to converge far below its six decimals.
SQL_ROUNDS = 80
KAPPA_STEPS = 32
SEED = "mix-1:"
#: Cells are broadcast to the documents up to this many; beyond it they are joined by a shuffle.
MAX_BROADCAST_CELLS = 50_000
DRAW_BITS = 52

WORD = "[^\\x20\\x09-\\x0D]+"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def form_topic(text: Column, n_tokens: Column) -> Column:
    """The form of a text, standing in for its topic."""
    return (F.when(F.instr(text, " | ") > 0, "table").when(n_tokens < 100, "short")
            .when(n_tokens >= 1000, "long").otherwise("prose"))


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id alone."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("long") / F.lit(float(1 << DRAW_BITS))


def cell_tokens(features: DataFrame, dimensions=DIMENSIONS) -> DataFrame:
    """Tokens of every cell (partial sums before the shuffle, so a hot source is a row for each task)."""
    return features.groupBy(*dimensions).agg(F.sum("n_tokens").cast("double").alias("tokens")).filter("tokens > 0")


def target_shares(cells: DataFrame, dimension: str, alpha: float) -> DataFrame:
    powers = cells.groupBy(dimension).agg(F.pow(F.sum("tokens"), F.lit(alpha)).alias("power"))
    return powers.select(dimension, (F.col("power") / F.sum("power").over(_all())).alias("share"))


def _all() -> Window:
    return Window.partitionBy(F.lit(0))  # over categories of one dimension, after aggregation


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``weight``: raked shares of all tokens (they sum to 1)."""
    dims = list(targets)
    for d, given in targets.items():
        share = given.select(F.col(d).alias("__d"), F.col("share").cast("double").alias(f"__{d}"))
        cells = cells.join(share, F.col(d).eqNullSafe(F.col("__d"))).drop("__d")
    # shares of the categories that occur
    cells = materialize(cells, "mix-cells")
    for d in dims:
        present = cells.groupBy(d).agg(F.first(f"__{d}").alias("s")).agg(F.sum("s").alias("s")).first()["s"] or 1.0
        cells = cells.withColumn(f"__{d}", F.col(f"__{d}") / F.lit(present))
    weighted = cells.withColumn("weight", F.col("tokens") / F.sum("tokens").over(_all()))
    before = float("inf")
    for done in range(0, rounds, ROUNDS_PER_WRITE):
        for _ in range(min(ROUNDS_PER_WRITE, rounds - done)):
            for d in dims:
                now = F.sum("weight").over(Window.partitionBy(d))
                weighted = weighted.withColumn("weight", F.col("weight") * F.col(f"__{d}") / now)
        weighted = materialize(weighted, "mix-raked")
        error = _largest_error(weighted, dims)
        if error <= TOLERANCE:
            break
        if error > STALLED * before:
            weighted = _compromise(weighted, dims, rounds)
            break
        before = error
    return weighted.drop(*[f"__{d}" for d in dims])


def _largest_error(weighted: DataFrame, dims: list[str]) -> float:
    """The largest distance of a category's share from its target, over all dimensions."""
    parts = [weighted.groupBy(d).agg(F.abs(F.sum("weight") - F.first(f"__{d}")).alias("error")).agg(F.max("error").alias("error")) for d in dims]
    return reduce(DataFrame.unionByName, parts).agg(F.max("error")).first()[0] or 0.0


def _compromise(weighted: DataFrame, dims: list[str], rounds: int) -> DataFrame:
    """Weights for targets that no weights meet together: cells are scaled by the mean of
    what their dimensions ask for, which lowers the summed divergence of the targets
    from the shares in every round and ends where it is least."""
    divergence, before = F.lit(0.0), float("inf")
    for d in dims:
        now = F.sum("weight").over(Window.partitionBy(d))
        # a category's term once for each of its cells, weighted to count once
        divergence = divergence + F.col("weight") / now * F.col(f"__{d}") * F.log(F.col(f"__{d}") / now)
    for done in range(0, rounds, ROUNDS_PER_WRITE):
        for _ in range(min(ROUNDS_PER_WRITE, rounds - done)):
            factor = F.lit(0.0)
            for d in dims:
                factor = factor + F.col(f"__{d}") / F.sum("weight").over(Window.partitionBy(d)) / len(dims)
            weighted = weighted.withColumn("weight", F.col("weight") * factor)  # they still sum to 1
        weighted = materialize(weighted, "mix-raked")
        left = weighted.select(divergence.alias("left")).agg(F.sum("left")).first()[0] or 0.0
        if before - left <= TOLERANCE:
            break
        before = left
    return weighted


def remaining_errors(raked: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """(dimension, category, target, share, error) of every category that has tokens:
    how far the raked shares are from the targets (scaled to these categories)."""
    parts = []
    for d, given in targets.items():
        share = given.select(F.col(d).alias("__d"), F.col("share").cast("double").alias("target"))
        sums = raked.groupBy(d).agg(F.sum("weight").alias("share")).join(share, F.col(d).eqNullSafe(F.col("__d")))
        target = F.col("target") / F.sum("target").over(_all())
        parts.append(sums.select(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("category"), target.alias("target"), "share",
                                 (F.col("share") - target).alias("error")))
    return reduce(DataFrame.unionByName, parts)


def calibrate(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``raked`` with ``probability`` and ``factor`` of every cell.

    kappa rises step by step: the cells it saturates leave the sums it is
    solved from. Each step is one aggregate of the cells.
    """
    total = raked.agg(F.sum("tokens").alias("t")).first()["t"]
    if total is None:
        return raked.withColumn("probability", F.lit(0.0)).withColumn("factor", F.lit(0.0))
    ratio = F.col("weight") * total / F.col("tokens")
    kappa, full = 0.0, -1.0
    for _ in range(KAPPA_STEPS):
        taken = F.lit(kappa) * ratio >= 1.0
        sums = raked.agg(F.sum(F.when(taken, F.col("tokens")).otherwise(0.0)).alias("full"),
                         F.sum(F.when(taken, 0.0).otherwise(F.col("weight") * total)).alias("rest")).first()
        if sums["full"] == full or not sums["rest"]:
            break
        full = sums["full"]
        kappa = (budget * total - full) / sums["rest"]
    chance = F.least(F.lit(1.0), F.lit(kappa) * ratio)
    return raked.withColumn("probability", chance).withColumn("factor", ratio / F.col("probability"))


def draw(features: DataFrame, cells: DataFrame, dimensions=DIMENSIONS, seed: str = SEED) -> DataFrame:
    """The drawn rows of ``features`` with ``probability`` and ``weight``.

    A document whose cell is missing (no tokens) is never drawn."""
    kept = [c for c in features.columns if c.lower() not in ("probability", "weight")]
    chances = cells.select(*[F.col(d).alias(f"__{d}") for d in dimensions], "probability", F.col("factor").alias("weight"))
    same = [F.col(d).eqNullSafe(F.col(f"__{d}")) for d in dimensions]
    if cells.count() <= MAX_BROADCAST_CELLS:
        chances = F.broadcast(chances)
    drawn = features.select(*kept).join(chances, same).filter(uniform(F.col("doc_id"), seed) < F.col("probability"))
    return drawn.select(*kept, "probability", "weight")


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``topic`` from the whole text."""
    kept = [c for c in docs.columns if c.lower() not in ("n_tokens", "topic")]
    counted = docs.select(*kept, token_count(F.col("text")).alias("n_tokens"))
    return counted.select("*", form_topic(F.col("text"), F.col("n_tokens")).alias("topic"))


def mix(docs: DataFrame, alpha: float = ALPHA, budget: float = BUDGET, rounds: int = ROUNDS,
        targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """A sample of ``docs`` whose expected token shares meet the targets."""
    features = with_features(docs)
    cells = materialize(cell_tokens(features), "mix-tokens")
    shares = {d: (targets or {}).get(d, target_shares(cells, d, alpha)) for d in DIMENSIONS}
    return draw(features, materialize(calibrate(rake(cells, shares, rounds), budget), "mix-chances"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn documents with their probabilities and weights."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mix(docs).select("doc_id", "source", "lang", "topic", "n_tokens",
                            F.round("probability", 6).alias("probability"), F.round("weight", 6).alias("weight"))


def _oracle_sql() -> str:
    steps, last = [], "w0"
    for r in range(SQL_ROUNDS):
        for d in DIMENSIONS:
            name = f"w{r + 1}_{d}"
            steps.append(f"""{name} AS MATERIALIZED (
  SELECT source, lang, topic, tokens, t_source, t_lang, t_topic,
         weight * t_{d} / sum(weight) OVER (PARTITION BY {d}) AS weight FROM {last})""")
            last = name
    targets = ",\n".join(
        f"t_{d} AS MATERIALIZED (SELECT {d}, p / sum(p) OVER () AS share FROM "
        f"(SELECT {d}, pow(sum(tokens), {ALPHA}) AS p FROM cells GROUP BY {d}))" for d in DIMENSIONS)
    return f"""
WITH counted AS MATERIALIZED (
  SELECT doc_id, text, source, lang,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
features AS MATERIALIZED (
  SELECT doc_id, source, lang, n_tokens,
         CASE WHEN strpos(text, ' | ') > 0 THEN 'table' WHEN n_tokens < 100 THEN 'short'
              WHEN n_tokens >= 1000 THEN 'long' ELSE 'prose' END AS topic FROM counted),
cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM features GROUP BY ALL HAVING sum(n_tokens) > 0),
{targets},
w0 AS MATERIALIZED (
  SELECT c.source, c.lang, c.topic, tokens, s.share AS t_source, l.share AS t_lang, o.share AS t_topic,
         tokens / sum(tokens) OVER () AS weight
  FROM cells c JOIN t_source s ON c.source IS NOT DISTINCT FROM s.source
  JOIN t_lang l ON c.lang IS NOT DISTINCT FROM l.lang JOIN t_topic o ON c.topic = o.topic),
{(',' + chr(10)).join(steps)},
ratios AS MATERIALIZED (
  SELECT *, weight * sum(tokens) OVER () / tokens AS ratio, sum(tokens) OVER () AS total FROM {last}),
ordered AS MATERIALIZED (
  SELECT *, coalesce(sum(tokens) OVER (ORDER BY ratio DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
         sum(weight * total) OVER (ORDER BY ratio DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM ratios),
solved AS (
  SELECT arg_max(({BUDGET} * total - above) / rest, ratio) FILTER (WHERE ({BUDGET} * total - above) / rest * ratio < 1) AS kappa
  FROM ordered),
chances AS (
  SELECT source, lang, topic, least(1.0, kappa * ratio) AS probability, ratio / least(1.0, kappa * ratio) AS weight
  FROM ratios, solved)
SELECT f.doc_id, f.source, f.lang, f.topic, f.n_tokens,
       round(c.probability, 6) AS probability, round(c.weight, 6) AS weight
FROM features f JOIN chances c
  ON f.source IS NOT DISTINCT FROM c.source AND f.lang IS NOT DISTINCT FROM c.lang AND f.topic = c.topic
WHERE ('0x' || md5('{SEED}' || coalesce(f.doc_id::VARCHAR, ''))[:{DRAW_BITS // 4}])::BIGINT / {float(1 << DRAW_BITS)!r} < c.probability
"""


OP1_SQL = _oracle_sql()
