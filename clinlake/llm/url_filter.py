"""URL filters by a Bloom filter cascade (operator 9, DataFrame functions only).

A rule is a (host, path, verdict) triple. It fits a url when the url's host is
the rule's host or one of its subdomains and the url's path starts with the
rule's path; of the rules that fit, the longest (host and path together, then
host) decides.

A url that fits a rule contains the rule's key ``host + path`` at one of a few
places: the last *d* labels of its host followed by the first *l* code points
of its path, for the (d, l) shapes that occur in the rules. So each url has a
handful of candidate keys, and judging it means asking which of them are
listed. That question is answered exactly, without a join, by a cascade: level
0 is a Bloom filter of the listed keys; the unlisted candidate keys of the
whole corpus that pass it are its false positives, and level 1 is a filter of
those; level 2 holds the listed keys that pass level 1, and so on until no key
passes by mistake. Since the corpus's complete key universe was used to build
it, the answer is exact for every url of the corpus.

The filters are sized from the number of listed keys (``BITS_PER_KEY``) and go
into the scan as scalar subqueries. Beyond ``max_filter_bytes`` no filter is
shipped: the candidate keys then meet the rules in shuffle joins.

Rules come as a table of any size; only their shapes and numbers pass the
driver. Repeated rules count once, rules with a null are left out, and of two
verdicts for one rule the later in the alphabet holds.

Null, empty or malformed urls (no ``://``) have an empty host and path and fit
no rule; a url that fits none is not listed, and the verdict is ``default``.
Rows are kept as they are: repeated rows stay repeated, extra columns are
ignored by the query, an empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinlake.llm.common import materialize, table

BITS_PER_KEY = 12
HASHES = 6
MAX_FILTER_BYTES = 32 << 20


@dataclasses.dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path

    @property
    def shape(self) -> tuple[int, int]:
        return self.host.count(".") + 1, len(self.path)


#: The rules of the registered query (fixed values).
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def url_host(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def candidate_key(host: Column, path: Column, shape: tuple[int, int]) -> Column:
    """The key of this shape in a url, null where its host or path is too short."""
    labels, length = shape
    dots = F.char_length(host) - F.char_length(F.replace(host, F.lit("."), F.lit("")))
    fits = (host != "") & (dots >= labels - 1) & (F.char_length(path) >= length)
    return F.when(fits, F.concat(F.substring_index(host, ".", -labels), F.left(path, F.lit(length))))


class Cascade:
    """Alternating Bloom filters: even levels hold listed keys, odd levels the
    unlisted keys that passed the level before."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []  # bits, one row with the filter's words

    def passes(self, level: int, key: Column) -> Column:
        bits, filters = self.levels[level]
        words = filters.scalar()
        hit = F.lit(True)
        for i in range(HASHES):
            at = _bit(key, level, i, bits)
            word = F.get(words, F.floor(at / 64).cast("int"))
            hit = hit & (F.call_function("shiftright", word, (at % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1)
        return hit

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe the cascade was built over."""
        if not self.levels:
            return F.lit(False)
        listed = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            listed = F.when(self.passes(level, key), listed).otherwise(F.lit(level % 2 == 1))
        return key.isNotNull() & listed


def _bit(key: Column, level: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), F.lit(i), key), F.lit(bits).cast("long"))


def _filter_bits(n_keys: int) -> int:
    return max(64, -(-n_keys * BITS_PER_KEY // 64) * 64)


def _filter_words(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row: the filter's 64-bit words in order."""
    spark = keys.sparkSession
    at = F.explode(F.array(*[_bit(F.col("key"), level, i, bits) for i in range(HASHES)]))
    one = F.lit(1).cast("long")
    word_bits = keys.select(at.alias("at")).select(
        F.floor(F.col("at") / 64).cast("long").alias("word"),
        F.call_function("shiftleft", one, (F.col("at") % 64).cast("int")).alias("bit"),
    )
    empty = spark.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    words = word_bits.unionByName(empty).groupBy("word").agg(F.bit_or("bit").alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "value")))
    return words.agg(F.transform(ordered, lambda w: w["value"]).alias("words"))


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of the ``listed`` keys over all keys of ``universe`` (column ``key``).

    Every level's key set is written to the shared folder; the sets shrink by
    the filters' false positive rate, so a few levels end it.
    """
    cascade = Cascade()
    inside = materialize(listed.distinct(), "cascade-listed")
    outside = universe
    held, n_held = inside, inside.count()
    while n_held:
        level = len(cascade.levels)
        bits = _filter_bits(n_held)
        cascade.levels.append((bits, materialize(_filter_words(held, level, bits), "cascade-filter")))
        passed = (outside if level % 2 == 0 else inside).filter(cascade.passes(level, F.col("key")))
        if level == 0:
            passed = passed.distinct().join(inside, "key", "left_anti")
        held = materialize(passed, "cascade-passed")
        if level % 2 == 0:
            outside = held
        else:
            inside = held
        n_held = held.count()
    return cascade


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] | DataFrame = RULES,
    default: str = "allow",
    url: str = "url",
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``pages`` with the columns host, path, rule and verdict added (or replaced).

    ``rules`` are a few ``Rule``s, or a DataFrame (host, path, verdict) of any size."""
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = pages.select(*kept, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    listed = _listed(pages.sparkSession, rules)
    # a row for each verdict and shape: few, however many rules there are
    groups = listed.groupBy("verdict", "labels", "length").agg(F.count(F.lit(1)).alias("n")).collect()
    shapes = sorted({(r["labels"], r["length"]) for r in groups})
    if _filter_bits(sum(r["n"] for r in groups)) // 8 > max_filter_bytes:
        return _judge_by_joins(parts, listed, shapes, default)
    host, path = F.col("host"), F.col("path")
    universe = parts.select(F.explode(F.array(*[candidate_key(host, path, s) for s in shapes])).alias("key")) if shapes else None
    parts = parts.select("*", *[candidate_key(host, path, s).alias(f"__key{n}") for n, s in enumerate(shapes)])
    found = []
    for verdict in sorted({r["verdict"] for r in groups}):
        cascade = build_cascade(listed.filter(F.col("verdict") == verdict).select("key"), universe.filter("key is not null"))
        for n in sorted({shapes.index((r["labels"], r["length"])) for r in groups if r["verdict"] == verdict}):
            key = F.col(f"__key{n}")
            found.append(F.when(cascade.contains(key), _match(key, F.lit(shapes[n][1]), F.lit(verdict))))
    return _decide(parts, kept, found, default)


def _listed(spark: SparkSession, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    """The rules as a written table (key, verdict, labels, length)."""
    if not isinstance(rules, DataFrame):
        given = F.array(*[F.struct(F.lit(r.host).alias("host"), F.lit(r.path).alias("path"), F.lit(r.verdict).alias("verdict")) for r in rules])
        rules = spark.range(1).select(F.inline(given.cast("array<struct<host:string,path:string,verdict:string>>")))
    host, path = F.col("host"), F.col("path")
    labels = F.char_length(host) - F.char_length(F.replace(host, F.lit("."), F.lit(""))) + 1
    rows = rules.filter("host is not null and path is not null and verdict is not null")
    rows = rows.select(F.concat(host, path).alias("key"), "verdict", labels.alias("labels"), F.char_length(path).alias("length"))
    return materialize(rows.distinct(), "rules")


def _match(key: Column, path_length: Column, verdict: Column) -> Column:
    size = F.char_length(key)
    return F.struct(size.alias("size"), (size - path_length).alias("host_size"), key.alias("key"), verdict.alias("verdict"))


def _decide(df: DataFrame, kept: list[str], found: list[Column], default: str) -> DataFrame:
    best = F.array_max(F.array(*found)) if found else None
    if best is None:
        return df.select(*kept, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    return df.select("*", best.alias("__best")).select(
        *kept, "host", "path",
        F.col("__best.key").alias("rule"),
        F.coalesce(F.col("__best.verdict"), F.lit(default)).alias("verdict"),
    )


def _judge_by_joins(parts: DataFrame, listed: DataFrame, shapes: list[tuple[int, int]], default: str) -> DataFrame:
    """For lists whose filters would be too large to ship: one equi-join per shape.

    The rules are a written table, so Spark splits the partitions of a hot host."""
    kept = [c for c in parts.columns if c not in ("host", "path")]
    one = listed.groupBy("key", "labels", "length").agg(F.max("verdict").alias("verdict"))  # as of two verdicts for one rule the cascade decides
    df, found = parts, []
    for n, (labels, length) in enumerate(shapes):
        k, v = f"__k{n}", f"__v{n}"
        own = one.filter((F.col("labels") == labels) & (F.col("length") == length)).select(F.col("key").alias(k), F.col("verdict").alias(v))
        df = df.join(own, candidate_key(F.col("host"), F.col("path"), (labels, length)) == F.col(k), "left")
        found.append(F.when(F.col(k).isNotNull(), _match(F.col(k), F.lit(length), F.col(v))))
    return _decide(df, kept, found, default)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every ``pages`` url under the fixed rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = """
WITH parts AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
urls AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
judged AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
         END AS rule
  FROM urls)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
