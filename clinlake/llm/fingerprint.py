"""Document fingerprints by closed syncmers (operator 3, DataFrame functions only).

A text is cut into tokens: runs without ASCII white space, in pieces of
``TOKEN_CHARS`` code points. Runs of more than ``WORD_CHARS`` code points (text
without blanks, long urls, base64) give the overlapping piece at every code
point instead, so that a passage inside them has the same tokens wherever it
starts; shorter runs count as words, one or two tokens that an edit inside may
change. Of its k-mers of ``K`` consecutive
tokens the closed syncmers are kept: those whose minimal inner s-mer
(``S`` = 2 consecutive tokens, ordered by hash) is the first or the last one.
Whether a k-mer is chosen depends on its own tokens alone, so equal passages
choose equal k-mers whatever surrounds them: ``syncmers`` gives them with
their token positions, as anchors for positional matching. A fingerprint is
the bottom ``SKETCH`` of the distinct syncmer hashes, written in hex; the
likeness of two fingerprints is the bottom-k estimate of the Jaccard index of
their syncmer sets.

Defined results: a null text counts as empty; a text without a syncmer (fewer
than K tokens, or none chosen) is fingerprinted by one hash of all its tokens;
equal texts have equal fingerprints, and two texts without tokens have
likeness 1. Rows that share a doc_id follow each other ordered by text, rows
without doc_id come first. A table of one row is its own next document, an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clinlake.llm.common import shuffle_partitions, table

TOKEN_CHARS = 8
#: Longer runs are no words: their pieces overlap.
WORD_CHARS = 16
K = 5
S = 2
SKETCH = 64
#: Hashes are cut to 48 bits: 12 hex digits each.
HASH_MASK = (1 << 48) - 1
#: Ordered buckets for each shuffle partition (next-document lookup).
BUCKETS_PER_PARTITION = 4
FINE = 64
SEATS = "array<struct<b:int,ghost:int>>"


def _token_columns(df: DataFrame, text: str) -> DataFrame:
    """Adds ``__tok`` (tokens) and ``__smer`` (hash of each S = 2 consecutive tokens)."""
    run = "[^\\x20\\x09-\\x0D]"
    pattern = f"{run}{{{WORD_CHARS + 1},}}|{run}{{1,{TOKEN_CHARS}}}"  # long runs whole, others in pieces
    df = df.withColumn("__tok", F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    long = lambda t: F.char_length(t) > TOKEN_CHARS
    overlapping = lambda t: F.regexp_extract_all(t, F.lit(f"(?s)(?=(.{{{TOKEN_CHARS}}}))."), F.lit(1))
    cut = F.flatten(F.transform("__tok", lambda t: F.when(long(t), overlapping(t)).otherwise(F.array(t))))
    df = df.withColumn("__tok", F.when(F.exists("__tok", long), cut).otherwise(F.col("__tok")))
    return df.withColumn("__smer", F.expr(
        "transform(slice(__tok, 2, greatest(size(__tok) - 1, 0)), (x, i) -> xxhash64(__tok[i], x))"))


def _syncmer_hashes() -> Column:
    # K - S + 1 = 4 inner s-mers: the minimum lies at an edge when the smaller
    # edge is not above the smaller inner one; s-mers 0, 2 and 3 cover all 5 tokens
    return F.expr(f"""
        transform(slice(__smer, 1, greatest(size(__tok) - {K} + 1, 0)), (x, i) ->
          if(least(x, __smer[i + 3]) <= least(__smer[i + 1], __smer[i + 2]),
             xxhash64(x, __smer[i + 2], __smer[i + 3]) & {HASH_MASK}L, null))""")


def syncmers(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``anchors``: array of (position, hash) of the text's closed syncmers."""
    df = _token_columns(docs.withColumn("__text", F.coalesce(F.col(text), F.lit(""))), "__text")
    hashes = F.transform(_syncmer_hashes(), lambda h, i: F.struct(i.alias("position"), h.alias("hash")))
    anchors = F.filter(hashes, lambda a: a["hash"].isNotNull())
    return df.withColumn("anchors", anchors).drop("__text", "__tok", "__smer")


def add_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the ascending bottom-k hashes of a non-null text column."""
    df = _token_columns(df, text).withColumn("__sync", F.array_compact(_syncmer_hashes()))
    whole = F.array(F.xxhash64(F.col("__tok")).bitwiseAND(F.lit(HASH_MASK)))
    bottom = F.slice(F.sort_array(F.array_distinct(F.col("__sync"))), 1, SKETCH)
    df = df.withColumn(out, F.when(F.size("__sync") == 0, whole).otherwise(bottom))
    return df.drop("__tok", "__smer", "__sync")


def fingerprint_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 12, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the union's bottom-k hashes that both sketches hold."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    return F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)


def with_next_row(df: DataFrame, order: str, tie: str, carry: list[str]) -> DataFrame:
    """``df`` with ``next``: the ``carry`` columns of the row that follows by
    (``order``, ``tie``); the first row follows the last.

    Rows are dealt into ordered buckets whose bounds are quantiles of the
    ``order`` column alone (a few longs for each shuffle partition). Rows with
    a bucket's smallest value are also sent, as ghosts, to the bucket before,
    so one exchange of the rows lets every bucket see its successor.
    """
    spark = df.sparkSession
    n = BUCKETS_PER_PARTITION * shuffle_partitions(spark)
    cuts = F.percentile_approx(order, [i / n for i in range(1, n)], 20 * n)
    bounds = sorted(set(df.agg(cuts.alias("cuts")).first()["cuts"] or []))
    bucket = _bucket(F.col(order), bounds)
    heads = df.groupBy(bucket.alias("b")).agg(F.min(order).alias("head")).sort("b").collect()
    if not heads:
        return df.withColumn("next", F.struct(*carry))
    # the row after bucket b's last one has the smallest value of the next bucket; bucket -1 comes first in these lists
    head_of, before = [None] * (len(bounds) + 2), [None] * (len(bounds) + 2)
    for here, after in zip(heads, [*heads[1:], heads[0]]):
        head_of[after["b"] + 1], before[after["b"] + 1] = after["head"], here["b"]
    df = df.withColumn("__bucket", bucket)
    own = F.col("__bucket")
    is_head = F.col(order).eqNullSafe(F.get(_longs(head_of), own + 1))
    ghost = F.struct(F.get(_longs(before), own + 1).cast("int").alias("b"), F.when(own == heads[0]["b"], 2).otherwise(1).alias("ghost"))
    seat = F.struct(own.alias("b"), F.lit(0).alias("ghost"))
    places = F.when(is_head, F.array(seat, ghost)).otherwise(F.array(seat)).cast(SEATS)
    dealt = df.withColumn("__place", F.explode(places))
    # ghosts of the next bucket sort after all own rows; a wrapped head last of all
    ordered = Window.partitionBy(F.col("__place.b")).orderBy(F.col("__place.ghost"), F.col(order), F.col(tie))
    followed = dealt.withColumn("next", F.lead(F.struct(*carry)).over(ordered))
    return followed.filter(F.col("__place.ghost") == 0).drop("__place", "__bucket")


def _longs(values: list[int | None]) -> Column:
    """The numbers as one literal, however many they are (an element each would take
    a call to the JVM each)."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _bucket(value: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below the value (-1 for null), found in steps of ``FINE``."""
    levels = [bounds]
    while len(levels[-1]) >= FINE:
        levels.append(levels[-1][FINE - 1::FINE])
    below = lambda a: F.size(F.filter(a, lambda x: x <= value))
    found = F.lit(0)
    for level in reversed(levels):
        found = below(_longs(level)) if level is levels[-1] else found * FINE + below(F.slice(_longs(level), found * FINE + 1, F.lit(FINE)))
    return F.when(value.isNull(), -1).otherwise(found)


def edited_text(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points replaced by the first as many of ``following``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(following, half))


def op3_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = with_next_row(add_sketch(docs, "text", "sketch"), "doc_id", "text", ["text", "sketch"])
    df = df.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "sketch",
                   F.col("next.sketch").alias("next_sketch"),
                   edited_text(F.col("text"), F.col("next.text")).alias("edited"))
    df = add_sketch(df, "edited", "edited_sketch")
    return df.select(
        "doc_id", "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(F.col("sketch")).alias("fingerprint"),
        fingerprint_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
