"""A training-data pipeline over ``documents``: five stages, each one operator.

``run`` applies ``STAGES`` in order. Every stage's result is written as Parquet
in the shared checkpoint folder and read again as the next stage's documents,
so a lost executor never costs more than the stage it was lost in.

1. language_id      operator 6: documents it calls ``und`` go (without letters,
                    or any where no document has a label), all others stay
                    whatever their cosine; a null label gets the predicted
                    language.
2. near_duplicates  operator 7: of each group of near duplicates the document
                    of smallest doc_id stays.
3. repeated_text    operator 4: bytes covered by a 100-byte string that starts
                    earlier go; documents of which nothing is left go.
4. mix_sources      operator 1: a sample whose expected token shares meet the
                    raked source, language and topic targets.
5. token_ids        operator 5: SentencePiece ids of what is left.

All stages but the last keep the columns of ``documents``; ``n_chars`` follows
the text. Rows without doc_id and repeated rows pass through the operators as
these define it. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinlake.llm import jaccard_join, language_id, mixing, sentencepiece_viterbi, suffix_dedup
from clinlake.llm.common import materialize, show_package, table


#: Leaving documents up to this many are broadcast (8 bytes each); beyond it they are joined by a shuffle.
MAX_BROADCAST_IDS = 1_000_000


def _few(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents the operator gives a language; learned from all labelled ones."""
    show_package(spark)
    judged = language_id.predict(docs, language_id.train(docs))
    kept = judged.filter(F.col("lang_pred") != language_id.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of smallest doc_id.

    Rows that share a doc_id are judged by their own texts: such a row goes only
    if its own group has a smaller doc_id, and of several that stand for one
    group one stays, as does one of several equal rows without words. Documents
    without words are in no group and stay, as do rows without doc_id."""
    show_package(spark)
    groups = jaccard_join.with_smallest_id(jaccard_join.near_duplicates(docs, with_key=True)).filter("doc_id is not null")
    repeated = materialize(groups.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "pipeline-repeated")
    leaving = groups.filter("component is not null and doc_id != component_id").select("doc_id").distinct()
    leaving = materialize(leaving.join(repeated, "doc_id", "left_anti"), "pipeline-leaving")
    staying = docs.join(_few(leaving), "doc_id", "left_anti")
    if repeated.isEmpty():
        return staying.select(*docs.columns)
    repeated = _few(repeated)
    own = jaccard_join.with_set_key(docs.select("doc_id", "text").join(repeated, "doc_id", "left_semi"))
    standing = groups.filter("doc_id = component_id and component is not null").join(repeated, "doc_id", "left_semi")
    standing = standing.select("doc_id", *jaccard_join.SET_KEY, "component").distinct()
    # of the rows that stand for a group, the least text stays
    kept = own.join(standing, ["doc_id", *jaccard_join.SET_KEY]).groupBy("doc_id", "component").agg(F.min("text").alias("text"))
    kept = kept.select("doc_id", "text").unionByName(own.filter("set_high is null").select("doc_id", "text").distinct())
    kept = materialize(kept, "pipeline-kept")
    rows = docs.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    again = kept.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
    rows = rows.join(again, (F.col("doc_id") == F.col("__id")) & F.col("text").eqNullSafe(F.col("__text")), "left_semi")
    return staying.join(repeated, "doc_id", "left_anti").unionByName(rows).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; documents of which nothing is left go."""
    show_package(spark)
    out = suffix_dedup.remove_repeats(docs, keep=[c for c in docs.columns if c not in ("doc_id", "text", "n_chars")])
    out = out.withColumn("text", F.col("kept_text")).filter(F.char_length("text") > 0)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the target mixture."""
    show_package(spark)
    return mixing.mix(docs).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, ids and n_ids of every document."""
    show_package(spark)
    encoded = sentencepiece_viterbi.encode(docs, sentencepiece_viterbi.model_path())
    return encoded.select("doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_ids"))


STAGES = [
    ("language_id", detect_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_text", cut_repeats),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Language profiles and Viterbi segmentation cannot be written in SQL.
ORACLE_SQL = None
