import hashlib

import pytest
from pyspark.sql import functions as F

from clinlake.llm import fingerprint as fp
from clinlake.llm.common import table

from conftest import SF_SMALL


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        half = len(t) // 2
        out.append(t[:len(t) - half] + texts[(i + 1) % len(texts)][:half])
    return out


def test_query_edits_and_next_documents(spark):
    rows = {r["doc_id"]: r for r in fp.op3_syncmer_fingerprints(spark, SF_SMALL).collect()}
    docs = sorted((r["doc_id"], r["text"] or "") for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect())
    texts = [t for _, t in docs]
    assert set(rows) == {d for d, _ in docs} and len(rows) == len(docs)
    by_text = {}
    for (doc_id, text), want in zip(docs, edited(texts)):
        r = rows[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert len(set(by_text.values())) == len(by_text)
    long = [rows[d] for d, t in docs if len(t) > 1000]
    assert sum(r["near_edited"] for r in long) > 5 * sum(r["near_next"] for r in long)


def test_edge_rows(spark):
    schema = "doc_id long, text string, sketch int, next string"
    data = [(None, "null id", 1, "x"), (5, "", 1, "x"), (5, "a b", 1, "x"), (5, "a b", 1, "x"), (9, None, 1, "x"),
            (2**40, "w " * 50_000, 1, "x"), (7, "ab\n" * 3, 1, "x")]
    docs = spark.createDataFrame(data, schema).selectExpr("doc_id", "coalesce(text, '') text")
    out = fp.with_next_row(docs, "doc_id", "text", ["doc_id", "text"])
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["text"], r["next"]["doc_id"], r["next"]["text"])
                  for r in out.collect()), key=str)
    order = sorted(((d if d is not None else -1), t or "") for d, t, *_ in data)
    want = sorted(((d, t, None if order[(i + 1) % len(order)][0] == -1 else order[(i + 1) % len(order)][0], order[(i + 1) % len(order)][1])
                   for i, (d, t) in enumerate(order)), key=str)
    assert got == want


@pytest.mark.parametrize("data", [[], [(1, "only one row here with six words")]])
def test_tiny_tables(spark, data):
    docs = spark.createDataFrame(data, "doc_id long, text string")
    out = fp.with_next_row(fp.add_sketch(docs, "text", "sketch"), "doc_id", "text", ["text"]).collect()
    assert [(r["doc_id"], r["next"]["text"]) for r in out] == data


def test_syncmers_are_context_free(spark):
    passage = " ".join(f"w{i * i % 97}" for i in range(60))
    docs = spark.createDataFrame([(1, "x y z " + passage), (2, "other start of a text, longer " + passage + " tail"), (3, None)],
                                 "doc_id long, text string")
    rows = {r["doc_id"]: r["anchors"] for r in fp.syncmers(docs).collect()}
    assert rows[3] == []
    shared = {a["hash"] for a in rows[1]} & {a["hash"] for a in rows[2]}
    assert len(shared) >= 20
    shifts = {b["position"] - a["position"] for a in rows[1] for b in rows[2] if a["hash"] == b["hash"] and a["hash"] in shared}
    assert 3 in shifts


@pytest.mark.parametrize("alphabet", ["的一是不了人我在有他这中大来上国个到说们", "กขคงจฉชซญดตถทนบปผพมย", "abcdefghijklmnopqrstuvwxyz0123456789", "😀😁😂🤣😃𠀀𠀁𠀂𠀃"])
def test_unspaced_texts_are_context_free(spark, alphabet):
    import random

    rnd = random.Random(3)
    text = "".join(rnd.choices(alphabet, k=400))
    other = "".join(rnd.choices(alphabet, k=400))
    texts = [text, alphabet[0] + text, text[:200] + text[201:], other[:37] + text[3:] + other[:50], other]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: {a["hash"] for a in r["anchors"]} for r in fp.syncmers(docs).collect()}
    assert len(found[0]) > 50
    for i in (1, 2, 3):
        assert len(found[0] & found[i]) > 0.85 * len(found[0])
    assert not found[0] & found[4]
    sketches = fp.add_sketch(docs, "text", "sketch")
    pairs = sketches.alias("a").join(sketches.alias("b")).filter("a.doc_id = 0")
    alike = {r["d"]: r["n"] for r in pairs.select(F.col("b.doc_id").alias("d"), fp.likeness(F.col("a.sketch"), F.col("b.sketch")).alias("n")).collect()}
    assert min(alike[1], alike[2], alike[3]) > 0.6 and alike[4] < 0.1


def brute_sketch(spark, text):
    """The definition, token by token."""
    import re

    tokens = re.findall(r"[^\x20\x09-\x0D]{1,8}", text)
    pairs = [spark.sql("select xxhash64(:a, :b) h", {"a": a, "b": b}).first()["h"] for a, b in zip(tokens, tokens[1:])]
    kept = [i for i in range(len(tokens) - 4) if min(pairs[i], pairs[i + 3]) <= min(pairs[i + 1], pairs[i + 2])]
    return [tuple(tokens[i:i + 5]) for i in kept]


def test_closed_syncmers_match_the_definition(spark):
    text = "the quick brown fox jumps over the lazy dog while extraordinarily slow cats sleep all day long in the sun"
    want = brute_sketch(spark, text)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    anchors = fp.syncmers(docs).first()["anchors"]
    import re

    tokens = re.findall(r"[^\x20\x09-\x0D]{1,8}", text)
    assert [tuple(tokens[a["position"]:a["position"] + 5]) for a in anchors] == want


def test_plan_of_many_buckets_is_built_quickly(spark, monkeypatch):
    """Bounds of 12,000 buckets are a few literals."""
    import time

    rows = spark.range(60_000).select((F.col("id") * 7 % 60_013).alias("doc_id"), F.lit("x").alias("text"))
    monkeypatch.setattr(fp, "shuffle_partitions", lambda s: 3_000)
    began = time.time()
    out = fp.with_next_row(rows, "doc_id", "text", ["doc_id"])
    plan_only = time.time() - began
    assert plan_only < 30  # two aggregates over the rows included
    keys = {r["doc_id"]: r["next"]["doc_id"] for r in out.select("doc_id", "next").collect()}
    order = sorted(keys)
    assert [keys[d] for d in order] == [*order[1:], order[0]]
