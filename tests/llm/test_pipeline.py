
import numpy as np

import corpus_pipeline as cp
from clinlake.llm import sentencepiece_viterbi as sv
from clinlake.llm.common import materialize, table

from conftest import SF_SMALL
from test_jaccard_join import brute as brute_groups
from test_language_id import brute_vector

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def as_rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def brute_repeats(rows):
    seen, out = set(), {}
    for r in sorted(rows.values(), key=lambda r: r["doc_id"]):
        data = r["text"].encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            window = data[s:s + 100]
            if window in seen:
                gone[s:s + 100] = True
            seen.add(window)
        out[r["doc_id"]] = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
    return {d: t for d, t in out.items() if t}


def test_stages_match_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    names = [n for n, _ in cp.STAGES]
    assert len(cp.STAGES) == 5
    steps, now = {}, docs
    for name, stage in cp.STAGES:
        now = materialize(stage(spark, now, SF_SMALL), f"test-{name}")
        steps[name] = as_rows(now)
        if name != names[-1]:
            assert now.columns == docs.columns
    given = as_rows(docs)
    # language: what is left has letters, and nothing with a clear language went
    vectors = {d: brute_vector(r["text"]) for d, r in given.items()}
    sums = {}
    for d, r in given.items():
        if r["lang"] is not None:
            sums[r["lang"]] = sums.get(r["lang"], 0) + vectors[d]
    best = {d: max(v @ s / np.linalg.norm(v) / np.linalg.norm(s) for s in sums.values()) if v.any() else -1 for d, v in vectors.items()}
    assert set(steps["language_id"]) == {d for d, c in best.items() if c > -1}
    # near duplicates: the smallest of each group
    rows = [(d, r["text"]) for d, r in steps["language_id"].items()]
    assert set(steps["near_duplicates"]) == {d for d, _, smallest in brute_groups(rows) if d == smallest}
    # repeats: judged on the stage's own input
    assert {d: r["text"] for d, r in steps["repeated_text"].items()} == brute_repeats(steps["near_duplicates"])
    assert all(r["n_chars"] == len(r["text"]) for r in steps["repeated_text"].values())
    # mixture: a proper part, texts as before
    mixed = steps["mix_sources"]
    assert 0 < len(mixed) < len(steps["repeated_text"])
    assert all(r == steps["repeated_text"][d] for d, r in mixed.items())
    # ids: decode to the texts
    model = sv.PieceModel(sv.model_path())
    assert {d: model.decode(r["ids"]) for d, r in steps["token_ids"].items()} == {d: r["text"] for d, r in mixed.items()}


def test_short_texts_with_letters_stay(spark):
    docs = table(spark, SF_SMALL, "documents")
    short = ["A.", "Avec.", "Osrañ.", "qzx", "Ж", "A.\nAll rights reserved."]
    data = [(-1 - i, t, "en" if i % 2 else None) for i, t in enumerate(short)] + [(-100, "12 345 !", "en"), (-101, "", None)]
    added = spark.createDataFrame(data, "doc_id long, text string, lang string")
    out = cp.detect_language(spark, docs.unionByName(added, allowMissingColumns=True), "").filter("doc_id < 0").collect()
    assert {r["doc_id"] for r in out} == {-1 - i for i in range(len(short))}
    assert all(r["lang"] for r in out)


def test_edge_rows_pass(spark):
    text = "Words of a document that is long enough to be told apart from others in the language at hand. " * 3
    data = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text + "x", "en", "a", 1), (3, None, "en", "a", 1), (4, "", None, None, None),
            (5, "12 345 !", "en", "b", 1), (None, "No id but words here, some of them.", None, "b", 1), (6, "Other words of it altogether here.", None, "b", 9)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    one = materialize(cp.detect_language(spark, docs, ""), "t1")
    assert sorted(str(r["doc_id"]) for r in one.collect()) == ["1", "1", "2", "6", "None"]
    two = materialize(cp.drop_near_duplicates(spark, one, ""), "t2")
    assert sorted(str(r["doc_id"]) for r in two.collect()) == ["1", "6", "None"]
    three = materialize(cp.cut_repeats(spark, two, ""), "t3")
    assert three.count() == 3 and three.columns == COLUMNS
    assert cp.token_ids(spark, three, "").count() == 3


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    def said(n):
        return " ".join(f"word{n}x{i}" for i in range(40))

    def stay(rows):
        docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        return sorted((r["doc_id"], r["text"]) for r in cp.drop_near_duplicates(spark, docs, "").collect())

    a, b, c = said(1), said(2), said(3)
    assert stay([(3, a), (5, a), (5, b)]) == [(3, a), (5, b)]
    # 5 leaves the group of 3 and stands for the group it has with 9
    assert stay([(3, a), (5, a), (5, b), (9, b), (9, c), (9, c)]) == [(3, a), (5, b), (9, c)]
    near = b.replace("word2x39", "other")
    assert stay([(5, b), (5, near), (7, near), (7, "..."), (7, "..."), (7, "")]) == [(5, min(b, near)), (7, "..."), (7, "")] or \
        stay([(5, b), (5, near), (7, near), (7, "..."), (7, "..."), (7, "")]) == [(5, min(b, near)), (7, ""), (7, "...")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, ""), "t")
        assert docs.collect() == []
