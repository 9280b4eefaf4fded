import zlib

import numpy as np

from clinlake.llm import language_id as li
from clinlake.llm.common import table

from conftest import SF_SMALL


def brute_vector(text):
    """The definition, letter by letter."""
    word = [c if c.isalpha() else " " for c in (text or "").lower()]
    letters = []
    for c in [" ", *word, " "]:
        if not (c == " " and letters and letters[-1] == " "):
            letters.append(c)
    total = np.zeros(li.DIMENSIONS)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        total += np.roll(li.letter_vector(ord(a)), 2) * np.roll(li.letter_vector(ord(b)), 1) * li.letter_vector(ord(c))
    return total


def test_bundle_matches_the_definition():
    texts = ["Hello, World! 12 times", "", "...", None, "Ünïcödé text – ß 日本", "a", "aaaa " * 50]
    got = li.bundle([li.gram_codes(t) for t in texts])
    for row, t in zip(got, texts):
        assert (row == brute_vector(t)).all(), t


def test_bundle_in_pieces(monkeypatch):
    texts = ["some words here", "other words there and more", "third one"]
    whole = li.bundle([li.gram_codes(t) for t in texts])
    monkeypatch.setattr(li, "PIECE", 8)
    assert (li.bundle([li.gram_codes(t) for t in texts]) == whole).all()


def test_query_matches_brute_force_and_is_accurate(spark):
    docs = {r["doc_id"]: r for r in table(spark, SF_SMALL, "documents").collect()}
    got = {r["doc_id"]: r for r in li.op6_language_id(spark, SF_SMALL).collect()}
    assert set(got) == set(docs)
    sums = {}
    vectors = {d: brute_vector(r["text"]) for d, r in docs.items()}
    for d, r in docs.items():
        out = zlib.crc32(str(d).encode()) % 4 == 2
        assert got[d]["held_out"] == out
        if not out and r["lang"] is not None:
            sums[r["lang"]] = sums.get(r["lang"], 0) + vectors[d]
    right = tested = 0
    for d, v in vectors.items():
        if not v.any():
            assert (got[d]["lang_pred"], got[d]["score"]) == ("und", 0.0)
            continue
        cosines = {n: v @ s / np.linalg.norm(v) / np.linalg.norm(s) for n, s in sums.items()}
        best = max(sorted(cosines), key=lambda n: cosines[n])
        assert got[d]["lang_pred"] == best
        assert abs(got[d]["score"] - max(0, cosines[best])) < 1e-9
        if got[d]["held_out"] and docs[d]["lang"]:
            tested += 1
            right += docs[d]["lang"] == best
    assert tested > 20 and right / tested > 0.95


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "the cat and the hat", "en", 3), (2, "der Hund und die Katze", "de", 3), (3, None, "en", 3),
                                  (4, "123 !?", None, 3), (None, "the the", None, 3), (5, "x" * 300_000, None, 3)],
                                 "doc_id long, text string, lang string, score int")
    prototypes = li.train(docs)
    assert sorted(prototypes) == ["de", "en"]
    out = {r["doc_id"]: r for r in li.predict(docs, prototypes).collect()}
    assert len(out) == 6
    assert out[3]["lang_pred"] == out[4]["lang_pred"] == "und"
    assert out[None]["lang_pred"] == "en" and out[2]["lang_pred"] == "de"
    nothing = docs.limit(0)
    assert li.train(nothing) == {}
    assert li.predict(nothing, prototypes).collect() == []
    assert {r["lang_pred"] for r in li.predict(docs, {}).collect()} == {"und"}
