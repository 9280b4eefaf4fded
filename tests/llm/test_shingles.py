import random
import re

import numpy as np

from clinlake.llm import jaccard_join as jj
from clinlake.llm import shingles
from clinlake.llm.shingles import PIECE, shingle_set, shingle_sets, word_hashes


def complements(doublings):
    """Two words, each the other's complement in a and b, that polynomial hashes modulo 2**64 cannot tell apart."""
    word = "a"
    for _ in range(doublings):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_of_crafted_form_have_their_own_hashes():
    for doublings in (6, 10, 13):
        one, other = complements(doublings)
        assert word_hashes(one)[0] != word_hashes(other)[0]
        swapped = one[8:16] + one[:8] + one[16:]
        assert swapped == one or word_hashes(swapped)[0] != word_hashes(one)[0]
    assert len({int(word_hashes("\x00" * n + "a" + "\x00" * m)[0]) for n in range(12) for m in range(12)}) == 144


def test_equal_words_equal_hashes_wherever_they_stand():
    rnd, known = random.Random(1), {}
    for _ in range(3000):
        text = "".join(rnd.choices("abcdÉ日 \t\x0b\n", k=rnd.randint(0, 40)))
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)) if w]
        hashes = word_hashes(text).tolist()
        assert len(hashes) == len(words)
        for w, h in zip(words, hashes):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    long = ("word " * (PIECE // 4)) + "x" * (PIECE + 5) + " end"
    assert len(word_hashes(long)) == PIECE // 4 + 2 and len(shingle_set(long)) == 3


def test_crafted_documents_do_not_link(spark):
    one, other = complements(10)
    rows = [(1, f"{one} {one} {other} {one} {other} {one}"), (2, f"{other} {other} {one} {other} {one} {other}"), (3, "w " * 300_000), (4, "w " * 300_001)]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, class int, component string")
    found = {r["doc_id"]: r["component_id"] for r in jj.with_smallest_id(jj.near_duplicates(docs)).collect()}
    assert found == {1: 1, 2: 2, 3: 3, 4: 3}


def test_sets_that_share_a_class_name_are_told_apart(spark):
    rows = spark.createDataFrame([(1, 5, 100), (2, 5, 100), (3, 5, 200), (4, 6, 100)], "doc_id long, class long, twin long")
    shared = spark.createDataFrame([(5, 100)], "class long, keeper long")
    named = {r["doc_id"]: r["class"] for r in jj._told_apart(rows, shared).collect()}
    assert named[1] == named[2] == 5 and named[3] not in (5, 6) and named[4] == 6
    first, second = jj.class_key(np.arange(5, dtype="uint64")), jj.class_key(np.arange(6, dtype="uint64"))
    assert first != second and all(-(2**63) <= half < 2**63 for half in (*first, *second))


def test_texts_hashed_together_have_their_own_sets(monkeypatch):
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("abcdÉ日 \t\n", weights=[9, 9, 9, 9, 2, 2, 9, 1, 1], k=rnd.choice([0, 1, 8, 60, 400]))) for _ in range(400)]
    texts += [None, "", " ", "one two three four", "x" * 300, "same words same words same words same words"]
    for together in (shingles.TOGETHER, 50, 500):
        monkeypatch.setattr(shingles, "TOGETHER", together)
        got = list(shingle_sets(texts))
        assert len(got) == len(texts) and all(np.array_equal(s, shingle_set(t)) for s, t in zip(got, texts))
