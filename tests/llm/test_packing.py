import random
import zlib
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest

from clinlake.llm import packing as pk
from clinlake.llm.byte_bpe import WHITE_SPACE, encoder
from clinlake.llm.common import table

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(pk.vocabulary_path())


def test_encoder_equals_the_library(library):
    own, rnd = encoder(pk.vocabulary_path()), random.Random(3)
    assert len(set(WHITE_SPACE)) == 25
    bits = [*WHITE_SPACE, *[" "] * 20, *["\n"] * 5, "  ", "a", "b", "it's", "'ll", "'", "<|endoftext|>", "<|endof", "123", "½", "é", "ſ", "日本", "!", "...",
            "\x1c", "\x1f", "\x00", "😀", "don", "​", "﻿", "̀", "ƀ"]
    for _ in range(8000):
        text = "".join(rnd.choices(bits, k=rnd.randint(0, 14)))
        assert np.frombuffer(own.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    # a cache that overflows gives the same ids
    own.new.update({f"w{i}": b"" for i in range(10)})
    long = "x" * 70_000 + " " + "word " * 1000
    assert np.frombuffer(own.encode(long), "<u2").tolist() == library.encode(long, add_special_tokens=False).ids


def check_plan(counts, cap):
    patterns = pk.plan_patterns(counts, cap)
    used = Counter()
    for times, lengths in patterns:
        assert times >= 1 and sum(lengths) <= cap
        for n in lengths:
            used[n] += times
    assert used == Counter({k: v for k, v in counts.items() if v})
    assert len(patterns) <= cap * (1 + np.log(cap))
    return sum(times for times, _ in patterns)


def fewest(items, cap):
    """Fewest bins, by trying everything."""
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + items[i] <= cap and bins[b] not in bins[:b]:
                go(i + 1, [*bins[:b], bins[b] + items[i], *bins[b + 1:]])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_plans_of_small_inputs_are_near_the_optimum():
    rnd = random.Random(5)
    over = 0
    for _ in range(150):
        cap = rnd.choice([10, 20, 37])
        items = sorted((rnd.randint(1, cap) for _ in range(rnd.randint(1, 9))), reverse=True)
        over += check_plan(Counter(items), cap) - fewest(items, cap)
    assert 0 <= over <= 5


@pytest.mark.parametrize("fill", [1, 2, 3])
def test_exact_complements_are_found(fill):
    """Wherever one, two or three lengths fill the gap, they are found."""
    rnd = random.Random(fill)
    for _ in range(300):
        counts = Counter(rnd.choices(range(1, 30), k=rnd.randint(1, 8)))
        own, gap = pk.Lengths(counts, 60), rnd.randint(1, 60)
        found = {1: lambda: [gap] if own.count[gap] else [], 2: lambda: own.pair(gap), 3: lambda: own.triple(gap)}[fill]()
        there = any(sum(c) == gap and not Counter(c) - counts for c in combinations_with_replacement(sorted(counts), fill))
        assert bool(found) == there
        assert not found or (sum(found) == gap and not Counter(found) - counts)
        assert {n: int(c) for n, c in enumerate(own.count) if c} == dict(counts)  # a search changes no count


def test_large_counts_share_decisions():
    rnd = random.Random(9)
    counts = {n: rnd.randint(1, 10**9) for n in range(1, 2049)}
    # no two pieces above half share a sequence, nor does anything exceed the total
    least = max(-(-sum(n * c for n, c in counts.items()) // 2048), sum(c for n, c in counts.items() if n > 1024))
    assert least <= check_plan(counts, 2048) <= least * 1.006 + 10
    assert check_plan({1500: 10**10}, 2048) == 10**10
    assert check_plan({}, 2048) == 0


def pieces_of(doc_id, ids, cap):
    first = len(ids) - cap * (-(-len(ids) // cap) - 1)
    starts = [0, *range(first, len(ids), cap)]
    return [(doc_id, i, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())) for i, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)]))]


def check_packed(rows, want, cap):
    assert sorted(map(str, [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows])) == sorted(map(str, want))
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    return len(sequences)


def test_query(spark, library):
    want = [p for r in table(spark, SF_SMALL, "documents").collect()
            for p in pieces_of(r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids + [0], 2048)]
    got = check_packed(pk.op13_best_fit_packing(spark, SF_SMALL).collect(), want, 2048)
    assert got <= -(-sum(p[3] for p in want) // 2048) + 2


def test_odd_rows_and_sequences(spark, library):
    data = [(None, None, 1), (None, "no id", 1), (5, "", 1), (5, "twice", 1), (5, "twice", 1), (6, "word " * 40_000, 1), (7, "x" * 3000, None),
            (8, "日本 <|endoftext|> text", 2)] + [(100 + i, "a third of all rows alike", i) for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, length int").repartition(5)
    for cap in (16, 64, 2048):
        want = [p for d, t, _ in data for p in pieces_of(d, library.encode(t or "", add_special_tokens=False).ids + [0], cap)]
        packed = pk.pack(docs, pk.vocabulary_path(), cap)
        rows = packed.collect()
        n = check_packed(rows, want, cap)
        assert n >= -(-sum(p[3] for p in want) // cap)
        joined = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in pk.sequences(packed).collect()}
        assert len(joined) == n
        for r in rows:
            ids = joined[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
            assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]


def test_empty_table(spark):
    assert pk.pack(spark.createDataFrame([], "doc_id long, text string"), pk.vocabulary_path()).collect() == []
