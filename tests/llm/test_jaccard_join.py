import random

import numpy as np
import pytest

from clinlake.llm import jaccard_join as jj, shingles
from clinlake.llm.components import components


def brute_sets(rows):
    out = []
    for _, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            lowered = lowered.replace(c, " ")
        w = [x for x in lowered.split(" ") if x]
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute(rows):
    sets = brute_sets(rows)
    up = list(range(len(rows)))

    def root(i):
        return i if up[i] == i else root(up[i])

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def sample_rows(seed, n_groups=12):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, next_id = [], 0
    common = rnd.choices(vocabulary, k=30)
    for _ in range(n_groups):
        base = rnd.choices(vocabulary, k=rnd.choice([6, 20, 60, 120]))
        if rnd.random() < 0.5:
            base += common
        for _ in range(rnd.choice([1, 2, 5, 15])):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 5])):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            rows.append((next_id, rnd.choice([" ", "\n"]).join(text)))
            next_id += 1
    rnd.shuffle(rows)
    return rows


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jj.with_smallest_id(jj.near_duplicates(docs)).collect()), key=str)


@pytest.mark.parametrize("block", [512, 3])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jj, "BLOCK", block)  # 3: blocks are joined in parts
    rows = sample_rows(1)
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (905, "one two"), (906, "ÉCOLE"), (907, "école"),
             (None, "one two"), (None, "only rows without id here now"), (903, "One two"), (2**53 + 1, "x y z"), (2**53 + 3, "x  y z")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_tree_links_find_every_linked_pair():
    for seed in range(5):
        rows = sample_rows(seed, 15)
        sets = [shingles.shingle_set(t) for _, t in rows]
        plain = brute_sets(rows)
        want = {(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j])}
        got = set()
        jj.tree_links(sets, list(range(len(sets))), lambda i, j: False, lambda i, j: got.add((i, j)))
        assert got == want


def test_bitmaps_never_rule_out_a_link():
    rnd = np.random.default_rng(2)
    for _ in range(300):
        n = int(rnd.integers(1, 200))
        a = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[int(rnd.integers(0, len(a) // 5 + 1)):], rnd.integers(0, 1 << 63, int(rnd.integers(0, n // 5 + 1)), dtype=np.uint64)]))
        overlap = len(np.intersect1d(a, b))
        x, y = jj.bitmap(a), jj.bitmap(b)
        if jj.linked(overlap, len(a), len(b)):
            assert jj.may_link(len(a), int.from_bytes(x, "little"), 8 * len(x), len(b), int.from_bytes(y, "little"), 8 * len(y))


def test_shingles_of_long_texts_are_the_same_in_pieces(monkeypatch):
    text = " ".join(f"Word{i % 97}" for i in range(3000)) + " " + "x" * 500 + "\tend"
    whole = shingles.word_hashes(text)
    monkeypatch.setattr(shingles, "PIECE", 600)
    assert (shingles.word_hashes(text) == whole).all()
    monkeypatch.setattr(shingles, "PIECE", 100)  # the long word is now hashed whole
    assert len(shingles.word_hashes(text)) == len(whole)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


def test_a_shingle_that_few_sets_of_a_portion_share_is_counted(spark):
    """A shingle of one set in three hundred grows with the table, so it must be found and come last."""
    passage = " ".join(f"common{i}" for i in range(5))
    rows = [(i, " ".join(f"own{i}x{k}" for k in range(40)) + (f" {passage}" if i % 300 == 0 else "")) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    named = {r["token"]: r["count"] for r in jj.profile(docs).filter("token is not null").collect()}
    token = int(shingles.shingle_set(passage).view("int64")[0])
    assert named == {token: 3}
    sets = {tuple(r["prefix"]) for r in jj._prefixes(docs, np.array([token], "int64").view("uint64")).collect()}
    assert all(token not in prefix for prefix in sets)


def test_frequent_shingles_come_last_in_their_order(spark):
    text = " ".join(f"w{i}" for i in range(14))  # 10 shingles, a prefix of 3
    tokens = shingles.shingle_set(text)
    heavy = np.concatenate([tokens[5:], tokens[:4]])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    prefix = jj._prefixes(docs, heavy).first()["prefix"]
    assert np.array(prefix, "int64").view("uint64").tolist() == [tokens[4], tokens[5], tokens[6]]


def test_partners_are_those_of_all_pairs():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    for share in (1.0, 0.3, 0.0):
        sets = []
        for _ in range(60):
            base = pool[:int(rng.integers(1, 500))]
            sets.append(np.unique(np.concatenate([base, rng.integers(0, 1 << 63, int(rng.integers(0, len(base) // 3 + 1)), dtype=np.uint64)])))
        bits, probe = [jj.bitmap(s) for s in sets], rng.random(60) < share
        if not share:
            probe[0] = True
        whole = [(int.from_bytes(b, "little"), 8 * len(b)) for b in bits]
        want = [any(j != i and (probe[i] or probe[j]) and jj.may_link(len(sets[i]), *whole[i], len(sets[j]), *whole[j]) for j in range(60)) for i in range(60)]
        assert jj.possible_partners(np.array([len(s) for s in sets]), bits, probe).tolist() == want and any(want)


def test_a_group_of_copies_is_walked_once():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    sets = [np.unique(np.append(base, rng.integers(0, 1 << 63, 3, dtype=np.uint64))) for _ in range(60)]
    forest, asked, found = jj._Forest(len(sets)), [], []

    def same(i, j):
        asked.append(np.ndim(j))
        return forest.same(i, j)

    def link(i, j):
        forest.join(i, j)
        found.append((i, j))

    jj.tree_links(sets, list(range(len(sets))), same, link)
    assert len(found) == 59 and len(asked) <= 3 * len(sets)  # all pairs: 60 x 59
