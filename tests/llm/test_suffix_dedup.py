import hashlib
import random

import pytest

from clinlake.llm import suffix_dedup as sd, suffix_runs as sr
from clinlake.llm.common import table

from conftest import SF_SMALL


def brute(docs):
    """(doc_id, bytes) in order -> rows of the contract, by a set of all strings."""
    seen, out = set(), []
    for doc_id, data in docs:
        gone = [False] * len(data)
        for s in range(len(data) - sr.LENGTH + 1):
            window = data[s:s + sr.LENGTH]
            if window in seen:
                gone[s:s + sr.LENGTH] = [True] * sr.LENGTH
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["span_starts"]), hashlib.sha256(r["kept"]).hexdigest())
                   for r in df.collect()), key=str)


def sample_docs(seed):
    rnd = random.Random(seed)
    make = lambda n: "".join(rnd.choices("abcdeé \n", k=n))
    passages = [make(n) for n in (99, 100, 101, 130, 200, 400)]
    docs = []
    for i in range(60):
        text = make(rnd.choice([0, 50, 300]))
        for _ in range(rnd.choice([0, 1, 2])):
            p = rnd.choice(passages)
            cut = rnd.choice([0, 0, 10, 40])
            text += p[cut:len(p) - rnd.choice([0, 0, 5, 60])] + make(rnd.choice([0, 1, 80]))
        docs.append((i, text))
    docs += [(100, "ab" * 400), (101, "x" * 350), (102, "x" * 99), (103, "x" * 100), (104, docs[7][1]), (105, docs[7][1])]
    return docs


def test_windows_name_every_start_once():
    rnd = random.Random(1)
    data = [bytes(rnd.choices(range(4), k=n)) for n in (0, 99, 100, 101, 1000, 5000)]
    w = sr.windows(data)
    starts = [(d, s) for d, a, s, e in zip(*[c.tolist() for c in w[:4]]) for s in range(s, e + 1)]
    assert starts == [(d, s) for d, t in enumerate(data) for s in range(len(t) - sr.LENGTH + 1)]
    for d, a, s, e in zip(*[c.tolist() for c in w[:4]]):
        assert e <= a and a + sr.SEED <= s + sr.LENGTH


def test_windows_of_long_texts(monkeypatch):
    monkeypatch.setattr(sr, "CHUNK", 256)
    test_windows_name_every_start_once()


def test_merge_equals_sorting():
    rnd = random.Random(4)
    elements = [sr.Element(bytes(rnd.choices(b"ab", k=rnd.randint(1, 12))), bytes(rnd.choices(b"ab", k=rnd.randint(0, 3))), (i,)) for i in range(400)]
    runs = [sorted(elements[i::7]) for i in range(7)] + [[]]
    decoded = [sr.decode_run(sr.encode_run(r)) for r in runs if r] + [iter(())]
    merged = list(sr.merge_runs(decoded))
    assert [e for _, e in merged] == sorted(elements)
    for (_, a), (shared, b) in zip(merged, merged[1:]):
        assert shared == sr.common_prefix(a.right, b.right, 0)


@pytest.mark.parametrize("portion,hot", [(sd.PORTION_BYTES, sd.HOT_ELEMENTS), (2000, sd.HOT_ELEMENTS), (2000, 1)])
def test_equals_brute_force(spark, monkeypatch, portion, hot):
    docs = sample_docs(portion)
    shuffled = docs[:]
    random.Random(9).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(sd, "PORTION_BYTES", portion)
    monkeypatch.setattr(sd, "HOT_ELEMENTS", hot)
    assert got(sd.remove_repeats(df)) == brute([(d, t.encode()) for d, t in docs])


def test_edge_rows(spark):
    long = "some words that repeat, " * 10
    docs = [(None, long, "x"), (1, None, "x"), (2, "", "x"), (3, long, "x"), (3, long, "x"), (4, "z" * 200_000, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, row string").coalesce(1)
    ordered = [(d, (t or "").encode()) for d, t, _ in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))]
    rows = got(sd.remove_repeats(df))
    assert rows == brute(ordered)
    assert got(sd.remove_repeats(df.limit(0))) == []


def test_query_on_the_given_documents(spark):
    docs = sorted((r["doc_id"], (r["text"] or "").encode()) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect())
    rows = sorted((tuple(r) for r in sd.op4_suffix_dedup(spark, SF_SMALL).collect()), key=str)
    assert rows == brute(docs)


def test_no_catalog_table_is_left(spark):
    docs = spark.createDataFrame([(i, "some passage that comes again and again, " * 5) for i in range(5)], "doc_id long, text string")
    out = sd.remove_repeats(docs)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("suffix_portions")]
    assert out.count() == 5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan  # its texts are still read in their buckets
