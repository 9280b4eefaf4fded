import hashlib
import zlib

import pytest

from clinlake.llm import merkle
from clinlake.llm.common import table

from conftest import SF_SMALL

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lowered=False):
    out = ""
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        value = row[name]
        if value is None:
            out += "-"
            continue
        value = str(value)
        if lowered and name == "text":
            value = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value)
        out += f"{len(value.encode())}:{value}"
    return sha(out)


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 8])) for i in range(0, len(below), 8)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 8 * 8
        run = level[start:start + 8]
        out.append((i - start, run[:i - start] + run[i - start + 1:]))
        i //= 8
    return out


def brute(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    order = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in order:
        by_lang[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = levels_of([leaf(r) for r in by_lang[lang]])
    top = levels_of([trees[lang][-1][0] for lang in order]) if order else []
    out = []
    for k, lang in enumerate(order):
        for i, r in enumerate(by_lang[lang]):
            steps = way(trees[lang], i) + way(top, k)
            struck = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node = leaf(r, struck)
            for at, others in steps:
                node = sha("".join([*others[:at], node, *others[at:]]))
            out.append((r["doc_id"], leaf(r), trees[lang][-1][0], top[-1][0], sha("".join(x for _, run in steps for x in run)), node, node == top[-1][0]))
    return out


def run(docs, spark):
    manifest = merkle.build_manifest(merkle.document_leaves(docs), ["doc_id", "digest"])
    shown = merkle.proofs(manifest, claimed="claimed")
    return [(r["doc_id"], r["digest"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["folded_root"] == r["root"]) for r in shown.collect()], manifest


def same(got, want):
    return sorted(map(str, got)) == sorted(map(str, want))


def test_query_equals_brute_force(spark):
    got = [tuple(r) for r in merkle.op12_merkle_manifest(spark, SF_SMALL).collect()]
    want = brute(table(spark, SF_SMALL, "documents").collect())
    assert same(got, want)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("count", [1, 2, 8, 9, 64, 65, 512, 513, 1100])
def test_tree_shapes(spark, count):
    """Trees at and just beyond the sizes of a run, a level and a persisted subtree."""
    rows = [{"doc_id": 7 * i, "text": f"Text {i}", "lang": "en", "source": None, "n_chars": i} for i in range(count)]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], KIND)
    assert same(run(docs, spark)[0], brute(rows))


def test_odd_rows(spark):
    rows = [(None, "no id", "en", "a", 5), (None, "no id", "en", "a", 5), (3, None, None, None, None), (3, "", "", "", 0), (3, "", "", "", 0),
            (-4, "ÀBC ünï 日本", "de", "ß", 2), (8, "long text " * 200_000, "de", "a", None), (9, "lower", "日本", "x", 1), (2**60, "A", "De", "a:1", 1)]
    rows += [(100, "One id, many rows", "fr", "copy", i % 5) for i in range(700)]
    rows += [(i, "Many trees", f"lang{i}", "x", 1) for i in range(70)]
    extra = spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], KIND + ", pos int, tree string, digest int")
    got, manifest = run(extra, spark)
    assert same(got, brute([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]))
    assert manifest.subroots.count() == len({r[2] for r in rows})


def test_proofs_verify_and_tampering_shows(spark):
    rows = [(i, f"Some TEXT {i}", "en" if i % 3 else "fr", "s", i) for i in range(600)]
    docs = spark.createDataFrame(rows, KIND)
    manifest = merkle.build_manifest(merkle.document_leaves(docs), ["doc_id", "digest"])
    root = manifest.root.first()["root"]
    for r in merkle.proofs(manifest).collect():
        assert merkle.fold(r["digest"], r["places"], r["others"]) == root == r["folded_root"]
        assert merkle.fold("0" * 64, r["places"], r["others"]) != root
    changed = docs.replace("Some TEXT 77", "Some TEXT 78", "text")
    other = merkle.build_manifest(merkle.document_leaves(changed), ["doc_id", "digest"])
    assert other.root.first()["root"] != root
    subroots = {r["tree"]: r["digest"] for r in manifest.subroots.collect()}
    differ = [r["tree"] for r in other.subroots.collect() if subroots[r["tree"]] != r["digest"]]
    assert differ == ["=en"]


def test_empty_table(spark):
    got, manifest = run(spark.createDataFrame([], KIND), spark)
    assert got == [] and manifest.root.collect() == []
