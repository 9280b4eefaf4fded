import random
import zlib

import numpy as np
import pytest

from clinlake.llm import token_store as ts
from clinlake.llm.common import table
from clinlake.llm.word_bpe import encoder
from clinlake.session import scratch_path

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(ts.vocabulary_path())


def test_word_encoder_equals_the_library(library):
    own = encoder(ts.vocabulary_path())
    rnd = random.Random(7)
    letters = [chr(c) for c in range(0x180)] + list("'s'tréve  \n\n019 <|endoftext|> ΣσςÀé̀日本😀İẞ \x85\xa0")
    texts = ["", " ", "it's   the DOG's 2nd!!'s", "ÀÉÎ'LL'll ''s ...'re", "<|endoftext|> x"]
    texts += ["".join(rnd.choices(letters, k=rnd.randint(0, 20))) for _ in range(4000)]
    for t in texts:
        assert np.frombuffer(own.encode(t), own.code).tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_added_tokens_as_in_an_untouched_library():
    from tokenizers import Tokenizer

    own, untouched = encoder(ts.vocabulary_path()), Tokenizer.from_file(ts.vocabulary_path())
    assert np.frombuffer(own.encode("Hello <|endoftext|> world"), own.code).tolist() == [3306, 49407, 1002]
    rnd = random.Random(8)
    pieces = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "|>", " ", "\n", "it's", "É", "日本", "e\u0301", "x9", "<"]
    for _ in range(2000):
        text = "".join(rnd.choices(pieces, k=rnd.randint(1, 8)))
        assert np.frombuffer(own.encode(text), own.code).tolist() == untouched.encode(text, add_special_tokens=False).ids, text


def test_store_of_texts_with_added_tokens(spark):
    from tokenizers import Tokenizer

    untouched = Tokenizer.from_file(ts.vocabulary_path())
    texts = ["first <|endoftext|> text", "<|startoftext|>second", "third"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = scratch_path(spark, "tokens-test")
    ts.write_store(docs, root, ts.vocabulary_path())
    want = [untouched.encode(t, add_special_tokens=False).ids + [ts.END_ID] for t in texts]
    got = sorted(ts.read_store(spark, root).collect())
    assert [r["ids"] for r in got] == want
    assert [r["start"] for r in got] == [0, len(want[0]), len(want[0]) + len(want[1])]


def expected(docs, library):
    out, start = [], 0
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [ts.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_round_trip(spark, library):
    docs = sorted((r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in ts.op10_token_store(spark, SF_SMALL).collect())
    assert got == expected(docs, library)


def test_edge_rows_and_document_access(spark, library):
    data = [(None, "no id", "x"), (3, None, "x"), (3, "", "x"), (-5, "Twice!", "x"), (-5, "Twice!", "x"),
            (2**40, "long text " * 30_000, None), (8, "日本 text", "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, shard string")
    root = scratch_path(spark, "tokens-test")
    ts.write_store(docs, root, ts.vocabulary_path())
    rows = ts.read_store(spark, root).collect()
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))
    want = expected([(d, t) for d, t, _ in order], library)
    assert sorted(map(str, [tuple(r)[:4] for r in rows])) == sorted(map(str, want))
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    shard = next(r["path"] for r in ts.read_manifest(spark, root).collect()
                 if ts.read_document(root, r["path"], 2**40))
    assert [len(x) for x in ts.read_document(root, shard, 2**40)] == [60_001]


def test_empty_table(spark):
    root = scratch_path(spark, "tokens-test")
    ts.write_store(spark.createDataFrame([], "doc_id long, text string"), root, ts.vocabulary_path())
    assert ts.read_store(spark, root).collect() == []
