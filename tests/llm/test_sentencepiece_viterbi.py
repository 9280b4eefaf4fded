import random

import pytest

from clinlake.llm import sentencepiece_viterbi as sv
from clinlake.llm.common import table

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def model():
    return sv.PieceModel(sv.model_path())


def plain_viterbi(model, word):
    """Textbook Viterbi of one word: best sum, later cut decided from the front."""
    marked = word.replace(" ", sv.MARK)
    best = {0: (0.0, [])}
    for end in range(1, len(marked) + 1):
        for at in range(end):
            piece = marked[at:end]
            if piece in model.scores:
                score, ids = model.scores[piece], [model.ids[piece]]
            elif len(piece) == 1:
                score, ids = model.unknown, [model.byte_ids[b] for b in piece.encode()]
            else:
                continue
            if end not in best or best[at][0] + score > best[end][0]:
                best[end] = (best[at][0] + score, best[at][1] + ids)
    return best[len(marked)][1]


def ids_of(model, text):
    return model.encode_batch([text])[0].tolist()


def test_shared_prefixes_equal_plain_viterbi(spark, model):
    texts = [r["text"] or "" for r in table(spark, SF_SMALL, "documents").limit(30).collect()]
    words = sorted({w for t in texts for w in model.marked_words(t)})
    got = model.segment(words)
    import numpy as np

    for w in words:
        assert np.frombuffer(got[w], f"<u{np.dtype(model.code).itemsize}").tolist() == plain_viterbi(model, w), w


def test_equals_the_library_on_the_same_scores(spark, model):
    """The library's own Viterbi, by marking the model file's type as unigram in memory."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    proto = pb.ModelProto()
    proto.ParseFromString(open(sv.model_path(), "rb").read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for p in proto.pieces:
        if p.score < -1e8:  # single precision cannot add these; the texts here have no runs of blanks
            p.score = -60_000
    unigram = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    words = set()
    for r in table(spark, SF_SMALL, "documents").collect():
        words.update(w for w in (r["text"] or "").split() if all(c in model.known for c in w))
    words = sorted(words)
    assert len(words) > 2000
    for w in words:
        assert ids_of(model, w) == unigram.encode(w), w


def test_round_trip_of_odd_texts(model):
    rnd = random.Random(3)
    letters = list("ab  \n\t▁éß日😀<0x41>") + ["▁▁", "\x00", "​"]
    texts = ["", " ", "  a  b ", "▁", " ▁x▁ ", "<s></s><unk>", "x" * 5000, "a b " * 20_000]
    texts += ["".join(rnd.choices(letters, k=rnd.randint(0, 30))) for _ in range(2000)]
    for t in texts:
        assert model.decode(ids_of(model, t)) == t


def test_query_and_edge_rows(spark):
    out = sv.op5_sentencepiece_round_trip(spark, SF_SMALL).collect()
    assert len(out) == table(spark, SF_SMALL, "documents").count()
    assert all(r["round_trip"] for r in out)
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "Twice", "x"), (3, "Twice", "x"), (None, "no id", None)],
                                 "doc_id long, text string, decoded string")
    back = sv.decode(sv.encode(docs, sv.model_path()), sv.model_path())
    rows = sorted((str(r["doc_id"]), r["decoded"], len(r["ids"])) for r in back.collect())
    assert [r[:2] for r in rows] == [("1", ""), ("2", ""), ("3", "Twice"), ("3", "Twice"), ("None", "no id")]
    assert rows[0][2] == 0
    assert sv.encode(docs.limit(0), sv.model_path()).collect() == []
