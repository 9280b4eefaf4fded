"""SentencePiece encoding and decoding by shared-prefix Viterbi (operator 5).

A text is segmented into the pieces of a SentencePiece model so that the sum
of their scores is largest. As in the library, a blank is put before the text,
blanks become part of the piece that follows (the model's mark), and
characters no piece contains fall back to byte pieces. No piece goes across
the start of a run of blanks or a character outside the model, so a text is a
sequence of marked words that are segmented one by one.

Each worker takes the distinct marked words of a batch it has not met before,
sorts them, and walks them as the depth-first traversal of their trie: the
best scores up to each position of a word (the forward scores) stay on a
stack, and the next word keeps those of the prefix it shares with the one
before. Words seen lately are remembered in a bounded cache.

Scores are the model's own; they are whole numbers in BPE models, so sums are
exact. Of equal sums the one whose last piece starts earliest wins, at every
position. A BPE model's published merges may cut some words differently (the
README gives the share); decoding gives back the text exactly in either case.

Defined results: null and empty texts have no ids and decode to the empty
text; the model's mark character in a text is encoded by its bytes, so that it
survives the round trip; repeated rows get equal ids; extra columns are kept
by ``encode`` and ``decode`` (a column of the output's name is replaced).
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clinlake.llm.common import release_memory, table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Distinct words in a worker's newer cache before it becomes the older one.
CACHE_WORDS = 50_000
#: Added to the lowest score for a character without a piece, as in the library.
UNKNOWN_PENALTY = 10


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceModel:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.code = "H" if n <= 1 << 16 else "I"
        self.byte_ids = [0] * 256
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.surface: list[bytes] = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"")
            else:
                self.ids[piece] = i
                self.scores[piece] = model.get_score(i)
                self.surface.append(piece.replace(MARK, " ").encode())
        self.pieces = np.array(self.surface, object)
        self.piece_bytes = np.array([len(p) for p in self.surface])
        #: Every end of a piece, with the piece's score if it is one itself.
        self.ends: dict[str, float | None] = {p[i:]: None for p in self.ids for i in range(len(p))}
        self.ends.update(self.scores)
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        known = "".join(sorted({c for p in self.ids for c in p} - {MARK, " "}))
        inside = f"[{re.escape(known)}]"
        self.words = re.compile(f" +{inside}*|{inside}+|[^{re.escape(known)} ]")
        self.known = set(known) | {MARK}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def marked_words(self, text: str) -> list[str]:
        return self.words.findall(" " + text) if text else []

    def segment(self, words: Iterable[str]) -> dict[str, bytes]:
        """Packed ids of each distinct word, by one walk over their sorted trie."""
        out, ends, unknown, ids_of = {}, self.ends, self.unknown, self.ids
        best, start, before, missing = [0.0], [0], "", object()
        for word in sorted(words):
            marked = word.replace(" ", MARK)
            shared, most = 0, min(len(marked), len(before))
            while shared < most and marked[shared] == before[shared]:
                shared += 1
            del best[shared + 1:], start[shared + 1:]
            for end in range(shared + 1, len(marked) + 1):
                # the pieces that end here, shortest first, while some piece ends alike
                top, where, at = None, end - 1, end - 1
                while at >= 0:
                    score = ends.get(marked[at:end], missing)
                    if score is not None:
                        if score is missing:
                            break
                        score += best[at]
                        if top is None or score >= top:
                            top, where = score, at
                    at -= 1
                # a character that is no piece by itself may also be passed as unknown
                if ends.get(marked[end - 1]) is None and (top is None or best[end - 1] + unknown >= top):
                    top, where = best[end - 1] + unknown, end - 1
                best.append(top)
                start.append(where)
            before = marked
            ids, end = [], len(marked)
            while end:
                at = start[end]
                piece = marked[at:end]
                number = ids_of.get(piece)
                if number is not None:
                    ids.append(number)
                else:  # bytes, in reverse as the rest
                    ids += [self.byte_ids[b] for b in reversed(piece.encode())]
                end = at
            ids.reverse()
            out[word] = self._pack(ids)
        if MARK in out:  # the character itself, not a blank
            out[MARK] = self._pack(self.byte_ids[b] for b in MARK.encode())
        return out

    def _pack(self, ids: Iterable[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def encode_batch(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        return [ids.values.to_numpy() for ids in self.encode_lists(texts)]

    def encode_lists(self, texts: Iterable[str | None]) -> pa.ListArray:
        """The ids of each text, as an Arrow column."""
        if len(self.new) > CACHE_WORDS:
            self.old, self.new = self.new, {}
        split = [self.marked_words(t or "") for t in texts]
        met: set[str] = set()
        for words in split:
            met.update(words)
        new, old, fresh = self.new, self.old, []
        for w in met.difference(new):
            if w in old:
                new[w] = old[w]
            else:
                fresh.append(w)
        new.update(self.segment(fresh))
        rows = [b"".join(map(new.__getitem__, words)) for words in split]
        width = array(self.code).itemsize
        ids = np.frombuffer(b"".join(rows), f"<u{width}").astype("int32")
        ends = np.cumsum([0, *map(len, rows)]) // width
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_lists(pa.array([list(ids)], pa.list_(pa.int32())))[0]

    def decode_lists(self, ids: pa.ListArray) -> list[str]:
        """The text of each list of ids, by one gather over the pieces' bytes (null: empty)."""
        numbers = ids.flatten().to_numpy(zero_copy_only=False)
        counts = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        whole = b"".join(self.pieces[numbers].tolist())
        ends = np.concatenate([[0], np.cumsum(self.piece_bytes[numbers])])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [whole[a + 1:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]  # without the blank put before the text


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model for each Python worker."""
    return PieceModel(path)


#: Texts segmented together; keeps a batch's words and ids within memory.
ROWS_AT_ONCE = 256


def _with_columns(df: DataFrame, source: str, names: list[tuple[str, T.DataType]],
                  convert: Callable[[PieceModel, pa.Array], list[pa.Array]], path: str) -> DataFrame:
    """``df`` with the columns of ``names`` (and types) computed from ``source`` in small slices of its Arrow batches."""
    new = {n.lower() for n, _ in names}
    kept = [c for c in df.columns if c.lower() not in new]
    schema = T.StructType([*df.select(*kept).schema.fields, *[T.StructField(n, kind) for n, kind in names]])
    at, labels = len(kept), [*kept, *[n for n, _ in names]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *convert(model, part.column(at))], labels)
        release_memory()  # the worker may serve other stages next

    return df.select(*kept, F.col(source).alias("__source")).mapInArrow(run, schema)


_IDS, _TEXT = T.ArrayType(T.IntegerType()), T.StringType()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the array column ``ids``."""
    return _with_columns(docs, text, [(ids, _IDS)], lambda model, texts: [model.encode_lists(texts.to_pylist())], path)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids (null ids: the empty text)."""
    return _with_columns(df, ids, [(text, _TEXT)], lambda model, rows: [pa.array(model.decode_lists(rows), pa.string())], path)


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the ids of a text and the text decoded from these ids, in one pass."""

    def both(model: PieceModel, texts: pa.Array) -> list[pa.Array]:
        numbers = model.encode_lists(texts.to_pylist())
        return [numbers, pa.array(model.decode_lists(numbers), pa.string())]

    return _with_columns(docs, text, [(ids, _IDS), (decoded, _TEXT)], both, path)


def op5_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and the texts decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = round_trip(docs, model_path())
    return df.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )
