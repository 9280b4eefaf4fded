"""Language ID by hyperdimensional profiles (operator 6).

Every letter has a fixed random vector of +1/-1 in ``DIMENSIONS`` dimensions,
drawn from its code point. A letter n-gram is bound by permuting: its vector is
the product of its letters' vectors, the first rolled twice, the second once,
the third not at all. A text's vector bundles (adds) the vectors of all its
n-grams; a language's prototype bundles those of all its labelled texts. The
prediction is the prototype of largest cosine, ties to the smaller name.

Texts are lower-cased; every run without letters counts as one blank letter,
and a text begins and ends with one.

Training covers every labelled document of the training side: bundling is
linear, so each task adds the n-gram vectors by their counts and sends one
vector for each language (``DIMENSIONS`` sums), which Spark adds up. What
reaches the driver are the prototypes, languages x ``DIMENSIONS`` numbers;
``MAX_LANGUAGES`` bounds them.

Defined results: null texts and texts without letters are ``und`` with score
0, also every text when nothing was learned; a cosine below 0 scores 0. Null
labels are not learned from. Repeated rows count as often as they appear, each
gets its own result; extra columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinlake.llm.common import table

DIMENSIONS = 512
GRAM = 3
SEED = 20_24
MAX_LANGUAGES = 2_000
#: N-grams, and texts, whose counts are held at once.
PIECE = 1 << 18
PIECE_TEXTS = 256
GRAMS_AT_ONCE = 4096
UNKNOWN = "und"
BLANK = 0x20


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """For every code point: itself if it is a letter, else the blank."""
    points = np.full(sys.maxunicode + 1, BLANK, "uint32")
    letters = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    points[letters] = letters
    return points


@lru_cache(maxsize=4096)
def letter_vector(point: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([SEED, point])).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return (2 * bits - 1).astype("float32")


@lru_cache(maxsize=16_000)
def gram_vector(a: int, b: int, c: int) -> np.ndarray:
    """The bound vector of a letter n-gram."""
    return (np.roll(letter_vector(a), 2) * np.roll(letter_vector(b), 1) * letter_vector(c)).astype("int8")


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, one blank for each run between."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    points = _letter_table()[np.minimum(points, sys.maxunicode)]
    points = np.concatenate([[BLANK], points, [BLANK]]).astype("int64")
    blank = points == BLANK
    return points[~(blank & np.concatenate([[False], blank[:-1]]))]


def gram_codes(text: str | None) -> np.ndarray:
    """One integer for each letter n-gram of the text; empty without letters."""
    letters = letters_of(text or "")
    if len(letters) < GRAM:
        return np.zeros(0, "int64")
    return (letters[:-2] << 42) | (letters[1:-1] << 21) | letters[2:]


def _vectors(codes: np.ndarray) -> np.ndarray:
    mask = (1 << 21) - 1
    return np.stack([gram_vector(int(c >> 42), int(c >> 21) & mask, int(c) & mask) for c in codes]).astype("float32")


def _groups(codes: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``PIECE`` n-grams together."""
    first, held = 0, 0
    for i, c in enumerate(codes):
        if held and held + len(c) > PIECE or i - first >= PIECE_TEXTS:
            yield first, i
            first, held = i, 0
        held += len(c)
    if first < len(codes):
        yield first, len(codes)


def _distinct(joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams in ascending order and each n-gram's place among them."""
    mask = (1 << 21) - 1
    last = joined & mask  # every letter of the texts but their first blank ends an n-gram
    seen = np.zeros(1 << 21, bool)
    seen[last] = True
    seen[BLANK] = True
    alphabet = np.flatnonzero(seen)
    n = len(alphabet)
    if n ** GRAM > 1 << 22 or not seen[joined >> 42].all() or not seen[(joined >> 21) & mask].all():
        return np.unique(joined, return_inverse=True)
    number = np.zeros(1 << 21, "int32")
    number[alphabet] = np.arange(n)
    small = (number[joined >> 42] * n + number[(joined >> 21) & mask]) * n + number[last]
    found = np.zeros(n ** GRAM, bool)
    found[small] = True
    kept = np.flatnonzero(found)
    place = np.zeros(n ** GRAM, "int32")
    place[kept] = np.arange(len(kept))
    grams = (alphabet[kept // (n * n)] << 42) | (alphabet[kept // n % n] << 21) | alphabet[kept % n]
    return grams, place[small]


def bundle(codes: list[np.ndarray]) -> np.ndarray:
    """A row for each text: the sum of its n-grams' vectors (exact whole numbers)."""
    out = np.zeros((len(codes), DIMENSIONS))
    for first, last in _groups(codes):
        part = codes[first:last]
        owner = np.repeat(np.arange(len(part)), [len(c) for c in part])
        joined = np.concatenate(part) if part else np.zeros(0, "int64")
        if not len(joined):
            continue
        grams, place = _distinct(joined)
        for at in range(0, len(grams), GRAMS_AT_ONCE):
            inside = (place >= at) & (place < at + GRAMS_AT_ONCE) if len(grams) > GRAMS_AT_ONCE else slice(None)
            width = min(GRAMS_AT_ONCE, len(grams) - at)
            counts = np.bincount(owner[inside] * width + (place[inside] - at), minlength=len(part) * width)
            out[first:last] += counts.reshape(len(part), width).astype("float32") @ _vectors(grams[at:at + width])
    return out


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Unit prototype of every non-null label, from all rows."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for name, own in pdf.groupby("lang")["text"]:
                total.setdefault(name, np.zeros(DIMENSIONS))
                for piece in _joined(own):
                    total[name] += bundle([piece])[0]
        for name, vector in total.items():
            yield pd.DataFrame({"lang": name, "dimension": np.arange(DIMENSIONS), "value": vector.astype("int64")})

    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    added = rows.mapInPandas(sums, "lang string, dimension int, value long").groupBy("lang", "dimension").agg(F.sum("value").alias("value"))
    prototypes = added.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("dimension", "value"))).alias("v"))
    found = prototypes.select("lang", F.col("v.value").alias("v")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out = {}
    for r in found:
        vector = np.array(r["v"], "float64")
        if norm := np.linalg.norm(vector):
            out[r["lang"]] = vector / norm
    return out


def _some_texts(texts) -> Iterator[list[np.ndarray]]:
    """The texts' n-grams, some texts of about ``PIECE`` n-grams at a time."""
    held, size = [], 0
    for t in texts:
        held.append(gram_codes(t))
        size += len(held[-1])
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _joined(texts) -> Iterator[np.ndarray]:
    """The n-grams of many texts in arrays of about ``PIECE``."""
    held, size = [], 0
    for t in texts:
        codes = gram_codes(t)
        held.append(codes)
        size += len(codes)
        if size >= PIECE:
            yield np.concatenate(held)
            held, size = [], 0
    if size:
        yield np.concatenate(held)


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (cosine, 0 at least)."""
    names = sorted(prototypes)
    against = np.stack([prototypes[n] for n in names], axis=1) if names else np.zeros((DIMENSIONS, 0))

    def judge(texts: pd.Series) -> pd.DataFrame:
        vectors = np.concatenate([np.zeros((0, DIMENSIONS)), *[bundle(part) for part in _some_texts(texts)]])
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        known = (norms > 0) & bool(names)
        cosines = vectors @ against / np.where(norms > 0, norms, 1)[:, None]
        # equal up to rounding counts as equal: the smaller name wins
        best = np.round(cosines, 12).argmax(axis=1) if names else np.zeros(len(texts), int)
        score = cosines[np.arange(len(texts)), best] if names else np.zeros(len(texts))
        picked = np.array([*names, UNKNOWN], object)[np.where(known, best, len(names))]
        return pd.DataFrame({"lang_pred": picked, "score": np.where(known, np.clip(score, 0.0, 1.0), 0.0)})

    run = F.pandas_udf(judge, "lang_pred string, score double")
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.select(*kept, run(F.col(text)).alias("__judged")).select(*kept, "__judged.lang_pred", "__judged.score")


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents not held out."""
    docs = table(spark, sf_dir, "documents")
    prototypes = train(docs.filter(~held_out(F.col("doc_id"))))
    out = predict(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), prototypes)
    return out.select("doc_id", "held_out", "lang_pred", "score")
