"""Hashed word shingles of whole texts (numpy, inside tasks).

Words are runs without ASCII white space, with A-Z lower-cased. A word is read
eight bytes at a time; each eight are mixed with a key of their place by a
bit mixer (not a linear function, so no pair of words cancels by its form), and
the mixed numbers are summed and mixed with the word's length. A shingle's hash
combines the hashes of its words by random odd factors and the mixer.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

WORDS = 5
#: Bytes hashed at once; longer texts are cut at white space, longer words hashed whole.
PIECE = 1 << 20
#: Bytes of texts that are hashed together: few calls for short texts, arrays that a core's cache holds.
TOGETHER = 1 << 17

_RNG = np.random.Generator(np.random.PCG64(77))
_WORD_PLACE = _RNG.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KEY, _STEP = (_RNG.integers(1, 1 << 63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).tolist()
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACES = re.compile(rb"[\x20\x09-\x0D]")
#: Masks that keep the first 0 ... 8 of eight bytes.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _lane_keys(lane: np.ndarray) -> np.ndarray:
    return _mix(lane.astype(np.uint64) * np.uint64(_STEP) + np.uint64(_KEY))


_FIRST_KEY = _lane_keys(np.zeros(1, np.int64))


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``data`` start, and their hashes."""
    space = np.ones(len(data) + 2, bool)
    np.take(_SPACE, np.frombuffer(data, np.uint8), out=space[1:-1], mode="clip")
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    # the eight bytes from every position on, as little-endian numbers (zeros beyond the end)
    eights = np.ndarray((len(data),), "<u8", buffer=data + bytes(8), strides=(1,))
    sums = _mix((eights[starts] & _FIRST[np.minimum(sizes, 8)]) ^ _FIRST_KEY)
    long = np.flatnonzero(sizes > 8)
    if len(long):  # their further lanes
        lanes = (sizes[long] - 1) // 8
        first = np.cumsum(lanes) - lanes
        lane = 1 + np.arange(int(lanes.sum())) - np.repeat(first, lanes)
        read = eights[np.repeat(starts[long], lanes) + 8 * lane] & _FIRST[np.minimum(np.repeat(sizes[long], lanes) - 8 * lane, 8)]
        sums[long] += np.add.reduceat(_mix(read ^ _lane_keys(lane)), first)
    return starts, _mix(sums ^ (sizes.astype(np.uint64) * np.uint64(_STEP)))


def _hash_piece(data: bytes) -> np.ndarray:
    return _hash_words(data)[1]


def _lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)


def word_hashes(text: str | None) -> np.ndarray:
    data = _lowered(text)
    if len(data) <= PIECE:
        return _hash_piece(data)
    out, at = [], 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            cut = max(data.rfind(s, at, end) for s in b" \t\n\x0b\x0c\r")
            if cut < 0:  # one word longer than a piece
                found = _SPACES.search(data, end)
                end = found.start() if found else len(data)
                out.append(np.array([xxhash.xxh64_intdigest(data[at:end])], np.uint64))
            else:
                end = cut + 1
                out.append(_hash_piece(data[at:end]))
        else:
            out.append(_hash_piece(data[at:]))
        at = end
    return np.concatenate(out)


def _mixed_runs(w: np.ndarray, n: int) -> np.ndarray:
    """The hashes of every run of ``n`` of the words with these hashes."""
    total = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        total += w[i:len(w) - n + 1 + i] * _WORD_PLACE[i]
    return _mix(total)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    new = np.ones(len(hashes), bool)
    np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
    return hashes[new]


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Ascending distinct hashes (uint64) of the text's shingles: every run of
    ``words`` words, or all words as one where there are fewer; empty without words."""
    w = word_hashes(text)
    n = min(words, len(w))
    return _distinct(_mixed_runs(w, n)) if n else np.zeros(0, np.uint64)


def shingle_sets(texts: Iterable[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """``shingle_set`` of each text; short ones are hashed together."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = _lowered(text)
        if size + len(data) > TOGETHER and held:
            yield from _sets_together(held, words)
            held, size = [], 0
        if len(data) > TOGETHER:
            yield shingle_set(text, words)
        else:
            held.append(data)
            size += len(data) + 1
    yield from _sets_together(held, words)


def _sets_together(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    starts, w = _hash_words(b" ".join(texts))
    ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])).tolist()
    runs = _mixed_runs(w, words) if len(w) >= words else None
    for first, end in zip([0, *ends], ends):
        if end - first >= words:
            yield _distinct(runs[first:end - words + 1])
        elif end > first:
            yield _mixed_runs(w[first:end], end - first)
        else:
            yield np.zeros(0, np.uint64)
