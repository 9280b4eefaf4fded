"""Sorted, front-coded runs of sampled suffixes and their prefix-aware merge.

A 100-byte window is named by its anchor: of the 32-byte seeds inside it the
one of smallest hash, leftmost of equals. Equal windows have their anchor at
equal places, so only suffixes that start at anchors need sorting. Neighbour
windows with one anchor form an element: the bytes from the anchor to the end
of the last window (``right``) and from the start of the first window to the
anchor (``left``). Everything here is plain numpy / bytes for use in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

LENGTH = 100
SEED = 32
SEEDS_IN_WINDOW = LENGTH - SEED + 1
#: Bytes whose anchors are found at once (positions must fit ``PLACE_BITS``).
CHUNK = 1 << 19
PLACE_BITS = 20
#: Offsets of windows of hot seeds that are kept together.
CLASS = 16

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class Windows(NamedTuple):
    """Runs of windows with one anchor: positions are within the document."""

    document: np.ndarray
    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray
    seed: np.ndarray


def _seed_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes from every position on."""
    n = len(data) - SEED + 1
    words = np.empty(len(data) - 7, np.uint64)
    raw = data.tobytes()
    for k in range(8):
        part = np.frombuffer(raw, "<u8", count=(len(raw) - k) // 8, offset=k)
        words[k::8] = part[:len(words[k::8])]
    h = np.zeros(n, np.uint64)
    for i, c in enumerate(_MULTIPLIERS):
        h += words[8 * i:8 * i + n] * c
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _chunks(documents: list[bytes]) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """([(document, its position)], bytes) of about ``CHUNK`` bytes; long
    documents come in pieces that overlap by less than a window."""
    parts, held = [], []
    size = 0
    for d, data in enumerate(documents):
        if len(data) < LENGTH:
            continue
        for at in range(0, max(1, len(data) - LENGTH + 1), CHUNK):
            piece = data[at:at + CHUNK + LENGTH - 1]
            if size and size + len(piece) > CHUNK + LENGTH:
                yield parts, b"".join(held)
                parts, held, size = [], [], 0
            parts.append((d, at))
            held.append(piece)
            size += len(piece)
    if size:
        yield parts, b"".join(held)


def windows(documents: list[bytes]) -> Windows:
    """The window runs of all documents, in order."""
    found: list[tuple] = []
    for parts, data in _chunks(documents):
        lengths = []
        for d, at in parts:
            lengths.append(min(len(documents[d]) - at, CHUNK + LENGTH - 1))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        b = np.frombuffer(data, np.uint8)
        h = _seed_hashes(b)
        place = np.uint64((1 << PLACE_BITS) - 1)
        key = (h & ~place) | np.arange(len(h), dtype=np.uint64)
        least = key
        width = 1
        while 2 * width <= SEEDS_IN_WINDOW:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = SEEDS_IN_WINDOW - width
        least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
        anchor = (least & place).astype("int64")  # of the window at every start
        part = np.repeat(np.arange(len(parts)), lengths)[:len(anchor)]
        inside = np.arange(len(anchor)) + LENGTH <= ends[part]
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        new = np.ones(len(at), bool)
        new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
        first = at[new]
        last = np.append(at[np.flatnonzero(new)[1:] - 1], at[-1])
        own = part[first]
        shift = np.array([p for _, p in parts])[own] - starts[own]
        found.append((np.array([d for d, _ in parts])[own], anchor[first] + shift, first + shift, last + shift, h[anchor[first]]))
    if not found:
        none = np.zeros(0, "int64")
        return Windows(none, none, none, none, np.zeros(0, np.uint64))
    return Windows(*[np.concatenate(c) for c in zip(*found)])


class Element(NamedTuple):
    """``right`` and ``left`` of a window run; ``where``: (document key, anchor position), ordered."""

    right: bytes
    left: bytes
    where: tuple


def classes(first: int, last: int, anchor: int) -> Iterator[tuple[int, int, int]]:
    """(class, first, last): a window run cut by the offset of its anchor, ``CLASS`` offsets each."""
    for c in range((anchor - last) // CLASS, (anchor - first) // CLASS + 1):
        low, high = c * CLASS, min(c * CLASS + CLASS, SEEDS_IN_WINDOW) - 1
        yield c, max(first, anchor - high), min(last, anchor - low)


def core(data: bytes, anchor: int, c: int) -> bytes:
    """The bytes all windows of a class have in common."""
    high = min(c * CLASS + CLASS, SEEDS_IN_WINDOW) - 1
    return data[anchor - c * CLASS:anchor + LENGTH - high]


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known already."""
    n = min(len(a), len(b))
    at = known
    while at + 16 <= n and a[at:at + 16] == b[at:at + 16]:
        at += 16
    while at < n and a[at] == b[at]:
        at += 1
    return at


def encode_run(elements: list[Element]) -> bytes:
    """A sorted run, front-coded: of ``right`` only what the element before lacks."""
    import zstandard

    n = len(elements)
    kept, sizes, before = [], np.zeros((n, 3), np.uint8), b""
    numbers = np.array([e.where for e in elements], "<i8").reshape(n, -1)
    for i, e in enumerate(elements):
        shared = common_prefix(before, e.right, 0)
        sizes[i] = shared, len(e.right), len(e.left)
        kept += [e.right[shared:], e.left]
        before = e.right
    head = np.array([n, numbers.shape[1]], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + sizes.tobytes() + numbers.tobytes() + b"".join(kept))


def decode_run(run: bytes) -> Iterator[tuple[int, Element]]:
    """(common prefix with the element before, element), in order."""
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(run)
    n, width = (int(x) for x in np.frombuffer(data, "<u4", 2))
    sizes = np.frombuffer(data, np.uint8, 3 * n, 8).reshape(n, 3).tolist()
    at = 8 + 3 * n
    numbers = np.frombuffer(data, "<i8", n * width, at).reshape(n, width).tolist()
    at += 8 * n * width
    right = b""
    for (shared, size, left), where in zip(sizes, numbers):
        right = right[:shared] + data[at:at + size - shared]
        at += size - shared
        yield shared, Element(right, data[at:at + left], tuple(where))
        at += left


def merge_runs(runs: list[Iterator[tuple[int, Element]]]) -> Iterator[tuple[int, Element]]:
    """Merge sorted runs with a tree of losers that knows common prefixes.

    Every waiting element carries its common prefix with the last winner. Of
    two, the longer one is the smaller element without looking at a byte; only
    equal ones are compared, from that length on.
    """
    k = len(runs)
    if not k:
        return
    heads: list = [next(r, None) for r in runs]
    shared = [0] * k
    losers = [-1] * k

    def beats(i: int, j: int) -> bool:
        """Whether run i's head comes before run j's; the loser learns its prefix with the winner."""
        a, b = heads[i], heads[j]
        if a is None or b is None:
            return b is None
        if shared[i] != shared[j]:
            return shared[i] > shared[j]
        x, y = a[1].right, b[1].right
        n = common_prefix(x, y, shared[i])
        if n == len(x) or n == len(y):
            less = len(x) < len(y) if len(x) != len(y) else (a[1].left, a[1].where) <= (b[1].left, b[1].where)
        else:
            less = x[n] < y[n]
        shared[j if less else i] = n
        return less

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = build(2 * node), build(2 * node + 1)
        win, lose = (a, b) if beats(a, b) else (b, a)
        losers[node] = lose
        return win

    winner = build(1) if k > 1 else 0
    while heads[winner] is not None:
        yield shared[winner], heads[winner][1]
        following = next(runs[winner], None)
        heads[winner] = following
        # within its run the prefix with the element before is known: that was the winner
        shared[winner] = following[0] if following is not None else 0
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                winner, losers[node] = losers[node], winner
            node //= 2


def repeated_windows(merged: Iterator[tuple[int, Element]]) -> Iterator[tuple[tuple, int, int]]:
    """(where, first, last) offsets of windows that also start earlier elsewhere:
    the window runs anchor - first ... anchor - last in the element's document."""
    group: list[Element] = []
    for shared, element in merged:
        if group and shared < SEED:
            yield from _group_windows(group)
            group = []
        group.append(element)
    if group:
        yield from _group_windows(group)


def _group_windows(group: list[Element]) -> Iterator[tuple[tuple, int, int]]:
    if len(group) == 1:
        return
    distinct: list[Element] = []
    for e in sorted(group, key=lambda e: (e.right, e.left, e.where)):
        if distinct and distinct[-1][:2] == e[:2]:  # the whole run again, later
            yield e.where, len(e.left), LENGTH - len(e.right)
        else:
            distinct.append(e)
    if len(distinct) == 1:
        return
    earliest: dict[tuple[int, bytes], tuple] = {}
    for e in distinct:
        joined, left = e.left + e.right, len(e.left)
        for at in range(left + len(e.right) - LENGTH + 1):
            key = (left - at, joined[at:at + LENGTH])
            if key not in earliest or e.where < earliest[key]:
                earliest[key] = e.where
    for e in distinct:
        joined, left = e.left + e.right, len(e.left)
        begun = None
        n = left + len(e.right) - LENGTH + 1
        for at in range(n + 1):
            again = at < n and earliest[(left - at, joined[at:at + LENGTH])] != e.where
            if again and begun is None:
                begun = at
            elif not again and begun is not None:
                yield e.where, left - begun, left - at + 1
                begun = None
