"""Token ids of whole texts by the public ``word_bpe_49k.json`` vocabulary.

``WordEncoder`` gives the ids the tokenizers library gives for a text
(``encode(text, add_special_tokens=False)``), but runs the library's model
once for each distinct word a worker meets: the vocabulary's normalizer and
splitter never look across white space, so a chunk between white space always
has the same ids. Texts with characters outside a range where Python's lower
case and white space agree with the library's go through the library whole, as
do texts that hold the content of an added token (``<|endoftext|>``), which the
library gives that token's id.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

VOCABULARY = "word_bpe_49k.json"
#: Distinct chunks a worker remembers in its newer cache; beyond it that one
#: becomes the older cache and only entries still in use move on.
CACHE_ENTRIES = 400_000

#: The splitter's contractions, as in the vocabulary file (fixed values).
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: Code points below this, without controls other than tab and line breaks,
#: need no composition and lower-case one by one within the range.
PLAIN_LIMIT = 0x180
ODD = {0x130}


@lru_cache(maxsize=1)
def _plain_patterns() -> tuple[re.Pattern, re.Pattern]:
    plain = [chr(c) for c in (0x9, 0xA, 0xD, *range(0x20, 0x7F), *range(0xA1, PLAIN_LIMIT)) if c not in ODD]
    letters = "".join(c for c in plain if unicodedata.category(c).startswith("L"))
    numbers = "".join(c for c in plain if unicodedata.category(c).startswith("N"))
    word = f"{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{letters}{numbers}\\s]+"
    return re.compile(f"[{re.escape(''.join(plain))}]*"), re.compile(word)


def _byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class WordEncoder:
    """Encodes texts to packed unsigned ids, 2 or 4 bytes each by vocabulary size."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.model = self.whole.model
        self.code = "H" if self.whole.get_vocab_size() <= 1 << 16 else "I"
        self.plain, self.word = _plain_patterns()
        self.stand_in = {b: c for b, c in enumerate(_byte_characters())}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pack(self, ids) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.stand_in)
        return self.pack([t.id for t in self.model.tokenize(shown)])

    def _chunk(self, chunk: str) -> bytes:
        words = self.word.findall(chunk)
        if len(words) == 1:
            return self._word(chunk)
        return b"".join([self._recall(w, self._word) for w in words])

    def _recall(self, piece: str, encode) -> bytes:
        ids = self.new.get(piece)
        if ids is None:
            ids = self.old.get(piece)
            self.new[piece] = ids = encode(piece) if ids is None else ids
        return ids

    def encode(self, text: str) -> bytes:
        if not self.plain.fullmatch(text) or any(a in text for a in self.added):
            return self.pack(self.whole.encode(text, add_special_tokens=False).ids)
        if len(self.new) > CACHE_ENTRIES:
            self.old, self.new = self.new, {}
        chunks, new = text.lower().split(), self.new
        for c in chunks:
            if c not in new:
                self._recall(c, self._chunk)
        return b"".join([new[c] for c in chunks])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path)
