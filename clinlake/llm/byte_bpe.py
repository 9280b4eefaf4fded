"""Token ids of whole texts by the public ``byte_bpe_50k.json`` vocabulary.

``ByteEncoder`` gives the ids the tokenizers library gives for a text
(``encode(text, add_special_tokens=False)``), but runs the library's model once
for each distinct word a worker meets. Nothing is normalized, so texts of Latin
characters whose classes no Unicode version changes are split into words here.
Other texts are cut where white space follows something else, which the
vocabulary's splitter never joins (and its one added token holds no white
space); chunks with other characters or with the added token go through the
library whole.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

from clinlake.llm.word_bpe import _byte_characters

VOCABULARY = "byte_bpe_50k.json"
#: Distinct words a worker remembers in its newer cache; beyond it that one
#: becomes the older cache and only entries still in use move on.
CACHE_ENTRIES = 400_000
#: Longer words are encoded anew each time they occur.
CACHED_CHARS = 64

# --- fixed values: the splitter's contractions and Unicode's white space
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"
# --- end of fixed values
#: Code points below this are split into words here.
PLAIN_LIMIT = 0x180

_CHUNK = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")
_PLAIN = re.compile(f"[\x00-{chr(PLAIN_LIMIT - 1)}]*")


@lru_cache(maxsize=1)
def _word_pattern() -> re.Pattern:
    """Runs of letters, numbers or others, each with a blank before it, and white space."""
    plain = [chr(c) for c in range(PLAIN_LIMIT)]
    letters = "".join(c for c in plain if unicodedata.category(c).startswith("L"))
    numbers = "".join(c for c in plain if unicodedata.category(c).startswith("N"))
    space = re.escape("".join(c for c in plain if c in WHITE_SPACE))
    return re.compile(f"{CONTRACTIONS}| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+")


class ByteEncoder:
    """Encodes texts to packed little-endian unsigned ids, 2 or 4 bytes each by vocabulary size."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.model = self.whole.model
        self.width = 2 if self.whole.get_vocab_size() <= 1 << 16 else 4
        self.words = _word_pattern().findall
        self.stand_in = dict(enumerate(_byte_characters()))
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pack(self, ids) -> bytes:
        packed = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _word(self, word: str) -> bytes:
        return self.pack([t.id for t in self.model.tokenize(word.encode("utf-8").decode("latin-1").translate(self.stand_in))])

    def _words(self, words: list[str]) -> bytes:
        new = self.new
        try:
            return b"".join(map(new.__getitem__, words))
        except KeyError:
            out = []
            for w in words:
                ids = new.get(w)
                if ids is None:
                    ids = self.old.get(w)
                    if ids is None:
                        ids = self._word(w)
                    if len(w) <= CACHED_CHARS:
                        new[w] = ids
                out.append(ids)
            return b"".join(out)

    def _is_plain(self, text: str) -> bool:
        return (text.isascii() or _PLAIN.fullmatch(text) is not None) and not any(a in text for a in self.added)

    def encode(self, text: str) -> bytes:
        if len(self.new) > CACHE_ENTRIES:
            self.old, self.new = self.new, {}
        if self._is_plain(text):
            return self._words(self.words(text))
        return b"".join([
            self._words(self.words(c)) if self._is_plain(c) else self.pack(self.whole.encode(c, add_special_tokens=False).ids)
            for c in _CHUNK.findall(text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    """One encoder for each Python worker."""
    return ByteEncoder(path)
