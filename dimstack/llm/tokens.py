"""Token ids of whole texts with a word cache.

The tokenizer's pre-tokens never span white space, so a text's ids are those
of its white-space-delimited words in order.  Words repeat, so their ids are
kept per Python worker, up to a bound that only affects speed.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import regex

#: Words and pieces kept per worker (about 200 bytes each).
CACHE = 600_000
#: The pre-tokens of ``word_bpe_49k.json`` (its own pattern; fixed value).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: White space for ``str.split`` but not for the tokenizer.
ODD_SPACE = re.compile("[\x1c-\x1f]")


#: The highest character whose lower case and composed form stand alone.
LAST_PLAIN = "\u024f"


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes follow from 256 on (public rule of byte-level BPE)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


BYTE_CHARS = _byte_chars()


class _Words(dict):
    """Ids per word, filled on demand up to a limit."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word: str) -> bytes:
        ids = self.make(word)
        if len(self) < self.limit:
            self[word] = ids
        return ids


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, limit: int = CACHE):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.limit, self.pieces = limit, {}
        self.words = _Words(self._word, limit)

    def encode(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of one lower-case pre-token, by the tokenizer's own model."""
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_CHARS)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _word(self, word: str) -> bytes:
        # beyond Latin letters, case and composition depend on context
        if not word.isascii() and (max(word) > LAST_PLAIN or "İ" in word) or "<|" in word:
            return self.encode(word)
        low = word.lower()
        out, pieces, room = b"", self.pieces, len(self.pieces) < self.limit
        for p in (low,) if low.isalpha() else PIECES.findall(low):
            ids = pieces.get(p)
            if ids is None:
                ids = self._piece(p)
                if room:
                    pieces[p] = ids
            out += ids
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        return [self.encode(t) if ODD_SPACE.search(t) else b"".join(map(self.words.__getitem__, t.split()))
                for t in texts]


_worker: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """This worker's encoder: one per tokenizer file, kept between tasks."""
    if path not in _worker:
        _worker[path] = WordIds(path)
    return _worker[path]
