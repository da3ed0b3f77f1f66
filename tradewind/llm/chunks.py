"""Texts cut into chunks whose separate encodings add up to the text's.

The byte-level pattern attaches a space to the word after it, and keeps letters
and digits apart from other marks. So a text may be cut before every space that
a non-space follows, around a line break that stands alone, and before a full
stop or comma that ends a word. Chunks repeat a lot; their ids are kept per
worker in a table of bounded size.
"""
from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

_BEFORE_WORD = re.compile(r" (?=\S)")
#: From here on, Unicode versions of regex engines may differ on a code point's class.
UNSURE = "\u0530"

#: Class of each Latin-1 code point: white space, full stop or comma, letter or
#: digit, other.
_CLASS = bytes(ord(" " if c.isspace() else "." if c in ".," else "w" if c.isalnum() else "p") for c in map(chr, range(256)))


def plain(text: str) -> bool:
    """Whether all engines agree on the classes of the text's code points."""
    return text.isascii() or max(text) < UNSURE


def cut(text: str) -> list[str] | None:
    """Chunks of a plain text; None if the text is not plain."""
    try:
        kinds = text.encode("latin-1").translate(_CLASS)
    except UnicodeEncodeError:
        return (_BEFORE_WORD.sub("\0 ", text).split("\0") if "\0" not in text else [text]) if plain(text) else None
    if "\0" in text:
        return [text]
    if b"  " in kinds:
        return _BEFORE_WORD.sub("\0 ", text).split("\0")
    chunks = text.replace(" ", "\0 ").replace("\n", "\0\n\0") + "\0"
    kinds = b" " + kinds + b" "
    if b"p. " not in kinds and b".. " not in kinds and b" . " not in kinds:  # all end words
        chunks = chunks.replace(",\0", "\0,\0").replace(".\0", "\0.\0")
    return chunks.split("\0")


class _Index(dict):
    """Number of each chunk, in order of first sight."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        return n


class Chunks:
    """Ids of chunks by ``encode(list of chunks) -> list of int32 arrays``, and,
    with ``decode(list of id arrays) -> list of bytes``, what their ids decode
    to. The table starts anew once it holds ``most`` chunks."""

    def __init__(self, encode: Callable[[list[str]], list[np.ndarray]],
                 decode: Callable[[list[np.ndarray]], list[bytes]] | None = None, most: int = 400_000):
        self.encode, self.decode, self.most = encode, decode, most
        self.index = _Index()

    def ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The ids of each text's chunks, in order."""
        if len(self.index) >= self.most or not self.index:
            self.index = _Index({"": 0})
            self.flat, self.end = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)  # ends of the chunks' ids
            self.bytes = [b""]
        known = len(self.index)
        number = self.index.__getitem__
        order = self.order = [np.fromiter(map(number, t), dtype=np.int64, count=len(t)) for t in texts]
        if new := list(self.index)[known:]:
            ids = self.encode(new)
            self.end = np.r_[self.end, len(self.flat) + np.cumsum([len(x) for x in ids])]
            self.flat = np.concatenate([self.flat, *ids])
            if self.decode:
                self.bytes += self.decode(ids)
        start = np.r_[0, self.end[:-1]]
        out = []
        for at in order:
            size = self.end[at] - start[at]
            ends = np.cumsum(size)
            out.append(self.flat[np.repeat(start[at] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)])
        return out

    def decoded(self) -> list[bytes]:
        """What the ids of the last texts decode to, chunk by chunk: decoding
        a sequence is decoding its parts."""
        return [b"".join(map(self.bytes.__getitem__, at.tolist())) for at in self.order]
