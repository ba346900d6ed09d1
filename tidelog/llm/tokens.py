"""Ids of whole texts from published tokenizer files, with a bounded memory of the pieces met before.

A text is cut only where the tokenizer's own pre-tokenizer always ends a piece, whatever stands around it, so ids of
the pieces, one after the other, are the ids of the text. Frequent pieces are encoded once per worker.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of each of a worker's two generations of remembered pieces, or of words of a tokenizer that drops white space,
#: and the longest piece (in characters or bytes) that is remembered at all; ids do not depend on any.
REMEMBERED, WORDS, LONGEST = 200 << 20, 64 << 20, 64
#: What an entry takes besides its characters and ids.
_ENTRY = 190
#: Bytes of text whose pieces are in memory at once.
PART = 1 << 22
_SPACES = re.compile(r" \s")
_THREE_SPACES = re.compile(r"\s \s")
#: ASCII punctuation that neither joins the letters before it nor begins a contraction.
_PUNCTUATION = ".,!?:;#$%&*|<>()"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


class Memory(dict):
    """Piece to ids (little-endian unsigned 32-bit), encoded when first met.

    Two generations: when the new one has reached its bytes it becomes the old one, and what was not met again since is
    forgotten. Long pieces are encoded each time.
    """

    def __init__(self, encode: Callable[[str | bytes], bytes], size: int = REMEMBERED):
        super().__init__()
        self.encode, self.size, self.held = encode, size, 0
        self.old: dict = {}

    def __missing__(self, piece):
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= LONGEST:
            self[piece] = ids
            self.held += len(piece) + len(ids) + _ENTRY
        return ids

    def keep(self, piece, ids: bytes) -> None:
        self[piece] = ids
        self.held += len(piece) + len(ids) + _ENTRY

    def trim(self) -> None:
        if self.held > self.size:
            self.old = dict(self)
            self.clear()
            self.held = 0


class Library:
    """Ids of pieces by the tokenizers library.

    Most pieces are a row of Latin letters, maybe with punctuation behind. The pre-tokenizers of the files used here
    make those two words for the model, which it is given directly; any other piece takes the whole way.
    """

    def __init__(self, path: str, lower: bool):
        self.full = tokenizer(path)
        self.spelt = self.full.model.tokenize
        self.lower = lower
        self.words = Memory(self.word)
        self.spaced = Memory(self.piece_behind_space)
        # byte-level models write a byte that is not a printable character of Latin-1 as 256 and its number among those
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = dict(zip([b for b in range(256) if b not in plain], range(256, 512), strict=False))
        self.space, self.line_break = chr(self.letters[32]), chr(self.letters[10])

    def word(self, word: str) -> bytes:
        if word.isascii():
            spelt = word.replace(" ", self.space).replace("\n", self.line_break)
        else:
            spelt = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.spelt(spelt)]).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def piece(self, p: str, begin: str = "") -> bytes:
        """Ids of `begin`, which is empty or a space, and a piece without spaces."""
        w = p.rstrip(_PUNCTUATION)
        if w.isalpha() and (w.isascii() or (max(w) < "\u0250" and "\u0130" not in w)):
            ids = self.spaced[w] if begin else self.words[w.lower() if self.lower else w]
            return ids + self.words[p[len(w) :]] if len(w) < len(p) else ids
        if "\n" in p:
            lines = p.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                # a line break between two other characters is a word of its own
                return self.piece(lines[0], begin) + b"".join([self.words["\n"] + self.piece(x) for x in lines[1:]])
        return self.whole(begin + p)

    def piece_of_bytes(self, p: bytes) -> bytes:
        return self.piece(p.decode())

    def piece_behind_space(self, p: str) -> bytes:
        if p.isalpha() and (p.isascii() or (max(p) < "\u0250" and "\u0130" not in p)):
            return self.word(" " + p)
        return self.piece(p, " ")


@lru_cache(maxsize=2)
def _words(path: str) -> Memory:
    return Memory(Library(path, True).piece_of_bytes, WORDS)


@lru_cache(maxsize=2)
def _pieces(path: str) -> tuple[Library, Memory]:
    """A library, and its memory of pieces behind a space."""
    library = Library(path, False)
    return library, library.spaced


def forget() -> None:
    """Let go of all remembered pieces, for a stage that needs none in the same worker."""
    _words.cache_clear()
    _pieces.cache_clear()
    tokenizer.cache_clear()


def parts_of(column: pa.Array, size: int = PART) -> Iterator[pa.Array]:
    """Slices of a column of texts or bytes, of about `size` bytes each and one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        n = max(1, int(np.searchsorted(ends, before + size)) - at)
        yield column.slice(at, n)
        at += n


def ids_by_word(path: str, texts: pa.Array) -> Iterator[bytes]:
    """Ids of texts by a tokenizer that drops white space and case: every word stands alone."""
    memory = _words(path)
    get = memory.__getitem__
    for part in parts_of(texts.cast(pa.binary())):
        memory.trim()
        for x in part.to_pylist():
            yield b"".join(map(get, x.split()))


def split_at_spaces(text: str) -> tuple[str, list[str]] | None:
    """The text before its first space, and what stands behind each space up to the next.

    None if there are spaces amid other white space, where a cut before a space may be wrong.
    """
    if _SPACES.search(text) and _THREE_SPACES.search(text):
        return None
    head, *rest = text.split(" ")
    return head, rest


def library_ids_by_piece(path: str, texts: pa.Array) -> Iterator[bytes]:
    """Ids of texts by a byte-level tokenizer that keeps white space."""
    library, memory = _pieces(path)
    get = memory.__getitem__
    for part in parts_of(texts):
        memory.trim()
        library.words.trim()
        for x in part.to_pylist():
            if (cut := split_at_spaces(x)) is None:
                yield library.whole(x)
            else:
                yield library.piece(cut[0]) + b"".join(map(get, cut[1]))
