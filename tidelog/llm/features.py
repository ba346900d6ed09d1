"""Counts over whole texts that tell prose from junk, in numpy over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidelog.llm.common import give_back
from tidelog.llm.names import equal_runs, mix, names_between, words_of
from tidelog.llm.tokens import parts_of

PART = 1 << 21
#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_same_words",
    "n_caps_words", "n_symbol_ends", "n_exclaim", "n_digits", "n_stops", "n_commas", "n_ended_lines",
)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_IS_SYMBOL, _IS_UPPER, _IS_DIGIT = _table(SYMBOLS), _table(bytes(range(65, 91))), _table(bytes(range(48, 58)))
_IS_END = _table(b".!?:;\"')|")


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def _again(doc: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of entries: does it have an equal one in its document, and is that one earlier."""
    key = names ^ mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    at = equal_runs(key[order])
    n = np.diff(np.append(at, len(key)))
    several, earlier = np.empty(len(key), bool), np.empty(len(key), bool)
    several[order] = np.repeat(n > 1, n)
    first = np.zeros(len(key), bool)
    first[at] = True
    earlier[order] = ~first
    return several, earlier


def measure(texts: list[bytes], repeat: int = 5) -> dict[str, np.ndarray]:
    """COUNTS of each text, as int64.

    n_lines: \\n-split lines with a word; n_dup_lines: of those, equal to an earlier one. n_repeat_words: words in windows
    of `repeat` words found twice or more in the text, the first included. n_same_words: words equal to the one before.
    n_caps_words: words with two capitals A-Z or more. n_symbol_ends: words that end in a symbol.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    offsets = np.append(0, np.cumsum(size))
    lo, hi = offsets[:-1], offsets[1:]
    out: dict[str, np.ndarray] = {}

    def per_text(flags: np.ndarray) -> np.ndarray:
        s = _sums(flags)
        return (s[hi] - s[lo]).astype(np.int64)

    a, b = words_of(data, lo)
    part = np.searchsorted(a, offsets)
    doc = np.searchsorted(offsets, a, side="right") - 1

    def per_word(flags: np.ndarray) -> np.ndarray:
        s = np.append(0, np.cumsum(flags))
        return (s[part[1:]] - s[part[:-1]]).astype(np.int64)

    out["n_words"] = np.diff(part).astype(np.int64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    out["word_chars"] = per_text(~space & ((data & 0xC0) != 0x80))
    out["n_symbols"] = per_text(_IS_SYMBOL[data])
    for name, char in (("n_exclaim", 33), ("n_stops", 46), ("n_commas", 44)):
        out[name] = per_text(data == char)
    out["n_digits"] = per_text(_IS_DIGIT[data])
    capitals = _sums(_IS_UPPER[data])
    out["n_caps_words"] = per_word(capitals[b] - capitals[a] > 1)
    out["n_symbol_ends"] = per_word(_IS_SYMBOL[data[b - 1]])

    names = names_between(data, a, b)
    out["n_distinct_words"] = per_word(~_again(doc, names)[1]) if len(a) else out["n_words"]
    same = np.zeros(len(a), bool)
    same[1:] = (names[1:] == names[:-1]) & (doc[1:] == doc[:-1])
    out["n_same_words"] = per_word(same)
    at = np.arange(max(0, len(a) - repeat + 1))
    at = at[doc[at] == doc[at + repeat - 1]]
    cover = np.zeros(len(a) + 1, np.int32)
    if len(at):
        hit = at[_again(doc[at], names_between(names, at, at + repeat))[0]]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + repeat, -1)
    out["n_repeat_words"] = per_word(np.cumsum(cover[:-1]) > 0)

    # lines with a word: those that hold the first byte of a word which no word of the same line precedes
    breaks = np.flatnonzero(data == 10)
    edges = np.union1d(np.append(offsets, breaks), breaks + 1)
    begin = edges[:-1]
    end = edges[1:]
    line = begin < end
    line &= ~((end - begin == 1) & (data[np.minimum(begin, max(0, len(data) - 1))] == 10)) if len(data) else line
    begin, end = begin[line], end[line]
    first = np.searchsorted(a, begin)
    with_word = first < len(a)
    with_word[with_word] = a[first[with_word]] < end[with_word]
    begin, end = begin[with_word], end[with_word]
    of = np.searchsorted(offsets, begin, side="right") - 1
    line_part = np.searchsorted(of, np.arange(len(texts) + 1))

    def per_line(flags: np.ndarray) -> np.ndarray:
        s = np.append(0, np.cumsum(flags))
        return (s[line_part[1:]] - s[line_part[:-1]]).astype(np.int64)

    out["n_lines"] = np.diff(line_part).astype(np.int64)
    out["n_dup_lines"] = per_line(_again(of, names_between(data, begin, end))[1]) if len(begin) else out["n_lines"]
    last_word = np.searchsorted(a, end) - 1
    out["n_ended_lines"] = per_line(_IS_END[data[b[last_word] - 1]]) if len(begin) else out["n_lines"]
    return out


def counts(batches: Iterator[pa.RecordBatch], also: tuple[str, ...] = ("doc_id",)) -> Iterator[pa.RecordBatch]:
    """The columns `also` and the COUNTS of `text`, PART bytes of text at a time."""
    for batch in batches:
        at = 0
        for part in parts_of(batch.column("text").cast(pa.binary()), PART):
            got = measure(part.to_pylist())
            columns = [batch.column(c).slice(at, len(part)) for c in also] + [pa.array(got[c]) for c in COUNTS]
            yield pa.RecordBatch.from_arrays(columns, names=[*also, *COUNTS])
            at += len(part)
    give_back()


SCHEMA = ", ".join(f"{c} long" for c in COUNTS)
