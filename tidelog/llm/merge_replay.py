"""Byte-level BPE by corpus-level merge replay.

The distinct words of a block of documents are laid out as one sequence of byte tokens. An inverted index leads from
the rank of a mergeable token pair to the positions where it stands. Merges are applied in rank order, each to all its
positions at once; only the pairs with the touched neighbours change and enter the index again. So a merge costs what
it changes, a word is encoded once however often the block holds it, and a very long word costs no more than its merges.

A word depends on nothing outside itself, so the block a task reads is corpus enough and no word is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.common import documents, ship, two_columns
from tidelog.llm.tokens import LONGEST, Memory, parts_of, split_at_spaces

_NONE = np.int32(1 << 30)  # rank of a pair that does not merge
#: Bytes of remembered pieces, and of text whose new words are merged at once.
REMEMBERED, GROUP = 32 << 20, 1 << 22


class Vocabulary:
    """The rank file: tokens by id, and all pairs of tokens that make a token."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = {r: t for t, r in self.rank.items()}
        size = max(self.rank.values()) + 1
        self.size = size
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        keys, made = [], []
        for t, r in self.rank.items():
            for k in range(1, len(t)):
                a, b = self.rank.get(t[:k]), self.rank.get(t[k:])
                if a is not None and b is not None:
                    keys.append(a * size + b)
                    made.append(r)
        order = np.argsort(keys)
        self.pairs = np.array(keys, np.int64)[order]
        self.made = np.array(made, np.int32)[order]
        # white space as the rank file's own library understands it
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.made[at], _NONE)

    def one_by_one(self, word: bytes) -> list[int]:
        """The definition: always the leftmost pair of the lowest rank."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
            k = int(np.argmin(ranks))
            if ranks[k] == _NONE:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.rank[p] for p in parts]


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def replay(v: Vocabulary, words: list[bytes]) -> list[np.ndarray]:
    """Ids of each word."""
    if not words:
        return []
    lengths = np.array([len(w) for w in words])
    ends = np.cumsum(lengths)
    token = v.byte[np.frombuffer(b"".join(words), np.uint8)].astype(np.int32)
    n = len(token)
    of = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    # neighbours in the same word; n is none
    after = np.arange(1, n + 1, dtype=np.int32)
    after[ends[lengths > 0] - 1] = n
    before = np.arange(-1, n - 1, dtype=np.int32)
    before[(ends - lengths)[lengths > 0]] = n
    none = np.full(1, n, np.int32)
    before, after, token = np.append(before, none), np.append(after, none), np.append(token, np.full(1, -1, np.int32))
    rank = np.full(n + 1, _NONE, np.int32)  # of the pair that begins here
    first = np.flatnonzero(after[:n] < n)
    rank[first] = v.ranks(token[first], token[first + 1])
    odd = np.zeros(len(words), bool)  # words whose merges don't come in rank order

    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(positions: np.ndarray, ranks: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        at = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1]))
        for r, lo, hi in zip(ranks[at].tolist(), at.tolist(), np.append(at[1:], len(ranks)).tolist(), strict=True):
            if r in index:
                index[r].append(positions[lo:hi])
            else:
                index[r] = [positions[lo:hi]]
                heapq.heappush(heap, r)

    live = np.flatnonzero(rank < _NONE)
    if len(live):
        enter(live, rank[live])
    while heap:
        r = heapq.heappop(heap)
        found = index.pop(r)
        p = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        p = p[rank[p] == r]
        if not len(p):
            continue
        if len(found) == 1 and len(p) > 1 and (p[1:] <= p[:-1]).any():
            p = np.unique(p)
        q = after[p]
        if len(p) > 1 and (hit := q[:-1] == p[1:]).any():
            # pairs that overlap, as in a row of equal tokens: from the left, every other one
            start = np.flatnonzero(~np.append(False, hit))
            place = np.arange(len(p)) - np.repeat(start, np.diff(np.append(start, len(p))))
            p = p[place % 2 == 0]
            q = after[p]
        end = after[q]
        token[p] = r
        after[p] = end
        before[end] = p  # writes at n do no harm
        rank[q] = _NONE
        token[q] = -1
        after[n] = before[n] = n
        rank[p] = _NONE
        right = p[end < n]
        left = before[p]
        left = left[left < n]
        changed = np.concatenate([left, right])
        if len(changed):
            new = v.ranks(token[changed], token[after[changed]])
            rank[changed] = new
            ok = new < _NONE
            changed, new = changed[ok], new[ok]
            if len(new) and (early := new <= r).any():
                odd[of[changed[early]]] = True
                late = ~odd[of[changed]]
                changed, new = changed[late], new[late]
            if len(new):
                enter(changed, new)
    left = np.flatnonzero(token[:n] >= 0)
    part = np.searchsorted(of[left], np.arange(len(words) + 1))
    ids = token[left]
    out = [ids[part[k] : part[k + 1]] for k in range(len(words))]
    for k in np.flatnonzero(odd).tolist():
        out[k] = np.array(v.one_by_one(words[k]))
    return out


def encode_pieces(v: Vocabulary, pieces: list[str]) -> Iterator[bytes]:
    """Ids of strings that each begin and end where a match of the pattern does."""
    split = [[m.encode() for m in v.pattern.findall(p)] for p in pieces]
    distinct = set().union(*split) if split else set()
    ids = {w: np.array([v.rank[w]], np.uint32).tobytes() for w in distinct if w in v.rank}
    rest = [w for w in distinct if w not in ids]
    ids.update(zip(rest, (x.astype(np.uint32).tobytes() for x in replay(v, rest)), strict=True))
    for s in split:
        yield b"".join([ids[w] for w in s])


def pieces_of(text: str) -> list[str]:
    """A text cut before its spaces, each with what follows; whole where such cuts may be wrong."""
    if (cut := split_at_spaces(text)) is None:
        return [text]
    return [cut[0], *[f" {x}" for x in cut[1]]]


class Learnt(Memory):
    """Pieces to ids, by one replay over all new pieces of a group. Long ones are kept for the group only."""

    def __init__(self, path: str, pattern: str):
        self.v = vocabulary(path, pattern)
        self.long: dict[str, bytes] = {}
        super().__init__(self._one, REMEMBERED)

    def _one(self, piece: str) -> bytes:
        ids = self.long.get(piece)
        return next(encode_pieces(self.v, [piece])) if ids is None else ids

    def learn(self, pieces: set[str]) -> None:
        self.trim()
        self.long.clear()
        new = [p for p in pieces if p not in self and p not in self.old]
        for piece, ids in zip(new, encode_pieces(self.v, new), strict=True):
            if len(piece) <= LONGEST:
                self.keep(piece, ids)
            else:
                self.long[piece] = ids


@lru_cache(maxsize=2)
def _memory(path: str, pattern: str) -> Learnt:
    return Learnt(path, pattern)


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    memory = _memory(path, pattern)
    for batch in batches:
        at = 0
        for part in parts_of(batch.column("text"), GROUP):
            group = part.to_pylist()
            seen: set[str] = set()
            for x in group:
                seen.update(pieces_of(x))
            memory.learn(seen)  # one replay over the words of the whole group
            get = memory.__getitem__
            ids = [b"".join(map(get, pieces_of(x))) for x in group]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(group)), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
            at += len(group)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, ids`: ids of each text, little-endian unsigned 32-bit, without special tokens.

    A null or empty text has no ids. A null id is carried; rows of equal id are texts of their own.
    """
    ship(docs.sparkSession)
    return two_columns(docs, id_col, text_col).mapInArrow(partial(_encode, path=path, pattern=pattern), "doc_id long, ids binary")


def decode_ids(v: Vocabulary, ids: list[int]) -> bytes:
    return b"".join(map(v.token.__getitem__, ids))


def _decode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    v = vocabulary(path, pattern)
    for batch in batches:
        at = 0
        for part in parts_of(batch.column("ids")):
            out = [decode_ids(v, np.frombuffer(x.as_buffer(), "<u4").tolist()) for x in part]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), pa.array(out, pa.binary())], names=["doc_id", "decoded"])
            at += len(part)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """`doc_id, decoded`: the bytes that the ids of `encode` stand for."""
    ship(encoded.sparkSession)
    return encoded.mapInArrow(partial(_decode, path=path, pattern=pattern), "doc_id long, decoded binary")


def _digests(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    v = vocabulary(path, pattern)
    for batch in batches:
        rows = []
        for x in batch.column("ids"):
            ids = np.frombuffer(x.as_buffer(), "<u4").tolist()
            rows.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decode_ids(v, ids)).hexdigest()))
        n, ids, decoded = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = {"path": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}
    return encode(documents(spark, sf_dir), **own).mapInArrow(partial(_digests, **own), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
