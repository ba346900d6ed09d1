"""Removal of passages that repeat anywhere: super-k-mer partitioning of word windows.

A window is `length` consecutive words of one text. Its *minimiser* is the least of its GRAM-word names, which depends
on the window's words only. Consecutive windows that share a minimiser form a super-k-mer and travel together, as one
packed string, to the bucket of that minimiser; equal windows always meet there, and sorting them counts them exactly.

* A first round asks how often each minimiser occurs. Windows whose minimiser occurs once in the corpus are unique, so
  only the others travel; a packed string is about three times as long as its own share of the text.
* Within a block equal packed strings travel once, with their number, so copies cost a bucket one string per block.
* A minimiser with very many different surroundings (a line that a third of the texts holds) would fill its bucket.
  Its windows are dealt out again by a second minimiser under another order, together with the first.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import rounds
from tidelog.llm.common import documents, partitions, with_rest
from tidelog.llm.names import Sums, equal_runs, least_positions, mix, names_between, words_of
from tidelog.llm.rounds import Block, Question, note, pack, unpack

GRAM, KEY = 8, 5
PIECE = 1 << 18  # words handled at once
#: A minimiser is dealt out again if the packed strings that hold it are more than this many per block on average.
CROWDED = 2
#: A bucket is counted in so many shares, by minimiser, one after the other.
SHARES = 16
DIGESTS = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class Words:
    """The words of a block: bounds in its bytes, names, and the first word of each document."""

    def __init__(self, block: Block):
        self.start, self.end = words_of(block.data, block.offsets[:-1])
        self.names = names_between(block.data, self.start, self.end)
        self.part = np.searchsorted(self.start, block.offsets)

    def doc_at(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.part, words, side="right") - 1


class SuperKmers:
    """First and last window (by first word) of each super-k-mer, and the name of its minimiser."""

    def __init__(self, first: np.ndarray, last: np.ndarray, names: np.ndarray):
        self.first, self.last, self.names = first, last, names


def _runs(windows: np.ndarray, minimiser: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.ones(len(windows), bool)
    new[1:] = (minimiser[1:] != minimiser[:-1]) | (windows[1:] != windows[:-1] + 1)
    k = np.flatnonzero(new)
    return k, windows[np.append(k[1:], len(windows)) - 1] if len(k) else windows


def super_kmers(words: Words, length: int) -> SuperKmers:
    firsts, lasts, names = [], [], []
    total = len(words.names)
    for lo in range(0, max(0, total - length + 1), PIECE):
        hi = min(total, lo + PIECE + length - 1)
        gram = Sums(words.names[lo:hi]).every(GRAM)
        at = least_positions(gram, length - GRAM + 1)
        i = np.arange(len(at))
        fits = words.doc_at(i + lo) == words.doc_at(i + lo + length - 1)
        i = i[fits]
        if len(i):
            p = at[i]
            k, last = _runs(i, p)
            firsts.append(i[k] + lo)
            lasts.append(last + lo)
            names.append(mix(gram[p[k]]))
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return SuperKmers(join(firsts, np.int64), join(lasts, np.int64), join(names, np.uint64))


def count_question(block: Block, length: int, buckets: int):
    """How many different packed strings of this block hold each minimiser."""
    words = Words(block)
    runs = super_kmers(words, length)
    whole = names_between(words.names, runs.first, runs.last + length)
    o = np.lexsort((whole, runs.names))
    names, whole = runs.names[o], whole[o]
    at = equal_runs(names)
    other = np.ones(len(names), np.int64)
    other[1:] = (names[1:] != names[:-1]) | (whole[1:] != whole[:-1])
    q = Question(names[at], buckets)
    different = np.add.reduceat(other, at) if len(at) else other
    total = np.diff(np.append(at, len(names)))
    # 1 as long as it stands once, for one string that stands several times 2: it is not unique either
    count = np.where(total == 1, 1, np.maximum(2, different))
    return q.by_part(lambda s: pack(rounds.short_keys(q.names[s], KEY), rounds.narrow(count[s])), block.number)


def count(rows: list[tuple[int, bytes]], crowded: int) -> list[bytes]:
    """For each minimiser asked about: 0 if it occurs once, 1 if more often, 2 if it is crowded."""
    asked = [unpack(p) for _, p in rows]
    sizes = [len(c) for _, c in asked]
    keys = np.concatenate([rounds.long_keys(k, KEY) for k, _ in asked])
    counts = np.concatenate([c.astype(np.int64) for _, c in asked])
    order = np.argsort(keys, kind="stable")
    at = equal_runs(keys[order])
    sums = np.add.reduceat(counts[order], at) if len(at) else counts
    code = np.empty(len(keys), np.uint8)
    code[order] = np.repeat((sums > 1).astype(np.uint8) + (sums > crowded), np.diff(np.append(at, len(keys))))
    return [pack(x) for x in np.split(code, np.cumsum(sizes)[:-1])]


def deal_again(words: Words, runs: SuperKmers, length: int) -> SuperKmers:
    """The same windows, parted by the least gram under another order as well."""
    n = runs.last - runs.first + 1
    firsts, lasts, names = [], [], []
    for lo in range(0, len(n), 1 << 14):
        part = slice(lo, lo + (1 << 14))
        windows = np.repeat(runs.first[part] - np.cumsum(n[part]) + n[part], n[part]) + np.arange(n[part].sum())
        owner = np.repeat(runs.names[part], n[part])
        run = np.repeat(np.arange(lo, lo + len(n[part])), n[part])
        least = np.full(len(windows), np.uint64(0xFFFFFFFFFFFFFFFF))
        where = np.zeros(len(windows), np.int64)
        for d in range(length - GRAM + 1):
            name = mix(names_between(words.names, windows + d, windows + d + GRAM) ^ np.uint64(0x5851F42D4C957F2D))
            less = name < least
            least[less] = name[less]
            where[less] = windows[less] + d
        new = np.ones(len(windows), bool)
        new[1:] = (where[1:] != where[:-1]) | (run[1:] != run[:-1])
        k = np.flatnonzero(new)
        firsts.append(windows[k])
        lasts.append(windows[np.append(k[1:], len(windows)) - 1])
        names.append(mix(owner[k] ^ mix(least[k])))
    join = lambda x, like: np.concatenate(x) if x else like[:0]
    return SuperKmers(join(firsts, runs.first), join(lasts, runs.last), join(names, runs.names))


def bodies(block: Block, words: Words, first: np.ndarray, last: np.ndarray) -> list[bytes]:
    """The words from `first` to `last`, joined by one space."""
    data = block.data
    a, b = words.start[first], words.end[last]
    raw = data.tobytes()
    gaps = words.start[1:] - words.end[:-1]
    odd = np.zeros(len(words.start) + 1, np.int64)  # gaps so far that are not one plain space
    if len(gaps):
        odd[1:-1] = np.cumsum((gaps != 1) | (data[np.minimum(words.end[:-1], len(data) - 1)] != 32))
        odd[-1] = odd[-2]
    plain = odd[last] == odd[first]
    return [raw[i:j] if p else b" ".join(raw[i:j].split()) for i, j, p in zip(a.tolist(), b.tolist(), plain.tolist(), strict=True)]


class Packed:
    """Distinct packed strings of a block in the order of the buckets, and which super-k-mer is which."""

    def __init__(self, words: Words, runs: SuperKmers, length: int, buckets: int):
        whole = names_between(words.names, runs.first, runs.last + length).astype(np.uint32)
        # equal strings have equal minimisers; together that is a name of 96 bits
        self.q = Question(runs.names, buckets, second=whole)
        self.one = np.empty(len(self.q.names), np.int64)  # a super-k-mer that holds the string
        self.one[self.q.of] = np.arange(len(runs.first))
        self.number = np.bincount(self.q.of, minlength=len(self.q.names))
        self.windows = (runs.last - runs.first + 1)[self.one]


def packed_question(block: Block, answers, _, length: int, buckets: int) -> pa.Table:
    words = Words(block)
    runs = super_kmers(words, length)
    q = Question(runs.names, buckets)
    code = np.zeros(len(q.names), np.uint8)
    for b, data in answers.items():
        code[q.parts[b] : q.parts[b + 1]] = unpack(data)[0]
    code = code[q.of]
    some = SuperKmers(runs.first[code == 1], runs.last[code == 1], runs.names[code == 1])
    many = deal_again(words, SuperKmers(runs.first[code == 2], runs.last[code == 2], runs.names[code == 2]), length)
    runs = SuperKmers(*(np.concatenate([getattr(some, x), getattr(many, x)]) for x in ("first", "last", "names")))
    packed = Packed(words, runs, length, buckets)
    first = runs.first[packed.one]
    body = bodies(block, words, first, runs.last[packed.one] + length - 1)

    share = rounds.share_of(packed.q.names, buckets, SHARES)

    def payload(s: slice) -> bytes:
        return pack(np.frombuffer(b"\n".join(body[s]), np.uint8), rounds.narrow(packed.number[s]), share[s])

    where = (rounds.narrow(runs.first[:0]),) if not len(runs.first) else (runs.first.astype(np.uint32),)
    return rounds.letters([*packed.q.by_part(payload, block.number), note(block.number, *where, rounds.narrow(runs.last - runs.first), runs.names)])


def repeated(lines: list[bytes], numbers: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Does each window of the packed strings stand twice or more, and the number of windows of each string."""
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    a, b = words_of(data, np.zeros(0, np.int64))
    ends = np.flatnonzero(data == 10)
    begin = np.searchsorted(a, np.append(0, ends[:-1]))  # first word of each string
    n = np.diff(np.append(begin, len(a))) - length + 1
    at = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
    one = names_between(names_between(data, a, b), at, at + length)
    two = names_between(names_between(data, a, b, 1), at, at + length, 1).astype(np.uint32)
    order = np.lexsort((two, one))
    s, t = one[order], two[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    first = np.flatnonzero(new)
    times = np.add.reduceat(np.repeat(numbers, n)[order], first)
    again = np.empty(len(s), bool)
    again[order] = np.repeat(times > 1, np.diff(np.append(first, len(s))))
    return again, n


def count_windows(rows: list[tuple[int, bytes]], length: int) -> list[bytes]:
    """For each packed string, one bit per window: does it stand twice or more? A share of the bucket at a time."""
    asked = [unpack(p) for _, p in rows]
    texts = [text.tobytes().split(b"\n") for text, _, _ in asked]
    cuts = [np.searchsorted(share, np.arange(SHARES + 1)).tolist() for _, _, share in asked]
    bits: list[list[np.ndarray]] = [[] for _ in rows]
    for k in range(SHARES):
        here = [i for i, c in enumerate(cuts) if c[k] < c[k + 1]]
        if not here:
            continue
        lines = [x for i in here for x in texts[i][cuts[i][k] : cuts[i][k + 1]]]
        numbers = np.concatenate([asked[i][1][cuts[i][k] : cuts[i][k + 1]] for i in here]).astype(np.int64)
        again, n = repeated(lines, numbers, length)
        sizes = [cuts[i][k + 1] - cuts[i][k] for i in here]
        per_row = np.add.reduceat(n, np.append(0, np.cumsum(sizes)[:-1]))
        for i, x in zip(here, np.split(again, np.cumsum(per_row)[:-1]), strict=True):
            bits[i].append(x)
    return [np.packbits(np.concatenate(x)).tobytes() for x in bits]


def removed_words(block: Block, words: Words, answers, saved, length: int, buckets: int) -> np.ndarray:
    """Which words of the block lie in a window that stands elsewhere too."""
    cover = np.zeros(len(words.names) + 1, np.int32)
    if saved is not None:
        first, span, names = unpack(saved)
        first = first.astype(np.int64)
        runs = SuperKmers(first, first + span.astype(np.int64), names)
        packed = Packed(words, runs, length, buckets)
        ends = np.append(0, np.cumsum(packed.windows))
        bits = np.zeros(ends[-1], bool)
        for b, data in answers.items():
            lo, hi = ends[packed.q.parts[b]], ends[packed.q.parts[b + 1]]
            bits[lo:hi] = np.unpackbits(np.frombuffer(data, np.uint8), count=int(hi - lo))
        n = runs.last - runs.first + 1
        start = np.repeat(runs.first, n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = bits[np.repeat(ends[packed.q.of], n) + step]
        at = (start + step)[hit]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
    return np.cumsum(cover[:-1], dtype=np.int32) > 0


def kept_parts(block: Block, answers, saved, length: int, buckets: int):
    words = Words(block)
    gone = removed_words(block, words, answers, saved, length, buckets)
    raw = block.data.tobytes()
    total = np.append(0, np.cumsum(gone))
    texts = []
    for d in range(len(block.ids)):
        i, j = int(words.part[d]), int(words.part[d + 1])
        if total[j] == total[i]:
            texts.append(b" ".join(raw[int(block.offsets[d]) : int(block.offsets[d + 1])].split()))
        else:
            keep = np.flatnonzero(~gone[i:j]) + i
            texts.append(b" ".join(raw[a:b] for a, b in zip(words.start[keep].tolist(), words.end[keep].tolist(), strict=True)))
    return words, total, texts


def give_digests(block: Block, *state, **p) -> pa.Table:
    words, total, texts = kept_parts(block, *state, **p)
    return pa.table({
        "doc_id": pa.array(block.ids, pa.int64(), mask=~block.known), "n_words": np.diff(words.part).astype(np.int64),
        "n_removed": (total[words.part[1:]] - total[words.part[:-1]]).astype(np.int64), "kept_sha256": [hashlib.sha256(x).hexdigest() for x in texts],
    })


def give_texts(block: Block, *state, **p) -> pa.Table:
    _, _, texts = kept_parts(block, *state, **p)
    return pa.table([pa.array(block.ids, pa.int64(), mask=~block.known), pa.array([x.decode() for x in texts], pa.string()), block.table.column("rest")], names=["doc_id", "text", "rest"])


def _rounds(docs: DataFrame, id_col: str, text_col: str, length: int, finish, schema: str, carry: bool) -> DataFrame:
    if length < GRAM:
        raise ValueError(f"windows of at least {GRAM} words")
    blocks, _ = rounds.to_blocks(docs, id_col, text_col, carry=carry)
    n = partitions(docs.sparkSession)  # a bucket holds texts here, so there are more of them than in other rounds
    p = {"length": length, "buckets": n}
    answers = rounds.settle(rounds.ask_first(blocks, partial(count_question, **p)), partial(count, crowded=CROWDED * rounds.BLOCKS * n))
    asked = rounds.ask_again(blocks, answers, partial(packed_question, **p), rounds.LETTER)
    answers = rounds.settle(asked, partial(count_windows, length=length))
    schema = schema.replace("REST", blocks.schema["rest"].dataType.simpleString()) if carry else schema
    return rounds.ask_again(blocks, answers, partial(finish, **p), schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35) -> DataFrame:
    """Per row: words, words that lie in a window of `length` words which starts anywhere else too (in the same text or
    another; every occurrence goes, the first as well), and the SHA-256 of the other words joined by one space.

    A null text has no words. Ids are only carried: rows of equal or null id are texts of their own.
    """
    return _rounds(docs, id_col, text_col, length, give_digests, DIGESTS, False)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35) -> DataFrame:
    """`docs` with the words that `digests` counts as removed taken out and the others joined by one space."""
    return with_rest(docs, _rounds(docs, id_col, text_col, length, give_texts, "doc_id long, text string, rest REST", True), id_col, text_col)


def op9_super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), length=35)


QUERIES = {"op9_super_kmer_dedup": op9_super_kmer_dedup}
ORACLES = {
    "op9_super_kmer_dedup": r"""
        WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM words)),
        again AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS n FROM windows) WHERE n > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS p FROM again),
        word AS (SELECT doc_id, unnest(w) AS s, generate_subscripts(w, 1) AS p FROM words),
        kept AS (SELECT word.doc_id, count(*) AS n_words, count(gone.p) AS n_removed, string_agg(s, ' ' ORDER BY word.p) FILTER (gone.p IS NULL) AS t
                 FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)"""
}
