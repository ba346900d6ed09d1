"""Sub-string removal across documents: prefix doubling over a sparse suffix array.

A suffix array of all positions, sorted at offsets 1, 2, 4, ..., would move every position in every round. Only the
strings of exactly `length` bytes matter here, so ranks serve for equality alone and most positions need none:

* Of each window of `length` bytes one position is its *anchor*: the place of the least 16-byte name in it. It depends
  on the window's bytes only, so equal windows have equal anchors, and neighbouring windows mostly share theirs. A
  *run* is a maximal row of windows with the same anchor (about 18 windows).
* Round 1 (16 bytes): anchors are ranked by 16 bytes. An anchor whose string stands in no other document is out, with
  all windows of its run.
* Round 2 (whole runs): runs of the same bytes get one rank; all but those in the smallest document are settled, their
  windows repeat. Copies, however many, end here.
* Round 3 (32 bytes): the rank at offset -16 or 0 and the one 16 bytes on make a pair, which is ranked again. Windows
  that contain a pair of a single document are out.
* Round 4 (past the threshold): what is left, windows of `length` bytes, is ranked, and the smallest document found.

Ranks are 64-bit names (see `names`) that meet in the bucket that they pick, and are sorted there; rounds 2 and 4, on
which removal rests, use 96 bits. A position that is unique leaves the rounds, so each round is smaller than the last.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import rounds
from tidelog.llm.common import documents, with_rest
from tidelog.llm.names import PIECE, bytes_sums, least_positions, mix, names_between
from tidelog.llm.rounds import Block, Question, note, unpack

GRAM, KEY = 16, 5
SPANS = "doc_id long, starts array<long>, ends array<long>"
DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class Runs:
    """Runs of a block: first and last window start, anchor, document."""

    def __init__(self, first, last, anchor, block: Block):
        self.first, self.last, self.anchor = first, last, anchor
        self.doc = block.doc_at(first)

    def only(self, keep, block: Block) -> Runs:
        return Runs(self.first[keep], self.last[keep], self.anchor[keep], block)


def pieces(block: Block, length: int):
    for lo in range(0, max(0, len(block.data) - length + 1), PIECE):
        yield lo, min(len(block.data), lo + PIECE + length - 1)


def find_runs(block: Block, length: int) -> tuple[Runs, np.ndarray]:
    """All runs, and the names of their anchors."""
    firsts, lasts, anchors, names = [], [], [], []
    for lo, hi in pieces(block, length):
        gram = bytes_sums(block.data[lo:hi]).every(GRAM)
        at = least_positions(gram, length - GRAM + 1)
        fits = np.ones(len(at), bool)
        a, b = np.searchsorted(block.offsets, [lo + 1, hi])
        for end in (block.offsets[a : b + 1] - lo).tolist():  # windows that would reach beyond their document
            fits[max(0, end - length + 1) : max(0, end)] = False
        i = np.flatnonzero(fits)
        i = i[block.known[block.doc_at(i + lo)]]
        if not len(i):
            continue
        p = at[i]
        new = np.ones(len(i), bool)
        new[1:] = (p[1:] != p[:-1]) | (i[1:] != i[:-1] + 1)
        k = np.flatnonzero(new)
        firsts.append(i[k] + lo)
        lasts.append(i[np.append(k[1:], len(i)) - 1] + lo)
        anchors.append(p[k] + lo)
        names.append(gram[p[k]])
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    # a run that goes on in the next piece stays in two parts, each of them a run
    return Runs(join(firsts, np.int64), join(lasts, np.int64), join(anchors, np.int64), block), mix(join(names, np.uint64))


def run_question(block: Block, runs: Runs, length: int, buckets: int) -> Question:
    """Names of whole runs, which also tell where the windows stand around the anchor."""
    end = runs.last + length
    where = mix((runs.anchor - runs.first).astype(np.uint64))
    return Question(
        names_between(block.data, runs.first, end) ^ where, buckets, block.ids[runs.doc], names_between(block.data, runs.first, end, 1).astype(np.uint32)
    )


def save_runs(runs: Runs) -> list[np.ndarray]:
    step = np.diff(runs.first, prepend=0)
    return [rounds.narrow(step), rounds.narrow(runs.last - runs.first), rounds.narrow(runs.anchor - runs.first)]


def load_runs(block: Block, saved: list[np.ndarray]) -> Runs:
    first = np.cumsum(saved[0].astype(np.int64))
    return Runs(first, first + saved[1].astype(np.int64), first + saved[2].astype(np.int64), block)


def first_question(block: Block, length: int, buckets: int):
    runs, names = find_runs(block, length)
    yield from rounds.ask_shared(Question(names, buckets, block.ids[runs.doc]), block.number, KEY)


def second_question(block: Block, answers, _, length: int, buckets: int) -> pa.Table:
    runs, names = find_runs(block, length)
    q = Question(names, buckets, block.ids[runs.doc])
    runs = runs.only(q.bits(answers)[q.of], block)
    return rounds.letters([*rounds.ask_least(run_question(block, runs, length, buckets), block.number), note(block.number, *save_runs(runs))])


def pair_names(block: Block, runs: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs, the pairs of 16-byte ranks to ask about: name, number of the run, is it the one left of the anchor.

    A window that starts 16 bytes or more before its anchor holds the pair on the left, any other the one on the right.
    """
    f = partial(names_between, block.data)
    left = np.flatnonzero(runs.anchor - runs.first >= GRAM)
    right = np.flatnonzero(runs.anchor - runs.last < GRAM)
    a = runs.anchor
    names = np.concatenate([
        f(a[left] - GRAM, a[left]) ^ mix(f(a[left], a[left] + GRAM) + np.uint64(1)),
        f(a[right], a[right] + GRAM) ^ mix(f(a[right] + GRAM, a[right] + 2 * GRAM) + np.uint64(2)),
    ])
    return mix(names), np.concatenate([left, right]), np.repeat([True, False], [len(left), len(right)])


def third_question(block: Block, answers, saved, length: int, buckets: int) -> pa.Table:
    runs = load_runs(block, unpack(saved))
    q = run_question(block, runs, length, buckets)
    own = block.ids[runs.doc]
    smallest = q.bits(answers)[q.of] & (own == q.least[q.of])
    gone = runs.only(~smallest, block)
    rest = runs.only(smallest, block)
    names, of, _ = pair_names(block, rest)
    pairs = Question(names, buckets, block.ids[rest.doc[of]])
    return rounds.letters([*rounds.ask_shared(pairs, block.number, KEY), note(block.number, *save_runs(gone), *save_runs(rest))])


def windows_left(runs: Runs, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Starts of the windows of runs whose pair on that side has been found in several documents."""
    border = runs.anchor - GRAM  # the last start that is on the left
    lo = np.concatenate([runs.first[left], np.maximum(runs.first, border + 1)[right]])
    hi = np.concatenate([np.minimum(runs.last, border)[left], runs.last[right]])
    n = np.maximum(hi - lo + 1, 0)
    at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
    return np.sort(at)


def window_question(block: Block, starts: np.ndarray, length: int, buckets: int) -> Question:
    second = names_between(block.data, starts, starts + length, 1).astype(np.uint32)
    return Question(names_between(block.data, starts, starts + length), buckets, block.ids[block.doc_at(starts)], second)


def fourth_question(block: Block, answers, saved, length: int, buckets: int) -> pa.Table:
    saved = unpack(saved)
    rest = load_runs(block, saved[3:6])
    names, of, on_left = pair_names(block, rest)
    pairs = Question(names, buckets, block.ids[rest.doc[of]])
    yes = pairs.bits(answers)[pairs.of]
    left = np.zeros(len(rest.first), bool)
    right = left.copy()
    left[of[yes & on_left]] = True
    right[of[yes & ~on_left]] = True
    starts = windows_left(rest, left, right)
    step = rounds.narrow(np.diff(starts, prepend=0))
    return rounds.letters([*rounds.ask_least(window_question(block, starts, length, buckets), block.number), note(block.number, *saved[:3], step)])


def spans_of(block: Block, answers, saved, length: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the maximal spans to remove, in the block's bytes, and where each document's part begins."""
    cover = np.zeros(len(block.data) + 1, np.int32)
    if saved is not None:
        saved = unpack(saved)
        gone = load_runs(block, saved[:3])
        starts = np.cumsum(saved[3].astype(np.int64))
        q = window_question(block, starts, length, buckets)
        again = ~(q.bits(answers)[q.of] & (block.ids[block.doc_at(starts)] == q.least[q.of]))
        for a, b in ((gone.first, gone.last + length), (starts[again], starts[again] + length)):
            np.add.at(cover, a, 1)
            np.add.at(cover, b, -1)
    covered = np.cumsum(cover[:-1], dtype=np.int32) > 0
    edge = np.diff(covered.astype(np.int8), prepend=0)
    inner = block.offsets[(block.offsets > 0) & (block.offsets < len(covered))]
    cut = inner[covered[inner] & covered[inner - 1]]  # a span ends with its document
    begin = np.union1d(np.flatnonzero(edge == 1), cut)
    end = np.union1d(np.flatnonzero(edge == -1), cut)
    if len(covered) and covered[-1]:
        end = np.append(end, len(covered))
    return begin, end, np.searchsorted(block.doc_at(begin), np.arange(len(block.ids) + 1))


def kept_bytes(block: Block, begin: np.ndarray, end: np.ndarray, part: np.ndarray):
    """Per document, what is left of its bytes."""
    body = block.data.tobytes()
    for d in range(len(block.ids)):
        at, out = int(block.offsets[d]), []
        for a, b in zip(begin[part[d] : part[d + 1]].tolist(), end[part[d] : part[d + 1]].tolist(), strict=True):
            out.append(body[at:a])
            at = b
        out.append(body[at : int(block.offsets[d + 1])])
        yield b"".join(out)


def own_ids(block: Block) -> pa.Array:
    return pa.array(block.ids, pa.int64(), mask=~block.known)


def give_spans(block: Block, *state, **p) -> pa.Table:
    begin, end, part = spans_of(block, *state, **p)
    shift = block.offsets[block.doc_at(begin)]
    lists = [pa.ListArray.from_arrays(pa.array(part, pa.int32()), pa.array(x - shift)) for x in (begin, end)]
    return pa.table([own_ids(block), *lists], names=["doc_id", "starts", "ends"])


def give_digests(block: Block, *state, **p) -> pa.Table:
    begin, end, part = spans_of(block, *state, **p)
    sums = np.concatenate([[0], np.cumsum(end - begin)])
    return pa.table({
        "doc_id": own_ids(block), "n_bytes": np.diff(block.offsets).astype(np.int64), "n_removed": (sums[part[1:]] - sums[part[:-1]]).astype(np.int64),
        "n_spans": np.diff(part).astype(np.int64), "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept_bytes(block, begin, end, part)],
    })


def give_texts(block: Block, *state, **p) -> pa.Table:
    """Texts without the spans, of which only whole characters go, so that a text stays valid UTF-8."""
    begin, end, part = spans_of(block, *state, **p)
    inside = (np.append(block.data, 0) & 0xC0) == 0x80  # a byte that continues a character
    for _ in range(3):
        begin = begin + inside[begin]
        end = end - inside[end]
    end = np.maximum(begin, end)
    texts = [x.decode() for x in kept_bytes(block, begin, end, part)]
    return pa.table([own_ids(block), pa.array(texts, pa.string()), block.table.column("rest")], names=["doc_id", "text", "rest"])


def _rounds(docs: DataFrame, id_col: str, text_col: str, length: int, finish, schema: str, carry: bool = False) -> DataFrame:
    if length < 3 * GRAM - 1:
        raise ValueError(f"strings of at least {3 * GRAM - 1} bytes")
    blocks, n = rounds.to_blocks(docs, id_col, text_col, carry=carry)
    p = {"length": length, "buckets": n}
    asked = rounds.ask_first(blocks, partial(first_question, **p))
    asked = rounds.ask_again(blocks, rounds.settle(asked, partial(rounds.shared, size=KEY)), partial(second_question, **p), rounds.LETTER)
    asked = rounds.ask_again(blocks, rounds.settle(asked, rounds.has_least), partial(third_question, **p), rounds.LETTER)
    asked = rounds.ask_again(blocks, rounds.settle(asked, partial(rounds.shared, size=KEY)), partial(fourth_question, **p), rounds.LETTER)
    schema = schema.replace("REST", blocks.schema["rest"].dataType.simpleString()) if carry else schema
    return rounds.ask_again(blocks, rounds.settle(asked, rounds.has_least), partial(finish, **p), schema)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """`doc_id, starts, ends`: the UTF-8 byte spans of each text covered by strings of `length` bytes that also start
    in a text with a smaller id. Spans are maximal and ascending; matches do not cross texts.

    A null text counts as empty; texts shorter than `length` have no spans. Rows of the same id are one source: none
    of them is smaller than the other. A row without an id has no spans and is no source. One row comes back per row.
    """
    return _rounds(docs, id_col, text_col, length, give_spans, SPANS)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """As `repeated_spans`, with sizes and the SHA-256 of the bytes that stay."""
    return _rounds(docs, id_col, text_col, length, give_digests, DIGESTS)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """`docs` with the repeated spans of `repeated_spans` cut out of the text, except for bytes of a character that
    lies only partly in a span. Every row and every other column stays, the id as long."""
    out = _rounds(docs, id_col, text_col, length, give_texts, "doc_id long, text string, rest REST", carry=True)
    return with_rest(docs, out, id_col, text_col)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), length=50)


QUERIES = {"op1_suffix_array_dedup": op1_suffix_array_dedup}
ORACLES = {
    "op1_suffix_array_dedup": r"""
        WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        windows AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 49)) AS p FROM bytes)),
        again AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS least FROM windows) WHERE least < doc_id),
        run AS (SELECT doc_id, p, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k
                FROM (SELECT doc_id, p, p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, -1) AS fresh FROM again)),
        span AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM run GROUP BY doc_id, k),
        piece AS (SELECT doc_id, a, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next FROM span),
        kept AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
                        substr(any_value(h), 1, 2 * min(a)) || string_agg(substr(h, 2 * b + 1, coalesce(2 * (next - b), length(h))), '' ORDER BY a) AS t
                 FROM piece JOIN bytes USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(t, h))) AS kept_sha256
        FROM bytes LEFT JOIN kept USING (doc_id)"""
}
