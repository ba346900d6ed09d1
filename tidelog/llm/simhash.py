"""Near duplicates by SimHash fingerprints and a self-join of their binary trie.

Equal fingerprints are one leaf of the trie, whatever the number of documents. The join walks pairs of nodes of equal
depth together, beginning with the root and itself: the differing bits of their paths are carried along, and a pair
that differs in more than the budget is not followed. The walk is done in two parts by one rule:

* over tables. Only nodes with many leaves are split, four bits a step, from counts of leaves by prefix; a pair is done
  when its two nodes together hold at most `LEAVES` leaves. So the depth follows the data: fingerprints that crowd below
  one long prefix are split further there, and nowhere else. Rows are pairs of nodes, some LEAVES times fewer than leaves.
* within tasks. The node pairs that are done are dealt out by their first node, which gets its own leaves and those of
  its partners, sorted; there the walk goes on bit by bit in numpy over arrays of node pairs. A leaf has at most
  64 + 64 * 63 / 2 leaves within two bits, so what comes out is linear in the leaves.

Links inside a task are reduced before they travel: each leaf hangs on the smallest that it is joined to.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import documents, durable_table, give_back, ship, two_columns
from tidelog.llm.components import components
from tidelog.llm.tokens import parts_of

WORDS, SEED, BUDGET = 3, 42, 2
#: Leaves that two nodes may hold together when their pair goes to a task, and bits of a step over tables.
LEAVES, STEP = 1 << 14, 4
#: Bytes of a text whose words are in memory, and node pairs that are walked, at once.
PIECE, PAIRS = 1 << 20, 1 << 15
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _runs(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about a piece at a time."""
    at = 0
    while at < len(text):
        found = _SPACE.search(text, at + PIECE)
        end = found.start() if found else len(text)
        yield text[at:end].split()  # at the white space meant here: space, and tab to carriage return
        at = end


def _count(words: list[bytes], width: int, seed: int, ones: np.ndarray) -> int:
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = len(words) - width + 1
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(view[x:y], seed) for x, y in zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)), "<u8", n)
    ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return n


def fingerprint(text: bytes, width: int = WORDS, seed: int = SEED) -> int:
    """A bit is 1 if it is in over half the XXH64 of the shingles, repeats included; 0 without words. A-Z are lowered.

    A text with fewer words than a shingle is one. A very long text goes through piece by piece.
    """
    ones, n, last = np.zeros(64, np.int64), 0, []
    for words in _runs(text.lower()):
        words = last + words
        if len(words) >= width:
            n += _count(words, width, seed, ones)
            last = words[len(words) - width + 1 :]
        else:
            last = words
    if not n and last:
        n = _count(last, len(last), seed, ones)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for part in parts_of(batch.column("text").cast(pa.binary())):
            marks = np.array([fingerprint(x, words, seed) for x in part.to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), pa.array(marks.view(np.int64))], names=["doc_id", "mark"])
            at += len(part)
    give_back()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """`doc_id, mark`: the 64 bits as a long. Null and empty texts have 0; null and repeated ids are rows of their own."""
    ship(docs.sparkSession)
    return two_columns(docs, id_col, text_col).mapInArrow(partial(_fingerprints, words=words, seed=seed), "doc_id long, mark long")


def walk(mine: np.ndarray, theirs: np.ndarray, at: int, nodes: list[tuple[int, int, int, int, int]], budget: int, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in `mine` and `theirs` (both sorted) of leaves that differ in at most `budget` bits.

    `nodes`: pairs (lo, hi, lo, hi, differing bits) of nodes at depth `at`. With `itself` the two are the same trie and
    each pair comes once.
    """
    stack = [(at, np.array(nodes, np.int64).reshape(-1, 5))]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > PAIRS:  # a bounded number is in memory
            half = len(pairs) // 2
            stack += [(depth, pairs[:half]), (depth, pairs[half:])]
            continue
        a, b, c, d, e = pairs.T
        few = ((b - a) * (d - c) <= 16) | (depth == 64)
        if few.any():
            yield from _leaves(mine, theirs, pairs[few], budget, itself)
        pairs = pairs[~few]
        if not len(pairs):
            continue
        a, b, c, d, e = pairs.T
        m, n = _split(mine, a, b, depth), _split(theirs, c, d, depth)
        split = [(a, m, c, n, e), (m, b, n, d, e), (a, m, n, d, e + 1), (m, b, c, n, e + 1)]
        if itself:  # of a node and itself, one of the crossed pairs is enough
            same = a == c
            split[3] = tuple(np.where(same, 0, x) if i < 4 else x for i, x in enumerate(split[3]))
        grown = np.concatenate([np.stack(x, axis=1) for x in split])
        stack.append((depth + 1, grown[(grown[:, 1] > grown[:, 0]) & (grown[:, 3] > grown[:, 2]) & (grown[:, 4] <= budget)]))


def _split(marks: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the leaves of each node with a 1 at this depth begin."""
    shift = np.uint64(63 - depth)
    return np.clip(np.searchsorted(marks, ((marks[lo] >> shift) | np.uint64(1)) << shift), lo, hi)


def _leaves(mine: np.ndarray, theirs: np.ndarray, pairs: np.ndarray, budget: int, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    a, b, c, d, _ = pairs.T
    for start in range(0, len(pairs), PAIRS):
        s = slice(start, start + PAIRS)
        left, right = b[s] - a[s], d[s] - c[s]
        n = left * right
        of = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        x, y = a[s][of] + k // right[of], c[s][of] + k % right[of]
        good = np.bitwise_count(mine[x] ^ theirs[y]) <= budget
        if itself:
            good &= x < y
        if good.any():
            yield x[good], y[good]


class Forest:
    """Numbers from 0 to n - 1, of which some are joined; everything hangs on the smallest it is joined to."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while ((y := self.up[x]) != x).any():
            self.up[x] = x = self.up[y]
        return x

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        a, b = self.roots(x), self.roots(y)
        while (new := a != b).any():
            a, b = a[new], b[new]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))
            a, b = self.roots(a), self.roots(b)


def _at_home(depth: int, budget: int) -> Callable[[pa.Table], pa.Table]:
    def at_home(group: pa.Table) -> pa.Table:
        return _join_home(group, depth, budget)

    return at_home


def _join_home(group: pa.Table, depth: int, budget: int) -> pa.Table:
    """What the leaves of one node are joined to, among themselves and among those of its partners."""
    mine, theirs = (np.unique(np.asarray(pc.list_flatten(group.filter(pc.equal(group["partner"], side))["marks"])).astype(np.int64)).view(np.uint64) for side in (False, True))
    mine.sort()
    theirs.sort()
    every = np.concatenate([mine, theirs])
    forest = Forest(len(every))
    if pc.any(group["itself"]).as_py():
        for x, y in walk(mine, mine, depth, [(0, len(mine), 0, len(mine), 0)], budget, True):
            forest.add(x, y)
    if len(theirs):
        heads = theirs >> np.uint64(64 - depth) if depth else np.zeros(len(theirs), np.uint64)
        at = np.flatnonzero(np.append(True, heads[1:] != heads[:-1]))
        own = mine[0] >> np.uint64(64 - depth) if depth else np.uint64(0)
        apart = np.bitwise_count(heads[at] ^ own)
        ends = np.append(at[1:], len(theirs))
        nodes = [(0, len(mine), lo, hi, e) for lo, hi, e in zip(at.tolist(), ends.tolist(), apart.tolist(), strict=True)]
        for x, y in walk(mine, theirs, depth, nodes, budget, False):
            forest.add(x, y + len(mine))
    root = forest.roots(np.arange(len(every)))
    joined = np.flatnonzero(root != np.arange(len(every)))
    return pa.table({"a": pa.array(every[root[joined]].view(np.int64)), "b": pa.array(every[joined].view(np.int64))})


def _prefix(depth: int) -> Column:
    """The first `depth` bits of `mark`."""
    return F.shiftrightunsigned(F.col("mark"), 64 - depth) if depth else F.lit(0).cast("long")


def node_pairs(marks: DataFrame, budget: int, leaves: int, most: int) -> list[tuple[int, DataFrame]]:
    """`p, q` (p <= q) by depth: the pairs of nodes that are done. `marks` are distinct; `most` is their number."""
    spark = marks.sparkSession
    depth = 0
    while most >> depth > leaves // 4 and depth < 3 * STEP:  # where evenly spread leaves would be few enough
        depth += 1
    done: list[tuple[int, DataFrame]] = []
    counts = durable_table(marks.groupBy(_prefix(depth).alias("p")).agg(F.count(F.lit(1)).alias("n")), "nodes")
    pairs = _pairs_at(counts, depth, budget)
    while True:
        sized = pairs.join(counts.withColumnsRenamed({"n": "np"}), "p").join(counts.withColumnsRenamed({"p": "q", "n": "nq"}), "q")
        small = F.when(F.col("p") == F.col("q"), F.col("np")).otherwise(F.col("np") + F.col("nq")) <= leaves
        table = durable_table(sized.select("p", "q", "e", (small | F.lit(depth == 64)).alias("done")), "pairs")
        done.append((depth, table.filter("done").select("p", "q")))
        rest = table.filter("NOT done").select("p", "q", "e")
        if rest.isEmpty():
            return done
        step = min(STEP, 64 - depth)
        depth += step
        # the nodes below those that are split on, with the number of their leaves
        wide = rest.select(F.explode(F.array("p", "q")).alias("up")).distinct()
        below = marks.select(_prefix(depth).alias("p"), F.shiftrightunsigned(_prefix(depth), step).alias("up")).join(wide, "up")
        counts = durable_table(below.groupBy("up", "p").agg(F.count(F.lit(1)).alias("n")), "nodes")
        left = rest.join(counts.select(F.col("up").alias("p"), F.col("p").alias("p2")), "p")
        both = left.join(counts.select(F.col("up").alias("q"), F.col("p").alias("q2")), "q").filter("p <> q OR p2 <= q2")
        e = F.col("e") + F.bit_count(F.col("p2").bitwiseXOR(F.col("q2")).bitwiseAND(F.lit((1 << step) - 1).cast("long")))
        pairs = both.select(F.col("p2").alias("p"), F.col("q2").alias("q"), e.cast("int").alias("e")).filter(F.col("e") <= budget)
        counts = counts.select("p", "n")


def _pairs_at(counts: DataFrame, depth: int, budget: int) -> DataFrame:
    """All pairs of nodes of one depth within the budget, by turning bits: the same as walking there from the root."""
    bits = [0]
    for _ in range(budget):
        bits = sorted({x ^ (1 << i) for x in bits for i in range(depth)} | set(bits))
    turned = counts.select("p", F.explode(F.array(*[F.lit(x).cast("long") for x in bits])).alias("x"))
    q = F.col("p").bitwiseXOR(F.col("x"))
    return turned.select("p", q.alias("q"), F.bit_count("x").cast("int").alias("e")).filter("p <= q").join(counts.select(F.col("p").alias("q")), "q", "left_semi")


def links(marks: DataFrame, budget: int = BUDGET, leaves: int = LEAVES) -> DataFrame:
    """`a, b`: links that join whatever distinct `mark`s can be reached over differences of at most `budget` bits."""
    marks = durable_table(marks.select("mark").distinct(), "marks")
    out = []
    for depth, pairs in node_pairs(marks, budget, leaves, marks.count()):
        swap = F.xxhash64("p", "q") % 2 == 0  # either node may be the pair's home, or the first ones would have most to do
        homes = pairs.select(F.when(swap, F.col("q")).otherwise(F.col("p")).alias("home"), F.when(swap, F.col("p")).otherwise(F.col("q")).alias("node"))
        own = homes.groupBy("home").agg(F.max(F.col("home") == F.col("node")).alias("itself"))
        # a node of a pair that is done holds a bounded number of leaves, which travel as one array
        needed = homes.select(F.explode(F.array("home", "node")).alias("node")).distinct()
        held = marks.select(_prefix(depth).alias("node"), "mark").join(needed, "node").groupBy("node").agg(F.collect_list("mark").alias("marks"))
        held = durable_table(held, "held")
        mine = held.withColumnRenamed("node", "home").join(own, "home").select("home", "marks", F.lit(False).alias("partner"), "itself")
        others = homes.filter("home <> node").join(held, "node").select("home", "marks", F.lit(True).alias("partner"), F.lit(False).alias("itself"))
        rows = mine.unionByName(others)
        out.append(rows.groupBy("home").applyInArrow(_at_home(depth, budget), "a long, b long"))
    return reduce(DataFrame.unionByName, out)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET, words: int = WORDS, seed: int = SEED, leaves: int = LEAVES) -> DataFrame:
    """`doc_id, fingerprint` (16 hexadecimal digits), `component_id`: the smallest id that can be reached over links.

    Fingerprints link if at most `budget` bits differ. Null and empty texts have the fingerprint 0, and link like any
    other; a row with a null id has the smallest other id of its component, or null. Rows of equal id or text are rows
    of their own. Other columns are not read. No rows give no rows.
    """
    own = durable_table(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    least = durable_table(own.groupBy("mark").agg(F.min("doc_id").alias("least")), "least")
    parts = components(links(least, budget, leaves), "simhash").withColumnsRenamed({"doc_id": "mark", "component": "root"})
    placed = durable_table(least.join(parts, "mark", "left").withColumn("root", F.coalesce("root", "mark")), "placed")
    first = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    told = placed.join(first, "root").select("mark", "component_id")
    return own.join(told, "mark").select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(documents(spark, sf_dir))


QUERIES = {"op12_simhash": op12_simhash}
