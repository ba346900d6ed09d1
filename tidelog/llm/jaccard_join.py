"""Near duplicates by the Jaccard similarity of word n-grams, with prefix filters under several global orders.

Texts whose sets are similar enough must share a token among the first few of each, whatever total order of all tokens
sorts the sets. One order lets many pairs through; a pair that several orders agree on is rarely wrong, so the pairs
of the orders are intersected before any set is compared.

* Every order sorts by how many texts have a token, rarest first, to a power of two, and within that by a hash of its
  own. A token of a single text links nothing, and an ordinary text's first tokens are all of that kind, so it takes no
  further part.
* Texts of the same words are one class with one representative. It alone goes on.
* A first look compares each text with one other: the one that is most often, over all orders, the smallest to share
  one of its first few tokens. Links found give preliminary components. Pairs within one are settled, so a group of near
  copies costs a pair each, not all pairs.
* Then all tokens of the prefixes count, but only those that more than one component has. In further looks each text is
  compared with one other again: the most similar, by bitmap, of the texts of other components that its tokens have drawn,
  each one. So a group that the first look left in pieces grows together by a pair for each text and look.
* At last all pairs across the components that are left count. This finds every link that the looks missed.
* A pair is not made if no overlap that is still possible could be enough: given how many tokens of each text any
  other text has and where in the orders the shared one stands, or given the bitmaps of the two sets. In a bitmap each
  token of a set flips one bit, so two sets differ in at least as many tokens as their bitmaps differ in bits.
* Whatever proposed a pair, no text of it is opened unless the whole prefixes share a token under every order.
* Similarity is computed from the whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import rounds
from tidelog.llm.common import documents, durable_table
from tidelog.llm.components import components
from tidelog.llm.names import equal_runs, mix, names_between, words_of
from tidelog.llm.rounds import Block, Question, note, pack, unpack

KEY = 3  # with the bucket's share about 2 ** 29 counters for every 100 million tokens; a clash only makes a token look less rare
LOOK = 4  # tokens of the first look, of each order
LOOKS = 3  # further looks at most; pairs that they leave are all made
OPENED = 1 << 20  # bytes of compressed texts that are compared at a time; a single pair may be larger
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SIGNATURE = 8  # 64-bit words of a set's bitmap
_SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0x452821E638D01377, 0xBE5466CF34E90C6C)
#: kind 0: every row (doc_id, rep, size); 1: a representative that may have links (also its text, and tokens by order).
OUT = "kind int, doc_id long, rep long, size long, body binary, tokens binary"
_OUT = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("rep", pa.int64()), ("size", pa.int64()), ("body", pa.binary()), ("tokens", pa.binary())])


@dataclass(frozen=True)
class Similar:
    """Sets of `words`-grams; linked if 100 * intersection >= percent * union, filtered under `orders` orders."""

    words: int = 5
    percent: int = 80
    orders: int = 2

    def prefix(self, size: np.ndarray) -> np.ndarray:
        return size - (self.percent * size + 99) // 100 + 1


class Sets:
    """The token sets of texts: distinct names, ascending within each text, `part[i] : part[i + 1]` of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, words: int):
        data = _LOWER[data]
        a, b = words_of(data, offsets[:-1])
        self.first_word = np.searchsorted(a, offsets)
        self.word_names = names_between(data, a, b)
        count = np.diff(self.first_word)
        self.n = len(count)
        at = np.arange(max(0, len(a) - words + 1))
        doc = np.searchsorted(self.first_word, at, side="right") - 1
        inside = at + words <= self.first_word[doc + 1]
        at, doc = at[inside], doc[inside]
        names = names_between(self.word_names, at, at + words)
        short = np.flatnonzero((count > 0) & (count < words))
        if len(short):  # the whole sequence is the only token
            whole = names_between(self.word_names, self.first_word[short], self.first_word[short + 1])
            names = np.concatenate([names, mix(whole ^ count[short].astype(np.uint64))])
            doc = np.concatenate([doc, short])
        order = np.lexsort((names, doc))
        names, doc = names[order], doc[order]
        new = np.ones(len(names), bool)
        new[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
        self.names, self.doc = names[new], doc[new]
        self.part = np.searchsorted(self.doc, np.arange(self.n + 1))
        self.size = np.diff(self.part)

    def sequences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts with words, and two names of their word sequence."""
        docs = np.flatnonzero(np.diff(self.first_word) > 0)
        lo, hi = self.first_word[docs], self.first_word[docs + 1]
        length = mix((hi - lo).astype(np.uint64))
        return docs, names_between(self.word_names, lo, hi) ^ length, names_between(self.word_names, lo, hi, 1).astype(np.uint32)


def sequence_question(block: Block, sets: Sets, buckets: int) -> tuple[Question, np.ndarray]:
    docs, one, two = sets.sequences()
    known = block.known[docs]
    docs = docs[known]
    return Question(one[known], buckets, block.ids[docs], two[known]), docs


def least_ids(rows: list[tuple[int, bytes]]) -> list[bytes]:
    """For each name asked about, the smallest id of all that have it."""
    asked = [unpack(p) for _, p in rows]
    names = np.concatenate([a[0] for a in asked])
    second = np.concatenate([a[1] for a in asked])
    ids = np.concatenate([a[2][0] + a[3].astype(np.int64) for a in asked])
    order = np.lexsort((second, names))
    new = np.ones(len(names), bool)
    new[1:] = (names[order][1:] != names[order][:-1]) | (second[order][1:] != second[order][:-1])
    at = np.flatnonzero(new)
    out = np.empty(len(names), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(ids[order], at), np.diff(np.append(at, len(names))))
    return [pack(x) for x in np.split(out, np.cumsum([len(a[0]) for a in asked])[:-1])]


def token_question(sets: Sets, reps: np.ndarray, buckets: int) -> tuple[Question, np.ndarray]:
    """Names of the tokens of representatives (text numbers), and which entries of the sets they are."""
    is_rep = np.zeros(sets.n, bool)
    is_rep[reps] = True
    entry = np.flatnonzero(is_rep[sets.doc])
    return Question(sets.names[entry], buckets), entry


def count_classes(rows: list[tuple[int, bytes]]) -> list[bytes]:
    """For each token asked about, the number of bits of the number of texts that have it: 1 for a single text."""
    asked = [unpack(p) for _, p in rows]
    keys = np.concatenate([rounds.long_keys(k, KEY) for k, _ in asked]).astype(np.uint32)
    counts = np.concatenate([c.astype(np.int64) for _, c in asked])
    order = np.argsort(keys, kind="stable")
    at = equal_runs(keys[order])
    sums = np.add.reduceat(counts[order], at)
    size = np.ceil(np.log2(sums + 1)).astype(np.uint8)
    out = np.empty(len(keys), np.uint8)
    out[order] = np.repeat(size, np.diff(np.append(at, len(keys))))
    return [pack(x) for x in np.split(out, np.cumsum([len(c) for _, c in asked])[:-1])]


def first_question(block: Block, buckets: int, **rule):
    q, _ = sequence_question(block, Sets(block.data, block.offsets, rule["words"]), buckets)
    return rounds.ask_least(q, block.number)


def second_question(block: Block, answers, _, buckets: int, **rule) -> pa.Table:
    sets = Sets(block.data, block.offsets, rule["words"])
    q, docs = sequence_question(block, sets, buckets)
    least = np.empty(len(q.names), np.int64)
    for b, data in answers.items():
        least[q.parts[b] : q.parts[b + 1]] = unpack(data)[0]
    rep = least[q.of]
    reps = docs[rep == block.ids[docs]]
    # rows of one id and the same words: one of them stands for all
    one = np.unique(q.of[rep == block.ids[docs]], return_index=True)[1]
    reps = np.sort(reps[one])
    t, _ = token_question(sets, reps, buckets)
    count = np.bincount(t.of, minlength=len(t.names))
    ask = t.by_part(lambda s: pack(rounds.short_keys(t.names[s], KEY), rounds.narrow(count[s])), block.number)
    return rounds.letters([*ask, note(block.number, docs.astype(np.uint32), rep, reps.astype(np.uint32))])


def prefixes(sets: Sets, entry: np.ndarray, rarity: np.ndarray, rule: Similar) -> list[np.ndarray]:
    """For each order, the entries in their text's prefix that a second text has, rarest first within a text."""
    doc = sets.doc[entry]
    names = sets.names[entry]
    start = np.searchsorted(doc, doc)  # entries are sorted by text
    length = rule.prefix(sets.size)[doc]
    out = []
    for k in range(rule.orders):
        order = np.lexsort((mix(names ^ np.uint64(_SEEDS[k])), rarity, doc))
        place = np.arange(len(entry)) - start
        chosen = order[place < length]
        out.append(chosen[rarity[chosen] > 1])
    return out


def candidates(block: Block, answers, saved, buckets: int, **rule) -> pa.Table:
    """The rows of OUT."""
    rule = Similar(**rule)
    sets = Sets(block.data, block.offsets, rule.words)
    n = len(block.ids)
    rep = block.ids.copy()
    rows = {"doc_id": [], "size": [], "body": [], "tokens": []}
    if saved is not None:
        docs, rep_of, reps = (x.astype(np.int64) for x in unpack(saved))
        rep[docs] = rep_of
        t, entry = token_question(sets, reps, buckets)
        rarity = np.ones(len(t.names), np.uint8)
        for b, data in answers.items():
            rarity[t.parts[b] : t.parts[b + 1]] = unpack(data)[0]
        rarity = rarity[t.of]
        chosen = prefixes(sets, entry, rarity, rule)
        doc = sets.doc[entry]
        cuts = [np.searchsorted(doc[c], np.arange(sets.n + 1)) for c in chosen]
        others = np.bincount(doc[rarity > 1], minlength=sets.n).astype(np.uint64)
        bits = bitmaps(sets)
        for d in reps.tolist():
            parts = [sets.names[entry[c[cut[d] : cut[d + 1]]]] for c, cut in zip(chosen, cuts, strict=True)]
            if all(len(p) for p in parts):  # a linked text shares a token in every order
                lo, hi = int(block.offsets[d]), int(block.offsets[d + 1])
                rows["doc_id"].append(int(block.ids[d]))
                rows["size"].append(int(sets.size[d]))
                rows["body"].append(zlib.compress(block.data[lo:hi].tobytes(), 1))
                rows["tokens"].append(np.concatenate([np.array([len(p) for p in parts], np.uint64), others[d : d + 1], bits[d], *parts]).tobytes())
    m = len(rows["doc_id"])
    everyone = pa.table([
        pa.array(np.zeros(n, np.int32)), pa.array(block.ids, pa.int64(), mask=~block.known), pa.array(rep, pa.int64(), mask=~block.known),
        pa.array(sets.size.astype(np.int64)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
    ], schema=_OUT)
    some = pa.table([
        pa.array(np.ones(m, np.int32)), pa.array(rows["doc_id"], pa.int64()), pa.array(rows["doc_id"], pa.int64()), pa.array(rows["size"], pa.int64()),
        pa.array(rows["body"], pa.binary()), pa.array(rows["tokens"], pa.binary()),
    ], schema=_OUT)
    return pa.concat_tables([everyone, some])


def bitmaps(sets: Sets) -> np.ndarray:
    """SIGNATURE words for each text."""
    width = 64 * SIGNATURE
    flips = np.bincount(sets.doc * width + (mix(sets.names) % np.uint64(width)).astype(np.int64), minlength=sets.n * width)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.uint64).reshape(sets.n, SIGNATURE)


def tokens_by_order(tokens: bytes, orders: int) -> tuple[list[np.ndarray], int, np.ndarray]:
    """Tokens by order, how many of all the text's tokens another text has, and its bitmap."""
    x = np.frombuffer(tokens, np.uint64)
    begin = orders + 1 + SIGNATURE
    ends = np.cumsum(x[:orders]).astype(np.int64) + begin
    return [x[a:b] for a, b in zip(np.append(begin, ends[:-1]).tolist(), ends.tolist(), strict=True)], int(x[orders]), x[orders + 1 : begin]


def in_order(tokens: np.ndarray, order: int) -> np.ndarray:
    """Names that keep the tokens of each order apart."""
    return mix(tokens ^ mix(np.full(1, order + 1, np.uint64)))


def _first_tokens(batches: Iterator[pa.RecordBatch], orders: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (d, t)
            for d, x in zip(batch.column("doc_id").to_pylist(), batch.column("tokens").to_pylist(), strict=True)
            for k, prefix in enumerate(tokens_by_order(x, orders)[0])
            for t in in_order(prefix[:LOOK], k).view(np.int64).tolist()
        ]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(2)], names=["doc_id", "token"])


def orders_agree(a: bytes, b: bytes, orders: int) -> bool:
    """Whether two texts share a token of their prefixes under every order, as all that are linked do."""
    return all(np.isin(x, y).any() for x, y in zip(tokens_by_order(a, orders)[0], tokens_by_order(b, orders)[0], strict=True))


def _runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbours of at most `most` together, or of a single one."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if sizes:
        yield lo, len(sizes)


def _verify(batches: Iterator[pa.RecordBatch], words: int, percent: int, orders: int) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, body_a, body_b, tokens_a, tokens_b), the pairs that are linked."""
    for found in batches:
        sides = zip(found.column("tokens_a").to_pylist(), found.column("tokens_b").to_pylist(), strict=True)
        whole = found.filter(pa.array([orders_agree(x, y, orders) for x, y in sides], pa.bool_()))
        sizes = [len(x) + len(y) for x, y in zip(whole.column("body_a").to_pylist(), whole.column("body_b").to_pylist(), strict=True)]
        for lo, hi in _runs(sizes, OPENED):
            batch = whole.slice(lo, hi - lo)
            n = batch.num_rows
            bodies = [zlib.decompress(x) for c in ("body_a", "body_b") for x in batch.column(c).to_pylist()]
            offsets = np.append(0, np.cumsum([len(x) for x in bodies]))
            sets = Sets(np.frombuffer(b"".join(bodies), np.uint8), offsets, words)
            # tokens of both sides of a pair meet
            order = np.lexsort((sets.names, sets.doc % n))
            pair, name = (sets.doc % n)[order], sets.names[order]
            both = np.bincount(pair[1:][(pair[1:] == pair[:-1]) & (name[1:] == name[:-1])], minlength=n)
            union = sets.size[:n] + sets.size[n:] - both
            linked = (100 * both >= percent * union) & (both > 0)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(linked)) for c in ("a", "b")], names=["a", "b"])


def linked(pairs: DataFrame, some: DataFrame, rule: Similar) -> DataFrame:
    """Of pairs `a, b` of representatives those that all orders agree on and whose sets are similar enough."""
    side = lambda x: some.select(F.col("doc_id").alias(x), F.col("body").alias(f"body_{x}"), F.col("tokens").alias(f"tokens_{x}"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "body_a", "body_b", "tokens_a", "tokens_b")
    return rows.mapInArrow(partial(_verify, words=rule.words, percent=rule.percent, orders=rule.orders), "a long, b long").distinct()


def _differ() -> Column:
    """Bits in which the bitmaps of rows `a` and `b` differ."""
    return sum((F.bit_count(F.col(f"a.s{i}").bitwiseXOR(F.col(f"b.s{i}"))) for i in range(SIGNATURE)), F.lit(0))


def _can_link(percent: int) -> Column:
    """Whether sizes, the place of the shared token and the bitmaps of rows `a` and `b` allow a link."""
    c = lambda side, name: F.col(f"{side}.{name}")
    both = c("a", "size") + c("b", "size")
    sizes = 100 * F.least("a.size", "b.size") >= percent * F.greatest("a.size", "b.size")
    behind = F.least(c("a", "others") - c("a", "place"), c("b", "others") - c("b", "place"))  # the shared token with them
    overlap = F.least("a.place", "b.place") + behind
    return sizes & ((100 + percent) * overlap >= percent * both) & ((100 + percent) * _differ() <= (100 - percent) * both)


def first_look(some: DataFrame, rule: Similar) -> DataFrame:
    """One pair per text: the smallest id that shares most of its first tokens of all orders."""
    tokens = some.select("doc_id", "tokens").mapInArrow(partial(_first_tokens, orders=rule.orders), "doc_id long, token long")
    least = tokens.groupBy("token").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    votes = tokens.join(least, "token").filter("a < doc_id").groupBy("doc_id", "a").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("doc_id").agg(F.max(F.struct("n", (-F.col("a")).alias("a"))).alias("best"))
    return best.select((-F.col("best.a")).alias("a"), F.col("doc_id").alias("b"))


class Members:
    """Of a block of candidates: document, size, component and token of every entry, by order."""

    def __init__(self, table: pa.Table, orders: int):
        self.docs = table.column("doc_id").to_numpy()
        self.sizes = table.column("size").to_numpy()
        self.component = table.column("component").to_numpy()
        found = [tokens_by_order(x, orders) for x in table.column("tokens").to_pylist()]
        split = [f[0] for f in found]
        self.others = np.array([f[1] for f in found], np.int64)
        self.bits = np.array([f[2] for f in found], np.uint64).reshape(-1, SIGNATURE)
        self.place = np.concatenate([np.arange(len(s[k])) for k in range(orders) for s in split])
        self.row = np.concatenate([np.full(len(s[k]), i) for k in range(orders) for i, s in enumerate(split)])
        self.order = np.concatenate([np.full(sum(len(s[k]) for s in split), k) for k in range(orders)])
        self.token = np.concatenate([s[k] for k in range(orders) for s in split])
        self.name = np.concatenate([in_order(s[k], k) for k in range(orders) for s in split])

    def question(self, buckets: int) -> Question:
        return Question(self.name, buckets, self.component[self.row])


def _ask_mixed(table: pa.Table, orders: int, buckets: int) -> pa.Table:
    q = Members(table, orders).question(buckets)
    number = table.column("block")[0].as_py()
    return rounds.letters(q.by_part(lambda s: pack(rounds.short_keys(q.names[s], 5), np.packbits(q.many[s]), *rounds.id_offsets(q.least[s])), number))


def mixed(rows: list[tuple[int, bytes]]) -> list[bytes]:
    """For each token asked about: does a second component have it? Component ids travel whole: a clash would cost links."""
    asked = [unpack(p) for _, p in rows]
    sizes = [len(a[3]) for a in asked]
    keys = np.concatenate([rounds.long_keys(a[0], 5) for a in asked])
    many = np.concatenate([np.unpackbits(a[1], count=n) for a, n in zip(asked, sizes, strict=True)])
    least = np.concatenate([a[2][0] + a[3].astype(np.int64) for a in asked])
    order = np.argsort(keys, kind="stable")
    at = equal_runs(keys[order])
    c = least[order]
    yes = (np.minimum.reduceat(c, at) != np.maximum.reduceat(c, at)) | (np.maximum.reduceat(many[order], at) > 0)
    out = np.empty(len(keys), bool)
    out[order] = np.repeat(yes, np.diff(np.append(at, len(keys))))
    return [np.packbits(x).tobytes() for x in np.split(out, np.cumsum(sizes)[:-1])]


def _placed(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """`rows` with their `component`; a text without links is its own."""
    return rows.join(comps, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def open_tokens(some: DataFrame, comps: DataFrame, rule: Similar) -> DataFrame:
    """The tokens of all prefixes that more than one component has, a row for each text and order."""
    spark = some.sparkSession
    n = rounds.partitions(spark)
    buckets, orders = -(-n // rounds.BUCKETS), rule.orders
    rows = _placed(some.select("doc_id", "size", "tokens"), comps)
    blocks = rows.withColumn("block", rounds.block_of(rounds.BLOCKS * n))
    asked = blocks.groupBy("block").applyInArrow(lambda t: _ask_mixed(t, orders, buckets), rounds.LETTER)
    words = [f"s{i}" for i in range(SIGNATURE)]
    schema = "ord int, token long, place long, doc_id long, size long, component long, others long, " + ", ".join(f"{w} long" for w in words)

    def still(left: pa.Table, right: pa.Table) -> pa.Table:
        m = Members(left, orders)
        q = m.question(buckets)
        got = dict(zip(right.column("bucket").to_pylist(), right.column("payload").to_pylist(), strict=True))
        keep = np.flatnonzero(q.bits(got)[q.of])
        row = m.row[keep]
        columns = [pa.array(m.order[keep].astype(np.int32)), pa.array(m.token[keep].view(np.int64)), pa.array(m.place[keep])]
        columns += [pa.array(x[row]) for x in (m.docs, m.sizes, m.component, m.others)]
        columns += [pa.array(m.bits[:, i].view(np.int64)[row]) for i in range(SIGNATURE)]
        return pa.table(columns, names=["ord", "token", "place", "doc_id", "size", "component", "others", *words])

    found = blocks.groupBy("block").cogroup(rounds.settle(asked, mixed).groupBy("block")).applyInArrow(still, schema)
    return durable_table(found.drop("component"), "open-tokens")


def another_look(tokens: DataFrame, comps: DataFrame, rule: Similar, draw: int) -> DataFrame:
    """One pair per text. Each open token draws one of its texts; of those that its tokens drew, a text is paired with the
    one whose bitmap is most like its own, if it is of another component and may be linked."""
    rows = _placed(tokens, comps)
    row = F.struct(*(c for c in rows.columns if c not in ("ord", "token")))
    drawn = rows.groupBy("ord", "token").agg(F.min_by(row, F.struct(F.xxhash64(F.lit(draw), "ord", "token", "doc_id"), "doc_id")).alias("one"))
    a = drawn.select("ord", "token", "one.*").alias("a")
    met = a.join(rows.alias("b"), (F.col("a.ord") == F.col("b.ord")) & (F.col("a.token") == F.col("b.token"))
                 & (F.col("a.component") != F.col("b.component")) & _can_link(rule.percent))
    found = met.select(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b"), _differ().alias("n"))
    return found.groupBy("b").agg(F.min(F.struct("n", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")


def across(tokens: DataFrame, comps: DataFrame, rule: Similar) -> DataFrame:
    """Pairs of different components that share a token of the prefix in every order."""
    table, pairs = _placed(tokens, comps), None
    for k in range(rule.orders):
        one = table.filter(F.col("ord") == k).drop("ord")
        a, b = one.alias("a"), one.alias("b")
        met = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.component") < F.col("b.component")) & _can_link(rule.percent))
        met = met.select(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b")).distinct()
        pairs = met if pairs is None else pairs.join(met, ["a", "b"], "left_semi")
    return pairs


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Similar = Similar()) -> DataFrame:  # noqa: B008
    """`doc_id, n_tokens, component`, one row per row; the component is the smallest id that links lead to.

    Words are lower-cased (A-Z). A set has the distinct `rule.words`-grams; of fewer words the whole sequence as one. A
    text without words, or null, has an empty set and no links. Rows of equal id are one node of the graph. A row
    without an id is its own component, which is null.
    """
    blocks, buckets = rounds.to_blocks(docs, id_col, text_col)
    p = {"buckets": buckets, **asdict(rule)}
    asked = rounds.ask_first(blocks, partial(first_question, **p))
    asked = rounds.ask_again(blocks, rounds.settle(asked, least_ids), partial(second_question, **p), rounds.LETTER)
    out = durable_table(rounds.ask_again(blocks, rounds.settle(asked, count_classes), partial(candidates, **p), OUT), "jaccard")
    everyone, some = out.filter("kind = 0").select("doc_id", "rep", "size"), out.filter("kind = 1").select("doc_id", "size", "body", "tokens")
    same = everyone.filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    near = durable_table(linked(first_look(some, rule), some, rule), "links")
    comps = components(near)
    tokens = open_tokens(some, comps, rule)
    for draw in range(LOOKS):
        more = durable_table(linked(another_look(tokens, comps, rule, draw), some, rule), "links")
        if more.isEmpty():
            break
        near = near.unionByName(more)
        comps = components(near)
    rest = durable_table(linked(across(tokens, comps, rule), some, rule), "links")
    comps = components(same.unionByName(near).unionByName(rest))
    return everyone.join(comps, "doc_id", "left").select("doc_id", F.col("size").alias("n_tokens"), F.coalesce("component", "doc_id").alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Similar = Similar()) -> DataFrame:  # noqa: B008
    """`docs` with the smallest id of each group; rows without an id stay."""
    gone = "gone"
    while gone in docs.columns:
        gone += "_"
    found = groups(docs, id_col, text_col, rule).filter("doc_id <> component").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(found, docs[id_col].cast("long") == found[gone], "left_anti")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(documents(spark, sf_dir), rule=Similar(words=3, percent=90))
    return found.select("doc_id", F.col("n_tokens").alias("n_shingles"), F.col("component").alias("component_id"))


QUERIES = {"op2_ngram_jaccard": op2_ngram_jaccard}
ORACLES = {
    "op2_ngram_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
            FROM words),
        classes AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY ALL),
        tokens AS (SELECT rep, len(s) AS n, unnest(s) AS t FROM classes),
        both_have AS (
            SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS both_n FROM tokens a JOIN tokens b USING (t)
            WHERE a.rep < b.rep AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
        links AS (SELECT a, b FROM both_have WHERE 100 * both_n >= 90 * (na + nb - both_n)),
        near AS (SELECT a AS x, b AS y FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT rep AS x, rep AS y FROM classes UNION SELECT reach.x, near.y FROM reach JOIN near ON reach.y = near.x),
        component AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
        SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id
        FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s AND len(sets.s) > 0 LEFT JOIN component ON x = rep"""
}
