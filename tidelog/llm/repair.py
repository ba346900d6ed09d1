"""Repair of conversations by fewest-cost edits, found by Hirschberg's divide and conquer.

What remains of a conversation must read `(s?(ua)+)?` in the first letters of its roles. A state says what was put out
last: 0 nothing, 1 a system turn, 2 a user turn, 3 an assistant turn. A row is kept, given another role or deleted, and
empty turns may be inserted before it, so it moves the state at a cost; a conversation is a walk from state 0 to 0 or 3.

Memory is linear: a vector of four costs runs forward from the beginning and another backward from the end, they meet in
the middle, the crossing of least cost is taken, and both halves are solved alike. Edits are written as letters (D, I,
K, R). Of crossings of equal cost the one with the least letters on its left is taken; for that the forward vector also
ranks its four states by the letters that lead there. Two such strings hold equally many rows and end in one, so none
begins with another, and the same letters lead to the same state: the rank alone decides.

Long conversations are cut into slices. A slice is a table of costs and ranks from state to state; tables of
neighbouring slices are folded in a tree, the walk is decided from its top down by the same meeting in the middle, over
tables instead of rows, and each slice is then solved by itself. What travels is one byte a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import durable_table
from tidelog.llm.turns import CONV, joined_digests, numbered, plain_turns, text_digest

#: Rows of a slice, and slices (or groups of them) that one table stands for.
SLICE, FAN = 4096, 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SYSTEM, USER, ASSISTANT, OTHER = range(4)
FINE, CUT_SHORT, MUST_GO = range(3)
WHITE = " \t\n\x0b\f\r"
END = ".!?"
NEVER = 1 << 60
#: The state an inserted (or renamed) turn leads to, and its role.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: What is inserted at the very end, by state, so that a conversation ends well.
TRAIL = ("", "II", "I", "")
_KEPT = {SYSTEM: {0: 1}, USER: {0: 2, 1: 2, 3: 2}, ASSISTANT: {2: 3}, OTHER: {}}

#: From state to state: cost, place in the order of the letters among what starts in the same state, letters (of rows).
Table = tuple[tuple[tuple[int, int, str], ...], ...]


def _inserted(state: int) -> Iterator[tuple[int, int]]:
    """States reached by inserting 0, 1 and 2 turns; a third one would lead back."""
    for k in range(3):
        yield k, state
        state = NEXT[state]


@lru_cache(maxsize=16)
def row_table(code: int) -> Table:
    kind, fault = divmod(code, 3)
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for s in range(4):
        for k, at in _inserted(s):
            moves = [("D", at, DELETE)]
            if fault != MUST_GO:
                more = TRUNCATED if fault == CUT_SHORT else 0
                moves.append(("R", NEXT[at], REROLE + more))
                if at in _KEPT[kind]:
                    moves.append(("K", _KEPT[kind][at], KEEP + more))
            for letter, to, cost in moves:
                way = (cost + k * INSERT, "I" * k + letter)
                best[s, to] = min(way, best.get((s, to), way))
    order = sorted({w for _, w in best.values()})
    never = (NEVER, 0, "")
    return tuple(tuple((best[s, t][0], order.index(best[s, t][1]), best[s, t][1]) if (s, t) in best else never for t in range(4)) for s in range(4))


Vector = tuple[tuple[int, int], ...]


def _from(state: int) -> Vector:
    return tuple((0, 0) if s == state else (NEVER, 9) for s in range(4))


def _forward(vector: Vector, table: Table) -> Vector:
    """Cost and rank by state, one row (or one slice) further."""
    best = []
    for t in range(4):
        ways = [(c + table[s][t][0], r, table[s][t][1]) for s, (c, r) in enumerate(vector) if c < NEVER and table[s][t][0] < NEVER]
        best.append(min(ways) if ways else (NEVER, 9, 9))
    ranks = sorted((r, o) for c, r, o in best if c < NEVER)
    return tuple((c, ranks.index((r, o)) if c < NEVER else 9) for c, r, o in best)


def _backward(vector: tuple[int, ...], table: Table) -> tuple[int, ...]:
    return tuple(min(NEVER, min(table[s][t][0] + vector[t] for t in range(4))) for s in range(4))


# costs are remembered relative to the least, so the vectors that occur are few
@lru_cache(maxsize=1 << 16)
def _forward_row(vector: Vector, code: int) -> tuple[int, Vector]:
    out = _forward(vector, row_table(code))
    least = min(c for c, _ in out)
    return least, tuple((c - least if c < NEVER else NEVER, r) for c, r in out)


@lru_cache(maxsize=1 << 16)
def _backward_row(vector: tuple[int, ...], code: int) -> tuple[int, tuple[int, ...]]:
    out = _backward(vector, row_table(code))
    least = min(out)
    return least, tuple(c - least if c < NEVER else NEVER for c in out)


class Rows:
    """Rows of a slice, as one byte each."""

    def __init__(self, codes: bytes):
        self.codes = codes

    def forward(self, lo: int, hi: int, state: int) -> tuple[int, Vector]:
        vector, cost = _from(state), 0
        for code in self.codes[lo:hi]:
            least, vector = _forward_row(vector, code)
            cost += least
        return cost, vector

    def backward(self, lo: int, hi: int, state: int) -> tuple[int, ...]:
        vector = tuple(0 if s == state else NEVER for s in range(4))
        for code in reversed(self.codes[lo:hi]):
            vector = _backward_row(vector, code)[1]
        return vector


class Slices:
    """Tables of neighbouring slices."""

    def __init__(self, tables: list[Table]):
        self.tables = tables

    def forward(self, lo: int, hi: int, state: int) -> tuple[int, Vector]:
        vector = _from(state)
        for table in self.tables[lo:hi]:
            vector = _forward(vector, table)
        return 0, vector

    def backward(self, lo: int, hi: int, state: int) -> tuple[int, ...]:
        vector = tuple(0 if s == state else NEVER for s in range(4))
        for table in reversed(self.tables[lo:hi]):
            vector = _backward(vector, table)
        return vector


def meet(what: Rows | Slices, lo: int, hi: int, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The states before and after each of [lo, hi), on the least-cost walk with the least letters."""
    if hi - lo == 1:
        yield start, end
    elif hi > lo:
        middle = (lo + hi) // 2
        left, right = what.forward(lo, middle, start)[1], what.backward(middle, hi, end)
        cross = min((c + right[s], rank, s) for s, (c, rank) in enumerate(left))[2]
        yield from meet(what, lo, middle, start, cross)
        yield from meet(what, middle, hi, cross, end)


def last_state(vector: Vector) -> int:
    return min((c + INSERT * len(TRAIL[s]), rank, s) for s, (c, rank) in enumerate(vector))[2]


def edits_of(codes: bytes, start: int, end: int | None) -> tuple[str, str, int]:
    """Letters of a slice between two states, the state after each, and what they cost; without an end the
    conversation is over after it."""
    rows = Rows(codes)
    to = last_state(rows.forward(0, len(codes), start)[1]) if end is None else end
    letters, states, cost = [], [], 0
    for code, (s, t) in zip(codes, meet(rows, 0, len(codes), start, to), strict=True):
        price, _, own = row_table(code)[s][t]
        cost += price
        letters.append(own)
        states += [x for _, x in _inserted(s)][1 : len(own)] + [t]
    for _, x in list(_inserted(to))[1 : len(TRAIL[to]) + 1] if end is None else ():
        letters.append("I")
        states.append(x)
        cost += INSERT
    return "".join(letters), "".join(map(str, states)), cost


# --- on Spark ----------------------------------------------------------------------------------------------

_SOLVED = "absent boolean, cid long, slice long, letters string, states string, cost long, illegal long"
_TABLE = "absent boolean, cid long, slice long, costs array<long>, ranks array<int>"
_STATES = "absent boolean, cid long, slice long, state int, last int"


def _initial(role: str) -> Column:
    first = F.left(F.col(role), F.lit(1))
    return F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)


def faults(rows: DataFrame) -> DataFrame:
    """`numbered` rows with `fault` (null, blank, duplicate or truncated; the first of them counts) and `code`."""
    bare = F.rtrim("text", F.lit(WHITE))
    marked = rows.select(*CONV, "pos", "turn", _initial("role").alias("kind"), text_digest("role", "text").alias("said"), (bare == "").alias("blank"), F.contains(F.lit(END), F.right(bare, F.lit(1))).alias("ended"))
    # the first of equal rows; both sides of the join have one row for each place of a conversation
    firsts = marked.groupBy(*CONV, "said").agg(F.min("pos").alias("pos")).select(*CONV, "pos", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("ended"), "truncated")
    told = marked.join(firsts, [*CONV, "pos"], "left").withColumn("fault", fault)
    grade = F.when(F.col("fault") == "truncated", CUT_SHORT).when(F.col("fault").isNotNull(), MUST_GO).otherwise(FINE)
    return told.select(*CONV, "pos", "turn", "fault", (F.col("kind") * 3 + grade).cast("byte").alias("code"))


def _slices(told: DataFrame, size: int) -> DataFrame:
    """`absent, cid, slice, codes`: the rows of a slice in order, and the row behind it."""
    own = F.call_function("div", F.col("pos"), F.lit(size).cast("long"))
    # the first row of a slice is also shown to the slice before
    shown = F.when((F.col("pos") % size == 0) & (F.col("pos") > 0), F.array(own, own - 1)).otherwise(F.array(own))
    rows = told.select(*CONV, "pos", "code", F.explode(shown).alias("slice"))
    packed = rows.groupBy(*CONV, "slice").agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows"))
    return packed.select(*CONV, "slice", F.transform("rows", lambda r: r["code"]).alias("codes"))


def _table_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for absent, cid, number, codes in zip(*(batch.column(c).to_pylist() for c in ("absent", "cid", "slice", "codes")), strict=True):
            rows = Rows(bytes(codes[:size]))
            out.append((absent, cid, number, *_flat([rows.forward(0, len(rows.codes), s) for s in range(4)])))
        yield _batch(out, _TABLE)


def _flat(vectors: list[tuple[int, Vector]]) -> tuple[list[int], list[int]]:
    return [min(NEVER, base + c) for base, v in vectors for c, _ in v], [r for _, v in vectors for _, r in v]


def _unflat(costs: list[int], ranks: list[int]) -> Table:
    return tuple(tuple((costs[4 * s + t], ranks[4 * s + t], "") for t in range(4)) for s in range(4))


_ARROW = {"boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split(" ") for x in ddl.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _ARROW[k]) for i, k in enumerate(kinds)], names=list(names))


def _fold(group: pa.Table) -> pa.Table:
    """One table for neighbouring ones."""
    group = group.sort_by("slice")
    inner = Slices([_unflat(c, r) for c, r in zip(group["costs"].to_pylist(), group["ranks"].to_pylist(), strict=True)])
    row = (group["absent"][0].as_py(), group["cid"][0].as_py(), group["above"][0].as_py(), *_flat([inner.forward(0, len(group), s) for s in range(4)]))
    return pa.Table.from_batches([_batch([row], _TABLE)])


def _decide(group: pa.Table, above: pa.Table) -> pa.Table:
    """The states before and after each of neighbouring tables, from those around all of them."""
    group = group.sort_by("slice")
    inner = Slices([_unflat(c, r) for c, r in zip(group["costs"].to_pylist(), group["ranks"].to_pylist(), strict=True)])
    walk = meet(inner, 0, len(group), above["state"][0].as_py(), above["last"][0].as_py())
    keys = zip(group["absent"].to_pylist(), group["cid"].to_pylist(), group["slice"].to_pylist(), strict=True)
    return pa.Table.from_batches([_batch([(*k, *w) for k, w in zip(keys, walk, strict=True)], _STATES)])


def _top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("absent", "cid", "slice", "costs", "ranks")), strict=True)
        yield _batch([(a, c, n, 0, last_state(tuple(zip(costs[:4], ranks[:4], strict=True)))) for a, c, n, costs, ranks in rows], _STATES)


def _states(long: DataFrame, size: int, fan: int) -> DataFrame:
    """Up a tree of tables to one for each conversation, and down again: states before and after each slice."""
    above = F.call_function("div", F.col("slice"), F.lit(fan).cast("long")).alias("above")
    levels = [durable_table(long.mapInArrow(partial(_table_rows, size=size), _TABLE), "tables")]
    while levels[-1].agg(F.max("slice")).first()[0]:
        levels.append(durable_table(levels[-1].select("*", above).groupBy(*CONV, "above").applyInArrow(_fold, _TABLE), "tables"))
    states = levels[-1].mapInArrow(_top, _STATES)
    for level in reversed(levels[:-1]):
        known = states.withColumnRenamed("slice", "above").groupBy(*CONV, "above")
        states = level.select("*", above).groupBy(*CONV, "above").cogroup(known).applyInArrow(_decide, _STATES)
    return durable_table(states, "states")


def _illegal(codes: bytes) -> int:
    kinds = [c // 3 for c in codes]
    return sum((a, b) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)) for a, b in zip(kinds, kinds[1:], strict=False))


def _solve(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for absent, cid, number, codes, state, last, final in zip(*(batch.column(c).to_pylist() for c in ("absent", "cid", "slice", "codes", "state", "last", "final")), strict=True):
            own = bytes(codes)
            out.append((absent, cid, number, *edits_of(own[:size], state, None if final else last), _illegal(own)))
        yield _batch(out, _SOLVED)


def solve(told: DataFrame, size: int = SLICE, fan: int = FAN) -> DataFrame:
    """`faults` in; `absent, cid, slice, letters, states` (after each letter), `cost, illegal` out."""
    slices = durable_table(_slices(told, size), "slices")
    ends = slices.groupBy(*CONV).agg(F.max("slice").alias("most")).filter("most > 0")
    long = durable_table(slices.join(ends, CONV), "long-conversations")
    whole = slices.join(ends.select(*CONV), CONV, "left_anti").select("*", F.lit(0).alias("state"), F.lit(0).alias("last"), F.lit(True).alias("final"))
    if not long.isEmpty():
        parts = long.join(_states(long.drop("most"), size, fan), [*CONV, "slice"]).withColumn("final", F.col("slice") == F.col("most"))
        whole = whole.unionByName(parts.select(*whole.columns))
    return durable_table(whole.mapInArrow(partial(_solve, size=size), _SOLVED), "solved")


_EDITS = "absent boolean, cid long, pos long, part int, edit string, new_role string"


def _edit_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            out = []
            for absent, cid, number, letters, states in zip(*(batch.slice(start, 256).column(c).to_pylist() for c in ("absent", "cid", "slice", "letters", "states")), strict=True):
                pos, part = number * size, 0
                for x, state in zip(letters, states, strict=True):
                    out.append((absent, cid, pos, part, x, ROLE[int(state)] if x in "IR" else None))
                    pos, part = (pos, part + 1) if x == "I" else (pos + 1, 0)
            yield _batch(out, _EDITS)


@dataclass
class Repair:
    """`numbered` rows, their `faults`, and what `solve` says about them, written down."""

    rows: DataFrame
    told: DataFrame
    solved: DataFrame
    size: int

    def audits(self) -> DataFrame:
        """`absent, cid, audit, cost, illegal` of each conversation that has rows."""
        by = self.solved.groupBy(*CONV).agg(F.array_sort(F.collect_list(F.struct("slice", "letters"))).alias("all"), F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
        return by.select(*CONV, F.array_join(F.transform("all", lambda x: x["letters"]), "").alias("audit"), "cost", "illegal")

    def edits(self) -> DataFrame:
        """`absent, cid, pos, part, edit, new_role`: one row for each letter; an inserted turn stands before row `pos`."""
        return self.solved.mapInArrow(partial(_edit_rows, size=self.size), _EDITS)

    def turns(self) -> DataFrame:
        """The repaired conversations: `absent, cid, pos, part, edit, role, text`, an inserted text is empty."""
        stays = self.edits().filter("edit <> 'D'")
        out = stays.join(self.rows.select(*CONV, "pos", "role", "text"), [*CONV, "pos"], "left")
        text = F.when(F.col("edit") == "I", "").otherwise(F.col("text"))
        return out.select(*CONV, "pos", "part", "edit", F.coalesce("new_role", "role").alias("role"), text.alias("text"))


def repair(plain: DataFrame, order: list[str], size: int = SLICE, fan: int = FAN) -> Repair:
    """Repair the conversations of `plain` (see `turns.plain_turns`), whose rows come in this order.

    A null conversation id is a conversation of its own; null roles and texts are what `plain_turns` made of them; rows
    that are equal in all of `order` may change places, which shows in nothing if they are equal altogether. A text may
    be empty or very long: only its digest and its last character take part. No rows give no rows.
    """
    rows = numbered(plain, order)
    told = durable_table(faults(rows), "faults")
    return Repair(rows, told, solve(told, size, fan), size)


def line_hashes(turns: DataFrame) -> DataFrame:
    """`absent, cid, digest`: SHA-256 of the `role:text` lines of each conversation."""
    return joined_digests(turns, CONV, ["pos", "part"], F.concat("role", F.lit(":"), "text"), "\n")


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Faults to be repaired, set by a checksum of conversation and turn: a row of twenty is dropped, another one's text
    emptied, or bare of sentence ends, or the row stands twice, or the user says it. `seq` orders rows of one turn, by
    role and digest of the text before the damage."""
    plain = plain_turns(turns, conv_col, turn_col, role_col, text_col, " ")
    name = F.concat(F.when(F.col("absent"), " ").otherwise(F.col("cid").cast("string")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    hit = plain.withColumn("hit", F.crc32(F.encode(name, "UTF-8")) % 20).filter("hit <> 0")
    hit = hit.withColumn("seq", F.struct("role", text_digest("text").alias("said"))).withColumn("copy", F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", END, "")).otherwise(F.col("text"))
    return hit.select(*CONV, "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "seq", "copy")


def reports(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", size: int = SLICE, fan: int = FAN) -> DataFrame:
    """Damage `turns`, repair them, and say for every conversation what was found and done (see the query's contract).

    One row for each conversation id, null among them; one without rows after the damage has zeros. Rows of one turn
    come by role and the digest of their text; a null turn is the first.
    """
    done = repair(damaged(turns, conv_col, turn_col, role_col, text_col), ["turn", "seq", "copy"], size, fan)
    distinct = done.told.groupBy(*CONV, "turn").agg(*[F.count_if(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")])
    counts = distinct.groupBy(*CONV).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"), *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")])
    all_ids = turns.select(F.col(conv_col).isNull().alias("absent"), F.coalesce(F.col(conv_col).cast("long"), F.lit(0)).alias("cid")).distinct()
    out = all_ids.join(counts, CONV, "left").join(done.audits(), CONV, "left").join(line_hashes(done.turns()), CONV, "left")
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        F.when(~F.col("absent"), F.col("cid")).alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in longs],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {"op13_structure_repair": op13_structure_repair}


def crc32_sql(text: str) -> str:
    """CRC-32 of ASCII text in SQL: each character enters, followed by eight shifts (256 stands for one)."""
    return f"""xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split({text}, ''), lambda c:
        [ascii(c)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256])),
        lambda a, x: CASE WHEN x < 256 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""


#: Ties of a turn come by role and the digest of the text with its length, as in `damaged`.
ORACLES = {
    "op13_structure_repair": rf"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS hit
  FROM conversations),
dealt AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         role AS role0, sha256(CAST(length(text) AS VARCHAR) || ':' || text) AS said, unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM plain WHERE hit <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role0, said, copy) - 1 AS pos FROM dealt),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) = 1 AS first,
         regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last,
         CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'x' END AS initial FROM numbered),
r AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN NOT first THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM firsts),
ins(s, t, k) AS (VALUES (0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (0, 2, 1), (1, 2, 1), (2, 3, 1), (3, 2, 1), (0, 3, 2), (1, 3, 2)),
kept(initial, s, t) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
faulty(fault, more, stays) AS (VALUES ('blank', 0, false), ('duplicate', 0, false), ('truncated', 3, true), ('fine', 0, true)),
one AS (
  SELECT initial, fault, s, t, 'D' AS letter, 4 AS cost FROM (SELECT DISTINCT s, s AS t FROM ins), (VALUES ('s'), ('u'), ('a'), ('x')) i(initial), faulty
  UNION ALL SELECT initial, fault, s, t, 'R', 3 + more FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) n(s, t), (VALUES ('s'), ('u'), ('a'), ('x')) i(initial), faulty WHERE stays
  UNION ALL SELECT initial, fault, s, t, 'K', more FROM kept, faulty WHERE stays),
moves AS (
  SELECT initial, fault, ins.s, one.t, cost + 3 * k AS cost, repeat('I', k) || letter AS letters FROM ins JOIN one ON one.s = ins.t),
ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS s, CAST('000000000' AS VARCHAR) AS way FROM ids
  UNION ALL
  SELECT w.conv_id, w.pos + 1, m.t, min(lpad(CAST(CAST(w.way[1:9] AS INT) + m.cost AS VARCHAR), 9, '0') || w.way[10:] || m.letters)
  FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos JOIN moves m ON m.initial = r.initial AND m.fault = r.fault AND m.s = w.s
  GROUP BY w.conv_id, w.pos + 1, m.t),
ends AS (SELECT conv_id, max(pos) AS n FROM walk GROUP BY conv_id),
best AS (
  SELECT w.conv_id, min(lpad(CAST(CAST(way[1:9] AS INT) + 3 * k AS VARCHAR), 9, '0') || way[10:] || repeat('I', k)) AS way
  FROM walk w JOIN ends ON ends.conv_id IS NOT DISTINCT FROM w.conv_id AND ends.n = w.pos
  JOIN (VALUES (0, 0), (1, 2), (2, 1), (3, 0)) e(s, k) ON e.s = w.s GROUP BY w.conv_id),
letters AS (
  SELECT conv_id, unnest(string_split(way[10:], '')) AS letter, generate_subscripts(string_split(way[10:], ''), 1) AS i FROM best WHERE length(way) > 9),
placed AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY i) - 1 AS pos FROM letters),
put AS (
  SELECT p.conv_id, i, letter, role, text, row_number() OVER (PARTITION BY p.conv_id ORDER BY i) - 1 AS place,
         coalesce(first_value(letter = 'K' AND initial = 's') OVER (PARTITION BY p.conv_id ORDER BY i), false) AS has_system
  FROM placed p LEFT JOIN r ON letter <> 'I' AND r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.pos WHERE letter <> 'D'),
lines AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - has_system::INT) % 2 = 0 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY i)) AS digest FROM put GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM r GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(way[1:9] AS BIGINT) AS cost, way[10:] AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM ids LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM ids.conv_id"""
}
