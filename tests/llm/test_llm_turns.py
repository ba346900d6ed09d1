"""The operators on conversations, on rows with every oddity, on no rows, and on the small tables, against brute force."""

from collections import Counter

import brute_turns as brute
import pytest
from conftest import SF

from tidelog.llm import prefix_trie, repair
from tidelog.session import durable_table

DDL = "conv_id long, turn long, role string, text string"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    return brute.odd_turns()


@pytest.fixture(scope="module")
def turns(spark, rows):
    """With other columns, some of which are called as the operators call their own."""
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], f"{DDL}, absent long, cid long, pos long, code long, slice long, depth long")
    return durable_table(df.repartition(5), "odd-turns")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/conversations.parquet")


@pytest.fixture(scope="module")
def small_rows(small):
    return [tuple(r) for r in small.select("conv_id", "turn", "role", "text").collect()]


# 13: repair


@pytest.mark.parametrize(("size", "fan"), [(4096, 1024), (3, 2), (1, 3)])
def test_repair(turns, rows, size, fan):
    """Slices of a few rows take long conversations through several levels of tables."""
    got = bag(repair.reports(turns, size=size, fan=fan))
    want = Counter(brute.repaired(rows))
    assert got == want


def test_repair_small(small, small_rows):
    want = Counter(brute.repaired(small_rows))
    assert any(r[6] for r in want)
    assert bag(repair.reports(small)) == want


def test_repaired_turns_are_well_formed(turns, rows):
    done = repair.repair(repair.damaged(turns), ["turn", "seq", "copy"], size=5, fan=2)
    said = {}
    for r in done.turns().orderBy("absent", "cid", "pos", "part").collect():
        said.setdefault((r.absent, r.cid), []).append(r.role[:1])
        assert r.edit != "I" or r.text == ""
    assert said
    for firsts in said.values():
        rest = firsts[1:] if firsts[0] == "s" else firsts
        assert rest and rest == ["u", "a"] * (len(rest) // 2)


def test_repair_of_nothing(spark):
    assert repair.reports(spark.createDataFrame([], DDL)).collect() == []


def test_all_short_walks():
    """Every sequence of up to three kinds of rows."""
    roles = {repair.SYSTEM: "s", repair.USER: "u", repair.ASSISTANT: "a", repair.OTHER: "x"}
    told = {repair.FINE: None, repair.CUT_SHORT: "truncated", repair.MUST_GO: "blank"}
    level = [()]
    for _ in range(4):
        for codes in level:
            rows = [(0, roles[c // 3], "t") for c in codes]
            want = brute.cheapest(rows, [told[c % 3] for c in codes])
            letters, states, cost = repair.edits_of(bytes(codes), 0, None)
            assert (cost, letters) == want[:2]
            assert len(states) == len(letters)
        level = [(*c, k) for c in level for k in range(12)] if len(level) < 200 else []


# 11: prefix trie


@pytest.mark.parametrize(("narrow", "wide"), [(8, 1024), (1, 4), (2, 32)])
def test_trie(turns, rows, narrow, wide):
    got = bag(prefix_trie.trie(*prefix_trie.rebuilt(turns), narrow, wide))
    assert got == Counter(brute.trie(rows))


def test_trie_small(small, small_rows):
    want = Counter(brute.trie(small_rows))
    assert any(r[3] > 1 and r[1] > 1 for r in want)
    assert bag(prefix_trie.trie(*prefix_trie.rebuilt(small))) == want


def test_trie_of_long_copies(spark, monkeypatch):
    """Equal, nested and parting conversations deeper than a band, and many that end in one node."""
    monkeypatch.setattr(prefix_trie, "IDS", 4)
    said = {1: 70, 2: 70, 3: 41, 4: 70, 5: 0, **dict.fromkeys(range(6, 30), 3), 31: 33, -4: 3}
    rows = [(c, d, f"{'x' if c == 4 and d > 40 else ''}{d}") for c, n in said.items() for d in range(1, n + 1)]
    df = spark.createDataFrame([(c, d, s, len(s)) for c, d, s in rows], "cid long, depth long, said string, bytes long").repartition(4)
    convs = spark.createDataFrame([(c,) for c in said], "cid long")
    got = {(r.depth, r.conv_id): r for r in prefix_trie.trie(convs, df, 2, 16).collect()}
    assert len(got) == 1 + 70 + 30
    assert got[3, -4].ends_sha256 == brute.sha(",".join(map(str, [-4, *range(6, 30)])))
    assert (got[0, -4].n_convs, got[0, -4].n_leaves, got[0, -4].n_children) == (len(said), 2, 1)
    assert (got[40, 1].n_convs, got[40, 1].n_children, got[41, 4].parent_conv_id, got[41, 1].n_convs) == (4, 2, 1, 3)
    assert got[70, 1].saved_tokens == 2


def test_trie_of_nothing(spark):
    nothing = spark.createDataFrame([], DDL)
    assert prefix_trie.trie(*prefix_trie.rebuilt(nothing)).collect() == []
    one = prefix_trie.trie(*prefix_trie.rebuilt(spark.createDataFrame([(None, 1, "user", "x"), (3, None, None, None)], DDL))).collect()
    assert [(r.conv_id, r.n_convs) for r in one][:1] == [(3, 1)]
