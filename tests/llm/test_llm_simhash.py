"""SimHash fingerprints and the trie join, against brute force."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
import xxhash
from conftest import SF

from tidelog.llm import simhash
from tidelog.llm.components import components
from tidelog.session import durable_table


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = brute.WORD.findall(low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reached(marks, budget=2):
    """The least mark that each can reach."""
    marks = sorted(set(marks))
    up = {m: m for m in marks}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(marks):
        for b in marks[i + 1 :]:
            if (a ^ b).bit_count() <= budget:
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {m: find(m) for m in marks}


def want(pairs):
    marks = [slow_fingerprint(t) for _, t in pairs]
    up = reached(marks)
    least = {}
    for (i, _), m in zip(pairs, marks, strict=True):
        if i is not None:
            least[up[m]] = min(i, least.get(up[m], i))
    return Counter((i, f"{m:016x}", least.get(up[m])) for (i, _), m in zip(pairs, marks, strict=True))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("piece", [1 << 20, 50])
def test_fingerprint(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    for t in ["", " \t\n", "One", "one  TWO", "a b c", "a b c d a b c d", "É é A\x0bz\x1cy \x85 w", "x" * 300, "lo ng " * 4000]:
        assert simhash.fingerprint(t.encode()) == slow_fingerprint(t), t


def test_groups(spark):
    rows = brute.odd_rows()
    docs = durable_table(spark.createDataFrame(rows, brute.SCHEMA).repartition(5), "odd-rows")
    assert bag(simhash.groups(docs)) == want([(r.doc_id, r.text) for r in rows])


def test_groups_small(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    result = want([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert any(i != c for i, _, c in result)
    assert bag(simhash.groups(docs)) == result


def test_groups_of_nothing(spark):
    assert simhash.groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def crowd(seed, center, n, flips, keep=64):
    """Marks around a center, of which the first bits stay."""
    rnd = random.Random(seed)
    out = set()
    for _ in range(n):
        m = center
        for _ in range(rnd.randint(0, flips)):
            m ^= 1 << rnd.randrange(keep)
        out.add(m)
    return out


@pytest.mark.parametrize("leaves", [1 << 15, 64, 8])
def test_links(spark, leaves):
    """Spread marks, chains of two bits, and crowds below one long prefix, which must be split to their last bits."""
    rnd = random.Random(leaves)
    marks = {rnd.getrandbits(64) for _ in range(400)} | crowd(1, 0xFFFF_0000_FFFF_0000, 150, 9) | crowd(2, 5, 300, 6, 12) | {0, (1 << 64) - 1}
    at = rnd.getrandbits(64)
    for i in range(0, 40, 2):
        at ^= 3 << i
        marks.add(at)
    df = spark.createDataFrame([(int(np.uint64(m).astype(np.int64)),) for m in marks], "mark long").repartition(3)
    got = components(simhash.links(df, leaves=leaves))
    told = {int(np.int64(r.doc_id).astype(np.uint64)): int(np.int64(r.component).astype(np.uint64)) for r in got.collect()}
    groups = {}
    for m in marks:
        groups.setdefault(told.get(m, m), set()).add(m)
    expected = {}
    for m, up in reached(marks).items():
        expected.setdefault(up, set()).add(m)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("pairs", [1 << 15, 3])
def test_walk(monkeypatch, pairs):
    """Every pair within the budget comes once."""
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    marks = np.array(sorted(crowd(3, 77, 200, 5)), np.uint64)
    got = [(int(x), int(y)) for a, b in simhash.walk(marks, marks, 0, [(0, len(marks), 0, len(marks), 0)], 2, True) for x, y in zip(a, b, strict=True)]
    expected = [(i, j) for i in range(len(marks)) for j in range(i + 1, len(marks)) if int(marks[i] ^ marks[j]).bit_count() <= 2]
    assert sorted(got) == expected
