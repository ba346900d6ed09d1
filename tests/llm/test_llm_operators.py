"""The operators on rows with every oddity, on no rows, and on the small tables, against brute force."""

import base64
import random
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelog.llm import (
    arrow_files, common, features, jaccard_join, line_dedup, merge_replay, names, packing, pu_classifier, rounds, rule_votes,
    stream_dedup, suffix_dedup, superkmer, tokens,
)
from tidelog.llm.components import components
from tidelog.session import durable_table

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows():
    return brute.odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return durable_table(spark.createDataFrame(rows, brute.SCHEMA).repartition(5), "odd-rows")


@pytest.fixture(scope="module")
def pairs(rows):
    return [(r.doc_id, r.text) for r in rows]


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def small_pairs(small):
    return [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def same_rest(before, after, columns):
    assert after.columns == before.columns
    assert bag(before.select(*columns)) == bag(after.select(*columns))


# 1: repeated byte strings


def digests_1(pairs):
    return Counter((i, len(b), sum(y - x for x, y in cut), len(cut), brute.sha(brute.without(b, cut))) for i, b, cut in brute.repeated_bytes(pairs))


def test_suffix_dedup(docs, pairs):
    assert bag(suffix_dedup.digests(docs)) == digests_1(pairs)


def test_suffix_dedup_small(small, small_pairs):
    want = digests_1(small_pairs)
    assert any(k[2] for k in want)
    assert bag(suffix_dedup.digests(small)) == want


def test_suffix_dedup_spans_and_other_length(docs, pairs):
    got = Counter((r.doc_id, tuple(r.starts), tuple(r.ends)) for r in suffix_dedup.repeated_spans(docs, length=64).collect())
    assert got == Counter((i, tuple(x for x, _ in cut), tuple(y for _, y in cut)) for i, _, cut in brute.repeated_bytes(pairs, 64))
    with pytest.raises(ValueError):
        suffix_dedup.repeated_spans(docs, length=20)


def test_suffix_dedup_texts(docs, pairs):
    out = suffix_dedup.remove_repeats(docs)
    same_rest(docs, out, ["doc_id", "lang", "rest", "block"])
    assert bag(out.select("doc_id", "text")) == Counter((i, brute.without(b, brute.whole_characters(b, cut)).decode()) for i, b, cut in brute.repeated_bytes(pairs))


def test_suffix_dedup_pieces_of_long_texts(docs, pairs, monkeypatch):
    """A text is handled in pieces; where they end must not matter."""
    monkeypatch.setattr(names, "PIECE", 1000)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    table = pa.table({"doc_id": pa.array([i for i, _ in pairs], pa.int64()), "text": [t or "" for _, t in pairs], "block": pa.array([0] * len(pairs), pa.int32())})
    block = rounds.Block(0, table)
    p = {"length": 50, "buckets": 3}
    settled = lambda letters, f: [
        (b, x) for b in {r["bucket"] for r in letters if r["bucket"] >= 0} for mine in [[(r["block"], r["payload"]) for r in letters if r["bucket"] == b]] for x in f(mine)
    ]
    shared = lambda x: rounds.shared(x, suffix_dedup.KEY)
    letters = rounds.letters(suffix_dedup.first_question(block, **p)).to_pylist()
    note = None
    for ask, answer in ((suffix_dedup.second_question, shared), (suffix_dedup.third_question, rounds.has_least), (suffix_dedup.fourth_question, shared), (suffix_dedup.give_digests, rounds.has_least)):
        out = ask(block, dict(settled(letters, answer)), note, **p).to_pylist()
        note = next((r["payload"] for r in out if r.get("bucket", 0) < 0), None)
        letters = out
    assert Counter(tuple(r.values()) for r in out) == digests_1(pairs)


# 2: similar sets


def test_jaccard_groups(docs, pairs):
    for n, percent in ((3, 90), (5, 80), (2, 60)):
        got = bag(jaccard_join.groups(docs, rule=jaccard_join.Similar(n, percent)))
        assert got == Counter(brute.jaccard_groups(pairs, n, percent))


def test_jaccard_groups_small_and_chains(spark, small_pairs):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    chain = []
    for i in range(60):  # each is close to the next, ends are not close to each other
        words = words[2:] + [f"v{i}", f"u{i}"]
        chain.append((20_000 + rnd.randrange(10**6), " ".join(words)))
    pairs = small_pairs + chain
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    got = bag(jaccard_join.groups(df, rule=jaccard_join.Similar(3, 90, 3)))
    want = Counter(brute.jaccard_groups(pairs, 3, 90))
    assert got == want
    assert len({c for _, _, c in want}) < len(pairs) - 50


def test_jaccard_orders_decide(spark, monkeypatch):
    """A text is opened only if the prefixes of the pair meet under every order, and no link is lost by that."""
    rnd = random.Random(4)
    pairs = []
    for i in range(120):
        base = [f"a{rnd.randrange(60)}" for _ in range(40)]
        for j in range(3):
            pairs.append((10 * i + j, " ".join(w if rnd.random() > 0.02 * j else f"b{rnd.randrange(60)}" for w in base)))
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    rule = jaccard_join.Similar(2, 70, 3)
    seen = []
    links = jaccard_join.linked
    monkeypatch.setattr(jaccard_join, "linked", lambda p, some, r: links(seen.append((p, some)) or p, some, r))
    got = bag(jaccard_join.groups(df, rule=rule))
    want = brute.jaccard_groups(pairs, 2, 70)
    assert got == Counter(want) and len({c for _, _, c in want}) < 300
    tokens = {r.doc_id: bytes(r.tokens) for r in seen[0][1].collect()}
    asked = [[(r.a, r.b) for r in p.collect()] for p, _ in seen]
    share = lambda a, b: [bool(np.isin(x, y).any()) for x, y in zip(*(jaccard_join.tokens_by_order(tokens[d], 3)[0] for d in (a, b)), strict=True)]
    by_order = np.array([share(a, b) for a, b in asked[0]])
    agreed = np.array([jaccard_join.orders_agree(tokens[a], tokens[b], 3) for a, b in asked[0]])
    assert (agreed == by_order.all(1)).all() and by_order.any(1).all()
    assert agreed.sum() < by_order.any(1).sum()  # one order would let more through
    assert all(all(share(a, b)) for a, b in asked[1])


def test_jaccard_groups_in_pieces(spark, monkeypatch):
    """Texts of two edits are linked by those of one only, which the first look cannot know. Further looks join the pieces,
    so the last step is left with few pairs and not those of all texts."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(80):
        words = list(base)
        for at in rng.choice(200, 2 if i < 40 else 1, replace=False):
            words[at] = f"x{i}y{at}"
        texts.append((i, " ".join(words)))
    made, links = [], jaccard_join.linked
    monkeypatch.setattr(jaccard_join, "linked", lambda p, some, r: made.append(p.count()) or links(p, some, r))
    got = bag(jaccard_join.groups(spark.createDataFrame(texts, "doc_id long, text string"), rule=jaccard_join.Similar(3, 90)))
    assert got == Counter(brute.jaccard_groups(texts, 3, 90))
    assert all(n <= len(texts) for n in made)


def test_jaccard_runs_of_texts():
    assert list(jaccard_join._runs([], 9)) == []
    assert list(jaccard_join._runs([20, 4, 5, 1, 30, 2], 9)) == [(0, 1), (1, 3), (3, 4), (4, 5), (5, 6)]


def test_jaccard_keep_one(docs, pairs):
    out = jaccard_join.keep_one(docs)
    assert out.columns == docs.columns
    want = Counter((i, t) for (i, t), (_, _, c) in zip(pairs, brute.jaccard_groups(pairs, 5, 80), strict=True) if i == c)
    assert bag(out.select("doc_id", "text")) == want


def test_components(spark):
    rnd = random.Random(5)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(200)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert bag(components(spark.createDataFrame(links, "a long, b long"))) == Counter((x, find(x)) for x in list(parent))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("far", [0, 1 << 62])
def test_jaccard_components_never_look_alike(far):
    """Two components whose ids agree in 32 bits of their mix share a token; so do two rows of one component."""
    ids = np.arange(1 << 18, dtype=np.int64) + far
    low = names.mix(ids.view(np.uint64)).astype(np.uint32)
    order = np.argsort(low, kind="stable")
    clash = np.flatnonzero(low[order][1:] == low[order][:-1])
    assert len(clash)
    a, b = ids[order[clash[0]]], ids[order[clash[0] + 1]]
    tokens = lambda *t: np.array([len(t), len(t), *[0] * jaccard_join.SIGNATURE, *t], np.uint64).tobytes()
    block = lambda number, component, *t: pa.table(
        {"block": pa.array([number], pa.int32()), "doc_id": [component], "size": [9], "component": pa.array([component], pa.int64()), "tokens": [tokens(*t)]}
    )
    blocks = [block(0, a, 5, 6), block(1, b, 5), block(2, a, 6, 7)]
    asked = [jaccard_join._ask_mixed(t, 1, 1).to_pylist()[0]["payload"] for t in blocks]
    got = jaccard_join.mixed(list(enumerate(asked)))
    shared = {}
    for t, bits in zip(blocks, got, strict=True):
        m = jaccard_join.Members(t, 1)
        shared[t["block"][0].as_py()] = dict(zip(m.token.tolist(), m.question(1).bits({0: bits})[m.question(1).of].tolist(), strict=True))
    assert shared == {0: {5: True, 6: False}, 1: {5: True}, 2: {6: False, 7: False}}


# 3: rules


def test_counts(docs, pairs):
    judged, _ = rule_votes.judge(docs)
    got = bag(judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    assert got == Counter((i, *brute.base_counts(t)) for i, t in pairs)


def test_more_counts():
    got = features.measure([b"One  ONE two two\nTwo's end.\n\nno\n\nno", b"", b"\n", b"a! #b, c# 12\n"])
    assert got["n_lines"].tolist() == [4, 0, 0, 1]
    assert got["n_dup_lines"].tolist() == [1, 0, 0, 0]
    assert got["n_caps_words"].tolist() == [1, 0, 0, 0]
    assert got["n_same_words"].tolist() == [2, 0, 0, 0]
    assert got["n_distinct_words"].tolist() == [6, 0, 0, 4]
    assert got["n_symbol_ends"].tolist() == [0, 0, 0, 1]
    assert got["n_ended_lines"].tolist() == [1, 0, 0, 0]
    assert got["n_digits"].tolist() == [0, 0, 0, 2]


def test_rules_learn_accuracies():
    """Votes drawn from known accuracies: the estimates come near, and the posterior beats any single rule."""
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.7
    right, says = np.array([0.95, 0.8, 0.7, 0.9, 0.6]), np.array([0.9, 0.5, 0.8, 0.3, 0.9])
    votes = np.where(rng.random((20_000, 5)) < right, 1, -1) * np.where(good, 1, -1)[:, None] * (rng.random((20_000, 5)) < says)
    kinds, n = np.unique(votes, axis=0, return_counts=True)
    model = rule_votes.fit(kinds, n.astype(float))
    assert abs(model.prior - 0.7) < 0.03
    assert np.abs(model.given[1, :, 2] - right * says).max() < 0.05
    assert np.abs(model.given[0, :, 0] - right * says).max() < 0.05
    assert ((model.good(votes) >= 0.5) == good).mean() > 0.93


def test_rules_keep_the_good(spark):
    out = rule_votes.op3_rule_votes(spark, MID).join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").filter("not base_failed")
    r = out.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double")), F.count("*")).first()
    assert r[0] > 0.98 and r[1] > 200


# 4, 8, 10: tokens


def library(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def ranks():
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}


def awkward_texts():
    rnd = random.Random(1)
    bits = ["a", "b", "the ", "  ", " ", "\n", "\t", "é", "ß", "'s", "'", "123", "　", " ", "\x85", "\x1c", "中文", "!!", "😀", "<|endoftext|>", "é", "Σ", "ΑΣ ", " \n ", "aaaa", "İ", "ªº", "Éa.", "don't.", "x,y", "b.\nB", "q\n", "ŉ.", "\r\n"]
    return ["", "a", " ", "aaaaaaaaaaaaaaaaa", "x" * 5000, "ab" * 3000] + ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 25))) for _ in range(1500)]


def ids(b):
    return np.frombuffer(b, "<u4").tolist()


def test_ids_are_the_libraries_ids(ranks):
    texts = awkward_texts()
    words, pieces = library("word_bpe_49k.json"), library("byte_bpe_50k.json")
    assert [ids(x) for x in tokens.ids_by_word(P.path("word_bpe_49k.json"), pa.array(texts))] == [words.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids(x) for x in tokens.library_ids_by_piece(P.path("byte_bpe_50k.json"), pa.array(texts))] == [pieces.encode(t, add_special_tokens=False).ids for t in texts]


def test_merge_replay_is_greedy(ranks):
    """Also for words whose merges come out of order, in a vocabulary made for that."""
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    v = merge_replay.vocabulary(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    texts = awkward_texts()
    got = [b"".join(merge_replay.encode_pieces(v, merge_replay.pieces_of(t))) for t in texts]
    assert [ids(x) for x in got] == [own.encode_ordinary(t) for t in texts]
    assert [merge_replay.decode_ids(v, ids(x)) for x in got] == [t.encode() for t in texts]


def test_merge_replay_out_of_order(tmp_path):
    rnd = random.Random(4)
    made = [bytes([b]) for b in range(256)]
    for _ in range(60):
        t = rnd.choice([b"a", b"b", b"c"] + made[256:]) + rnd.choice([b"a", b"b", b"c"] + made[256:])
        if t not in made and len(t) < 9:
            made.append(t)
    order = made[:256] + rnd.sample(made[256:], len(made) - 256)  # ranks no training would give
    own = {t: r for r, t in enumerate(order)}
    path = tmp_path / "own.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {r}\n" for t, r in own.items()))
    v = merge_replay.Vocabulary(str(path), P.PATTERN)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14))).encode() for _ in range(3000)]
    assert [x.tolist() for x in merge_replay.replay(v, words)] == [v.one_by_one(w) for w in words]


def test_byte_bpe(docs, pairs, ranks):
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    where = {"path": P.path("byte_bpe_multi_50k.tiktoken"), "pattern": P.PATTERN}
    encoded = merge_replay.encode(docs, **where)
    assert Counter((r.doc_id, tuple(ids(r.ids))) for r in encoded.collect()) == Counter((i, tuple(own.encode_ordinary(t or ""))) for i, t in pairs)
    assert Counter((r.doc_id, bytes(r.decoded)) for r in merge_replay.decode(encoded, **where).collect()) == Counter((i, (t or "").encode()) for i, t in pairs)


def test_byte_bpe_query(spark, small_pairs, ranks):
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((i, len(x), brute.sha(",".join(map(str, x))), brute.sha(t)) for i, t in small_pairs for x in [own.encode_ordinary(t)])
    assert bag(merge_replay.op8_byte_bpe(spark, SF)) == want


def check_pieces(found, pairs):
    """Every piece of every document by the binary digits of its length, and nothing else."""
    t, want = library("word_bpe_49k.json"), Counter()
    for i, x in pairs:
        own = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
        at, n = 0, len(own)
        while at < n:
            k = next(k for k in (1 << b for b in range(11, -1, -1)) if k <= n - at)
            want[(i, at, k, n, own[at : at + k].tobytes())] += 1
            at += k
    assert len({r.sequence_id for r in found}) == len(found)  # one piece each
    assert all(r.offset == 0 for r in found)
    assert Counter((r.doc_id, r.start, r.length, r.doc_tokens, bytes(r.ids)) for r in found) == want


def test_packing(docs, pairs, tmp_path):
    at = str(tmp_path / "buckets")
    packed = packing.pieces(docs, P.path("word_bpe_49k.json"), buckets=at)
    check_pieces(packed.collect(), pairs)
    rows = bag(packed.select("doc_id", "start", "length"))
    for bucket in (tmp_path / "buckets").glob("length=*"):  # every bucket holds the pieces of its length, all of them
        n = int(bucket.name.removeprefix("length="))
        back = docs.sparkSession.read.parquet(str(bucket)).select("doc_id", "start", F.octet_length("ids"))
        assert bag(back) == Counter((i, a, 4 * k) for i, a, k in rows.elements() if k == n)
    one = packing.read_buckets(docs.sparkSession, at, 64)
    assert bag(one.select("doc_id", "start")) == Counter((i, a) for i, a, k in rows.elements() if k == 64)
    assert "PartitionFilters: [isnotnull(length" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        packing.pieces(docs, P.path("word_bpe_49k.json"), longest=1000)


def test_packing_query(spark, small_pairs):
    t = library("word_bpe_49k.json")
    own = {i: np.array(t.encode(x, add_special_tokens=False).ids + [1], "<u4") for i, x in small_pairs}
    found = packing.op4_packing(spark, SF).collect()
    assert sum(r.length for r in found) == sum(map(len, own.values()))
    assert all(r.ids_crc32 == zlib.crc32(own[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(own[r.doc_id]) for r in found)


def check_files(found, pairs):
    t, start, want = library("byte_bpe_50k.json"), 0, []
    # rows of one id come by a hash of their text
    text_hash = lambda x: int(np.uint64(xxhash.xxh64_intdigest((x or "").encode(), 42)).astype(np.int64))
    for i, x in sorted(pairs, key=lambda r: (r[0] is not None, r[0] or 0, text_hash(r[1]))):
        own = np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(own), own.tobytes()))
        start += len(own)
    assert Counter(found) == Counter(want)


@pytest.mark.parametrize("shard", [1 << 24, 5000])
def test_arrow_files(spark, docs, pairs, tmp_path, shard, monkeypatch):
    monkeypatch.setattr(arrow_files, "SHARD", shard)
    folder = str(tmp_path / "files")
    manifest = arrow_files.write(docs, folder, P.path("byte_bpe_50k.json"), 2, length=64)
    rows = arrow_files.read(spark, folder).join(manifest, "shard").select("doc_id", (F.col("start") + F.col("at")).alias("start"), arrow_files_tokens(), "ids")
    check_files([(r[0], r[1], r[2], bytes(r[3])) for r in rows.collect()], pairs)
    file = next((tmp_path / "files").glob("*.arrows"))
    assert not list((tmp_path / "files").glob("*.tmp"))
    mapped = pa.memory_map(str(file))
    before = pa.total_allocated_bytes()
    first = pa.ipc.open_stream(mapped).read_next_batch()
    one = first.column("ids").values  # sequence i is one[i * 64 : (i + 1) * 64]
    assert pa.total_allocated_bytes() - before < 1000  # mapped, not copied
    assert first.schema.field("ids").type == pa.list_(pa.uint16(), 64) and len(one) == 64 * len(first)


def arrow_files_tokens():
    return (F.octet_length("ids") / 4).cast("long").alias("n_tokens")


def test_arrow_files_query(spark, small_pairs):
    t, start = library("byte_bpe_50k.json"), 0
    want = Counter()
    for i, x in sorted(small_pairs):
        own = np.array(t.encode(x, add_special_tokens=False).ids + [2], "<u4")
        want[(i, start, len(own), zlib.crc32(own.tobytes()))] += 1
        start += len(own)
    assert bag(arrow_files.op10_arrow_stream_files(spark, SF)) == want


def test_long_pieces_are_not_remembered():
    """What a worker holds is bounded in bytes, whatever the length of pieces."""
    memory = tokens.Memory(lambda p: p.encode() * 2, 1 << 20)
    for i in range(30_000):
        assert memory[f"{i:06d}"] == f"{i:06d}".encode() * 2
        assert memory["x" * 2000 + str(i)].endswith(str(i).encode())
        memory.trim()
        assert memory.held <= (1 << 20) + 400
    assert max(map(len, [*memory, *memory.old])) <= tokens.LONGEST
    learnt = merge_replay.Learnt(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    long = ["word" * 50 + str(i) for i in range(5)]
    learnt.learn({"short", *long})
    assert set(learnt) == {"short"} and set(learnt.long) == set(long)
    assert learnt[long[0]] == learnt.long[long[0]]


def test_names_of_regular_strings():
    """Thue-Morse words and their mirrors, which sums of bytes cannot tell apart."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
        mirror = word.translate(str.maketrans("ab", "ba"))
        data = np.frombuffer((word + mirror).encode(), np.uint8)
        begin = np.array([0, len(word)])
        for family in (0, 1):
            one, two = names.names_between(data, begin, begin + len(word), family)
            assert one != two
            one, two = names.names_between(names.mix(data.astype(np.uint64)), begin, begin + len(word), family)
            assert one != two
    counts = features.measure([f"{word}\n{mirror}".encode()])
    assert counts["n_dup_lines"].tolist() == [0] and counts["n_distinct_words"].tolist() == [2]


def test_keep_one_with_clashing_columns(spark):
    text = " ".join(map(str, range(30)))
    docs = spark.createDataFrame([(1, text, 0, 0), (2, text, 1, 1), (None, text, 2, 2)], "doc_id long, text string, gone long, _gone long")
    assert sorted(r._gone for r in jaccard_join.keep_one(docs).collect()) == [0, 2]


# 5: classifier


def test_classifier_on_held_out_labels(spark):
    out = pu_classifier.op5_pu_classifier(spark, MID)
    assert out.filter("score < 0 or score > 1 or predicted <> cast(score >= 0.5 as int)").count() == 0
    assert out.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 3 == 1)).count() == 0
    seen = out.join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").filter("held_out")
    right = seen.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("share"), F.count("*").alias("n"))
    assert all(r.share > 0.9 and r.n > 10 for r in right.collect())


def test_classifier_learns_nothing_from_held_out_labels(spark, docs):
    rows = durable_table(pu_classifier.with_features(docs), "pu")
    labels = [(r.doc_id, int(r.doc_id % 2)) for r in docs.select("doc_id").distinct().collect() if r.doc_id is not None]
    a = spark.createDataFrame([(i, q) for i, q in labels] + [(None, 1), (5, None)], "doc_id long, quality int")
    b = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in labels], "doc_id long, quality int")
    wa, wb = (pu_classifier.learn(rows, x) for x in (a, b))
    assert np.allclose(wa, wb)
    assert wa.any()
    kept = pu_classifier.accepted(docs, wa)
    assert kept.columns == docs.columns
    scores = pu_classifier.score(rows, wa)
    assert kept.count() == scores.filter("score >= 0.5").count()
    nothing = pu_classifier.learn(rows, a.limit(0))
    assert not nothing.any() and pu_classifier.accepted(docs, nothing).count() == docs.count()
    same_rest(docs, pu_classifier.accepted(docs, nothing), ["doc_id", "lang", "rest", "features", "block"])


def test_risk_is_lower_than_that_of_the_naive_classifier(spark):
    """Against treating unlabelled texts as negatives, which the unlabelled positives would spoil."""
    rng = np.random.default_rng(0)
    n, prior = 4000, 0.6
    truth = rng.random(n) < prior
    x = np.zeros((n, pu_classifier.WIDTH), np.float32)
    x[:, 0] = 1
    x[:, 1] = rng.normal(np.where(truth, 1.0, -1.0), 1.0)
    positive = truth & (rng.random(n) < 0.3)
    df = spark.createDataFrame([(r.tolist(), bool(p)) for r, p in zip(x, positive, strict=True)], "features array<float>, positive boolean")
    w = pu_classifier.fit(df, prior)
    assert ((x @ w > 0) == truth).mean() > 0.82
    assert abs((1 / (1 + np.exp(-(x @ w)))).mean() - prior) < 0.03


# 6: stream


def test_stream_dedup(spark, rows, pairs, tmp_path):
    path = str(tmp_path / "docs")
    first, second = rows[: len(rows) // 2], rows[len(rows) // 2 :]
    spark.createDataFrame(first, brute.SCHEMA).repartition(3).write.parquet(path)
    checkpoint = str(tmp_path / "state")
    stream_dedup.copies(spark, path, checkpoint, max_bytes=1).count()
    spark.createDataFrame(second, brute.SCHEMA).repartition(2).write.mode("append").parquet(path)
    found = stream_dedup.copies(spark, path, checkpoint).collect()  # goes on from the state of the first files
    groups = {}
    for i, t in pairs:
        groups.setdefault(t or "", []).append(i)
    largest = {t: max(g, key=lambda i: (i is not None, i or 0)) for t, g in groups.items()}
    want = Counter((i, largest[t or ""], len(groups[t or ""]), brute.sha(t or "")) for i, t in pairs)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_stream_dedup_compares_bytes(spark, tmp_path, monkeypatch):
    """With a digest that says nothing, the bytes decide."""
    monkeypatch.setattr(stream_dedup.F, "sha2", lambda c, n: F.substring(F.sha1(c), 1, 1).cast("string"))
    path = str(tmp_path / "docs")
    texts = [(i, f"t{i % 40}") for i in range(200)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(path)
    found = stream_dedup.copies(spark, path).select("doc_id", "keep_id", "group_size", "kept")
    assert bag(found) == Counter((i, 160 + i % 40, 5, i >= 160) for i, _ in texts)


# 7: lines


def test_line_dedup(docs, pairs):
    got = Counter((r.doc_id, tuple(r.lines), tuple(r.keep)) for r in line_dedup.kept_lines(docs).collect())
    want = brute.kept_lines(pairs)
    assert got == Counter((i, tuple(x), tuple(k)) for i, x, k in want)
    out = line_dedup.remove_lines(docs)
    same_rest(docs, out, ["doc_id", "lang", "rest", "lines", "d", "p"])
    assert bag(out.select("doc_id", "text")) == Counter((i, "\n".join(x[p] for p in k)) for i, x, k in want)


def test_line_dedup_edits(spark):
    """Every single edit of a line, and every pair of edits, with few letters so that many are ambiguous."""
    rnd = random.Random(8)
    lines = set()
    for _ in range(6):
        s = "".join(rnd.choice("ab") for _ in range(rnd.randint(8, 12)))
        for _ in range(60):
            t = s
            for _ in range(rnd.randint(0, 2)):
                k = rnd.randrange(len(t))
                t = rnd.choice([t[:k] + t[k + 1 :], t[:k] + rnd.choice("ab") + t[k:], t[:k] + rnd.choice("abé") + t[k + 1 :]])
            lines.add(t)
    lines = sorted(lines, key=lambda x: rnd.random())
    pairs = [(k, "\n".join(lines[5 * k : 5 * k + 5])) for k in range(len(lines) // 5 + 1)]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    got = Counter((r.doc_id, tuple(r.keep)) for r in line_dedup.kept_lines(df, min_chars=4).collect())
    assert got == Counter((i, tuple(k)) for i, _, k in brute.kept_lines(pairs, 4))


def test_probably_in(spark, monkeypatch):
    """No wanted row is lost, at any size of the bitmap, and few others pass."""
    rows = spark.range(20_000).select("id", F.col("id").cast("string").alias("s"))
    wanted = spark.range(0, 20_000, 100).select("id", F.col("id").cast("string").alias("s"))
    want = set(range(0, 20_000, 100))
    for most, passed in ((common.MOST_SLOTS, 210), (1 << 16, 300), (100, 20_000)):  # the last: more rows than bits
        monkeypatch.setattr(common, "LEAST_SLOTS", min(most, common.LEAST_SLOTS))
        monkeypatch.setattr(common, "MOST_SLOTS", most)
        got = common.probably_in(rows, wanted, ["id", "s"])
        assert got.columns == rows.columns
        got = {r.id for r in got.collect()}
        assert want <= got and len(got) <= passed
    assert common.probably_in(rows, wanted.limit(0), ["id"]).count() in (0, 20_000)


def test_line_dedup_short_lines(spark):
    """Equal short lines go, near ones and those without a word stay."""
    a = "All rights reserved.\n\nX.\n \t\n" + "y" * 31
    b = "X.\nAll rights reserved!\nAll rights reserved.\n\n \t\n\u00a0\nX."
    df = spark.createDataFrame([(2, b), (1, a), (3, "\u00a0\n" + "y" * 31 + "\n" + "y" * 30), (4, None)], "doc_id long, text string")
    kept = lambda **p: {r.doc_id: r.keep for r in line_dedup.kept_lines(df, **p).collect()}
    assert kept() == {1: [0, 1, 2, 3, 4], 2: [1, 3, 4, 5], 3: [2], 4: [0]}
    assert kept(exact_chars=3) == {1: [0, 1, 2, 3, 4], 2: [0, 1, 3, 4, 5, 6], 3: [0, 2], 4: [0]}
    assert kept(exact_chars=32) == {1: [0, 1, 2, 3, 4], 2: [0, 1, 2, 3, 4, 5, 6], 3: [0, 1, 2], 4: [0]}
    assert {r.doc_id: r.text for r in line_dedup.remove_lines(df).collect()}[3] == "y" * 30


def test_line_dedup_is_native(docs):
    plan = line_dedup.kept_lines(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# 9: windows


def digests_9(pairs):
    return Counter((i, len(w), sum(c), brute.sha(" ".join(x for x, y in zip(w, c, strict=True) if not y))) for i, w, c in brute.repeated_words(pairs))


def test_super_kmers(docs, pairs):
    assert bag(superkmer.digests(docs)) == digests_9(pairs)
    out = superkmer.remove_repeats(docs)
    same_rest(docs, out, ["doc_id", "lang", "rest", "block"])
    assert bag(out.select("doc_id", "text")) == Counter((i, " ".join(x for x, y in zip(w, c, strict=True) if not y)) for i, w, c in brute.repeated_words(pairs))


def test_super_kmers_small(small, small_pairs):
    assert bag(superkmer.digests(small)) == digests_9(small_pairs)


def test_super_kmers_of_a_crowded_line(spark):
    """One line in every text, amid different words: its minimisers are dealt out again."""
    rnd = random.Random(6)
    line = " ".join(f"c{i}" for i in range(12))
    long = " ".join(f"l{i}" for i in range(50))
    pairs = [(i, " ".join([*(f"x{rnd.randrange(10**6)}" for _ in range(30)), line, *(f"y{rnd.randrange(10**6)}" for _ in range(30)), long if i % 2 else ""])) for i in range(700)]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    assert bag(superkmer.digests(df)) == digests_9(pairs)


# no rows


def test_no_rows(spark, docs, tmp_path):
    none = durable_table(docs.limit(0), "no-rows")
    assert suffix_dedup.digests(none).count() == superkmer.digests(none).count() == 0
    for f in (suffix_dedup.remove_repeats, superkmer.remove_repeats, line_dedup.remove_lines, jaccard_join.keep_one):
        assert f(none).count() == 0 and f(none).columns == docs.columns
    assert rule_votes.judge(none)[0].count() == 0
    assert packing.pieces(none, P.path("word_bpe_49k.json")).count() == 0
    where = {"path": P.path("byte_bpe_multi_50k.tiktoken"), "pattern": P.PATTERN}
    assert merge_replay.decode(merge_replay.encode(none, **where), **where).count() == 0
    weights = pu_classifier.learn(pu_classifier.with_features(none), spark.createDataFrame([(2, 1), (3, 1), (4, 0)], "doc_id long, quality int"))
    assert pu_classifier.accepted(none, weights).count() == 0
    none.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    assert stream_dedup.op6_stream_dedup(spark, str(tmp_path)).count() == 0
    assert arrow_files.op10_arrow_stream_files(spark, str(tmp_path)).count() == 0


def test_only_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, ""), (2, " \n")], "doc_id long, text string")
    assert bag(jaccard_join.groups(df)) == Counter([(1, 0, 1), (2, 0, 2), (2, 0, 2), (None, 0, None)])
    assert {r.n_removed for r in suffix_dedup.digests(df).collect()} == {r.n_removed for r in superkmer.digests(df).collect()} == {0}
    assert line_dedup.remove_lines(df).count() == 4 and rule_votes.judge(df)[0].count() == 4


def test_file_layout(spark, tmp_path):
    """What the docstring says, read without the reader."""
    df = spark.createDataFrame([(3, "third text"), (1, "first"), (2, "")], "doc_id long, text string").coalesce(1)
    arrow_files.write(df.repartition(1), str(tmp_path / "f"), P.path("byte_bpe_50k.json"), 2, length=4)
    ids, ends, doc_ids = [], [], []
    for f in sorted((tmp_path / "f").glob("*.arrows")):
        with pa.OSFile(str(f)) as source:
            t = pa.ipc.open_stream(source).read_all()
            mask = np.array(t.column("mask").to_pylist()).reshape(-1)
            ids += np.array(t.column("ids").to_pylist()).reshape(-1)[mask].tolist()
            ends += np.array(t.column("ends").to_pylist()).reshape(-1)[mask].tolist()
            doc_ids += pa.ipc.open_stream(source).read_all().column("doc_id").to_pylist()
    t = library("byte_bpe_50k.json")
    want = [t.encode(x, add_special_tokens=False).ids + [2] for x in ("first", "", "third text")]
    assert doc_ids == [1, 2, 3] and ids == sum(want, []) and np.flatnonzero(ends).tolist() == (np.cumsum([len(x) for x in want]) - 1).tolist()
