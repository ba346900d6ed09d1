"""Each stage on its own input against brute force, the chain of them, and the queries that have SQL."""

from collections import Counter

import brute
import corpus_pipeline
import pytest
from compare import differences, duck
from conftest import SF

import __spark_entry__ as contract
from tidelog.llm import pu_classifier, registered
from tidelog.session import durable_table

STAGE = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark):
    return durable_table(spark.createDataFrame(brute.odd_rows(9), brute.SCHEMA).repartition(4), "odd-rows")


@pytest.fixture(scope="module")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_stages_in_order():
    assert list(STAGE) == ["quality classifier", "line dedup", "n-gram Jaccard join", "suffix-array dedup", "packing"]


def test_quality(spark, docs):
    out = STAGE["quality classifier"](spark, docs, SF)
    assert out.columns == docs.columns
    weights = pu_classifier.learn(pu_classifier.with_features(docs), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = pu_classifier.score(pu_classifier.with_features(docs), weights)
    assert out.count() == scores.filter("score >= 0.5").count()
    assert not bag(out.select("doc_id", "lang", "block")) - bag(docs.select("doc_id", "lang", "block"))


def test_lines(spark, docs, pairs):
    out = STAGE["line dedup"](spark, docs, SF)
    assert out.columns == docs.columns
    want = Counter((i, t, len(t)) for i, x, k in brute.kept_lines(pairs) for t in ["\n".join(x[p] for p in k)])
    assert bag(out.select("doc_id", "text", "n_chars")) == want


def test_short_lines(spark):
    """No line with a word is left twice."""
    out = STAGE["line dedup"](spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    left = Counter(x for r in out.select("text").collect() for x in r.text.split("\n") if brute.WORD.search(x))
    assert left and max(left.values()) == 1


def test_near_duplicates(spark, docs, pairs):
    out = STAGE["n-gram Jaccard join"](spark, docs, SF)
    assert out.columns == docs.columns
    assert bag(out.select("doc_id", "text")) == Counter((i, t) for (i, t), (_, _, c) in zip(pairs, brute.jaccard_groups(pairs, 5, 80), strict=True) if i == c)


def test_passages(spark, docs, pairs):
    out = STAGE["suffix-array dedup"](spark, docs, SF)
    assert out.columns == docs.columns
    want = Counter((i, t, len(t)) for i, b, cut in brute.repeated_bytes(pairs) for t in [brute.without(b, brute.whole_characters(b, cut)).decode()])
    assert bag(out.select("doc_id", "text", "n_chars")) == want


def test_packing(spark, docs, pairs):
    out = STAGE["packing"](spark, docs, SF).collect()
    assert Counter(r.doc_id for r in out if r.start == 0) == Counter(i for i, _ in pairs)
    assert all(len(r.ids) == 4 * r.length for r in out)


def test_no_rows(spark, docs):
    none = durable_table(docs.limit(0), "no-rows")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, SF)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_run(spark):
    """The chain gives what its stages give, one after the other."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = durable_table(stage(spark, docs, SF), f"test-stage{k}")
        sizes.append(docs.count())
        assert k == 4 or docs.columns == COLUMNS
    assert sizes[0] > sizes[1] >= sizes[2] >= sizes[3] == sizes[4]
    got = contract.queries()["pipeline"](spark, SF)
    keys = ["doc_id", "start", "length", "doc_tokens", "ids"]
    assert bag(got.select(*keys)) == bag(docs.select(*keys))


def test_all_operators_are_registered():
    have = set(contract.queries())
    assert {n.split("_")[0] for n in registered.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(registered.QUERIES) | {"pipeline"} <= have and set(registered.ORACLES) <= set(contract.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_query_matches_sql(spark, con, name):
    diff, rows, _ = differences(spark, con, name, registered.QUERIES[name], registered.ORACLES[name], SF)
    assert diff is None
    assert rows > 0
