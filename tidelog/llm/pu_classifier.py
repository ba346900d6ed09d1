"""A quality classifier from positives and unlabelled texts.

Trusted positives are texts with label 1; all texts of the table are unlabelled web text, and label 0 is not used as a
negative. With the logistic loss l and the share `prior` of positives among unlabelled texts the risk is

    prior * E_positive[l(g)] + max(0, E_unlabelled[l(-g)] - prior * E_positive[l(-g)])

whose second term is the unbiased estimate of the risk on negatives, kept from going below zero. Without the bound it is
convex, so Newton steps over all rows find its minimum; a step that would make the second term negative gives way to
one that raises it. Each step is one pass over a small table of features, summed up by Spark. The prior is the share of
label 1 among the rows whose labels may be seen. Scores depend on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import features
from tidelog.llm.common import documents, durable_table, ship, two_columns, with_rest

#: Shares and where they are half way to their bound: x / (x + half).
_SHARES = (
    ("n_symbols", "word_chars", 0.02), ("n_symbol_ends", "n_words", 0.05), ("n_caps_words", "n_words", 0.1), ("n_exclaim", "n_words", 0.05),
    ("n_dup_lines", "n_lines", 0.1), ("n_repeat_words", "n_words", 0.1), ("n_same_words", "n_words", 0.05), ("n_digits", "word_chars", 0.1),
)
WIDTH = len(_SHARES) + 6
_FEATURES = "features array<float>"


def vectors(c: dict[str, np.ndarray]) -> np.ndarray:
    """A bounded vector of WIDTH numbers for each text; a constant comes first."""
    one = lambda x: np.maximum(x, 1)
    share = lambda a, b: c[a] / one(c[b])
    n = c["n_words"]
    columns = [np.ones(len(n))]
    for a, b, half in _SHARES:
        x = share(a, b)
        columns.append(x / (x + half))
    length = np.minimum(share("word_chars", "n_words"), 20)
    columns += [
        np.log1p(n) / 10, np.abs(length - 5) / (np.abs(length - 5) + 3), share("n_distinct_words", "n_words"),
        np.minimum(share("n_stops", "n_words"), 1), np.minimum(share("n_ended_lines", "n_lines"), 1),
    ]
    return np.stack(columns, 1).astype(np.float32)


def _vectors(batches: Iterator[pa.RecordBatch], also: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for batch in features.counts(batches, also):
        x = vectors({c: np.asarray(batch.column(c)) for c in features.COUNTS})
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * WIDTH), pa.array(x.reshape(-1)))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in also], lists], names=[*also, "features"])


def with_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, features`, one row per row. A null text counts as empty."""
    ship(docs.sparkSession)
    return two_columns(docs, id_col, text_col).mapInArrow(partial(_vectors, also=("doc_id",)), f"doc_id long, {_FEATURES}")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("features").flatten(), np.float64).reshape(-1, WIDTH)


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def _sums(batches: Iterator[pa.RecordBatch], w: list[float]) -> Iterator[pa.RecordBatch]:
    """Sums over the rows of a task: of unlabelled and of positive rows the number, the loss as a negative, its
    gradient and its curvature, and of positive rows the vector."""
    total = np.zeros(2 * (2 + WIDTH + WIDTH * WIDTH) + WIDTH)
    for batch in batches:
        x, positive = _matrix(batch), np.asarray(batch.column("positive").cast(pa.int8()), bool)
        at = 0
        for rows in (x, x[positive]):
            g = rows @ np.array(w)
            p = 1 / (1 + np.exp(-np.clip(g, -500, 500)))
            part = [[len(rows), _softplus(g).sum()], rows.T @ p, ((rows * (p * (1 - p))[:, None]).T @ rows).reshape(-1)]
            part = np.concatenate(part)
            total[at : at + len(part)] += part
            at += len(part)
        total[at:] += x[positive].sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])


def fit(rows: DataFrame, prior: float, steps: int = 12, ridge: float = 1e-4) -> np.ndarray:
    """Weights from `features` and `positive` (boolean) by at most `steps` passes. All rows count as unlabelled."""
    w = np.zeros(WIDTH)
    d = WIDTH
    for _ in range(steps):
        sums = rows.select("features", "positive").mapInArrow(partial(_sums, w=w.tolist()), "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        s = np.array([r.v for r in sums.orderBy("i").collect()])  # as many numbers as the model has, whatever the input
        size = 2 + d + d * d
        if not len(s) or s[0] == 0 or s[size] == 0:
            return w
        u, p, mean = s[:size] / s[0], s[size : 2 * size] / s[size], s[2 * size :] / s[size]
        negative = u[1] - prior * p[1]
        curve = u[2 + d :].reshape(d, d) + ridge * np.eye(d)
        if negative >= 0:
            # prior * (l(g) - l(-g)) is linear in g, which leaves the loss of the unlabelled rows and a mean
            gradient = u[2 : 2 + d] - prior * mean + ridge * w
            step = -np.linalg.solve(curve, gradient)
        else:
            step = np.linalg.solve(curve, u[2 : 2 + d] - prior * p[2 : 2 + d])  # upwards, until it is positive again
        length = np.abs(step).max()
        w = w + step * min(1.0, 5.0 / max(length, 1e-12))
        if length < 1e-4:
            break
    return w


def _score(batches: Iterator[pa.RecordBatch], w: list[float], keep: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        g = np.clip(_matrix(batch) @ np.array(w), -500, 500)
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(1 / (1 + np.exp(-g)))], names=[*keep, "score"])


def score(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """`rows` without `features`, with `score` between 0 and 1."""
    keep = tuple(c for c in rows.columns if c != "features")
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(partial(_score, w=weights.tolist(), keep=keep), f"{schema}, score double")


def _score_texts(batches: Iterator[pa.RecordBatch], w: list[float], keep: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    return _score(_vectors(batches, keep), w, keep)


def accepted(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `docs` that score `least` or more, with all their columns, the id as long."""
    rows = two_columns(docs, id_col, text_col, carry=True)
    keep = tuple(rows.columns)
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    scored = rows.mapInArrow(partial(_score_texts, w=weights.tolist(), keep=keep), f"{schema}, score double")
    return with_rest(docs, scored.filter(F.col("score") >= least), id_col, text_col)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt from. A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))


def learn(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> np.ndarray:
    """Weights from `with_features` and the labels of rows that are not held out.

    Labels of an id that has both are dropped, null labels too. Without a label 1 all weights are 0, and every score
    one half, which counts as good.
    """
    seen = labels.filter(~held_out(id_col)).filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
    seen = seen.agg(F.min(label_col).alias("least"), F.max(label_col).alias("most")).filter("least = most").select("doc_id", (F.col("most") == 1).alias("positive"))
    share = seen.agg(F.avg(F.col("positive").cast("double"))).first()[0]
    if not share:
        return np.zeros(WIDTH)
    # labels of equal id were merged above, so the join adds no rows
    table = rows.select("doc_id", "features").join(seen, "doc_id", "left").select("features", F.coalesce("positive", F.lit(False)).alias("positive"))
    return fit(durable_table(table, "pu-rows"), min(0.95, max(0.05, share)))


def op5_pu_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = durable_table(with_features(documents(spark, sf_dir)), "pu-features")
    weights = learn(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(rows, weights).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op5_pu_classifier": op5_pu_classifier}
