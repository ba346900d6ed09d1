"""Quality rules by weak supervision.

Each rule votes for or against a text or abstains. How often a rule votes which way on good and on bad texts is not
set but estimated: expectation-maximisation over the counts of vote patterns of the whole corpus (there are at most
3 to the number of rules, whatever its size). A text is kept by its posterior probability to be good, not by passing
every rule.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import features
from tidelog.llm.common import documents, durable_table, ship, two_columns


@dataclass(frozen=True)
class Rule:
    """Votes 1 (good) where `good` holds, else -1 (bad) where `bad` holds, else 0."""

    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        return F.when(self.bad, -1).when(self.good, 1).otherwise(0)


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def default_rules() -> list[Rule]:
    symbols, ends = _share("n_symbols", "word_chars"), _share("n_symbol_ends", "n_words")
    caps, shouts = _share("n_caps_words", "n_words"), _share("n_exclaim", "n_words")
    length, distinct = _share("word_chars", "n_words"), _share("n_distinct_words", "n_words")
    lines, repeats = _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words")
    same, ended = _share("n_same_words", "n_words"), _share("n_ended_lines", "n_lines")
    never = F.lit(False)
    # a rule that looks for one fault knows nothing about texts without it, so it abstains there
    return [
        Rule("symbols", never, symbols > 0.04),
        Rule("symbol_ends", never, ends > 0.15),
        Rule("capitals", never, caps > 0.3),
        Rule("shouting", never, shouts > 0.25),
        Rule("word_length", never, (length < 2) | (length > 14)),
        Rule("duplicate_lines", never, lines > 0.3),
        Rule("repeated_words", never, repeats > 0.2),
        Rule("stutter", never, same > 0.1),
        Rule("plain_words", (ends < 0.02) & (caps < 0.1) & (shouts < 0.05) & length.between(3, 12), never),
        Rule("distinct_words", (distinct > 0.15) & (repeats < 0.1) & (same < 0.05), distinct < 0.15),
        Rule("line_ends", (ended > 0.7) & (ends < 0.02), ended < 0.2),
    ]


@dataclass
class VoteModel:
    """P(good), and P(vote | class) for each rule: `given[class, rule, vote + 1]`."""

    prior: float
    given: np.ndarray
    posterior: dict[tuple[int, ...], float] = field(default_factory=dict)

    def good(self, votes: np.ndarray) -> np.ndarray:
        logs = np.log(self.given)
        which = np.arange(votes.shape[1])
        bad, good = (logs[c, which, votes + 1].sum(1) for c in (0, 1))
        odds = good - bad + np.log(self.prior) - np.log1p(-self.prior)
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def fit(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation. It begins with rules that are right more often than not, which also tells the classes
    apart, and adds one text of each vote to each class, so no probability is zero."""
    start = np.array([[0.4, 0.3, 0.3], [0.05, 0.25, 0.7]])  # bad, none, good vote; of bad and of good texts
    model = VoteModel(0.8, np.repeat(start[:, None, :], votes.shape[1], 1))
    is_vote = (votes[:, :, None] + 1 == np.arange(3)).astype(float)
    for _ in range(rounds):
        good = model.good(votes) * counts
        weight = np.stack([counts - good, good])
        given = np.einsum("cp,pjv->cjv", weight, is_vote) + 1
        prior = float((good.sum() + 1) / (counts.sum() + 2))
        given /= given.sum(2, keepdims=True)
        moved = max(abs(prior - model.prior), float(np.abs(given - model.given).max()))
        model = VoteModel(prior, given)
        if moved < 1e-10:
            break
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> tuple[DataFrame, VoteModel]:
    """`doc_id`, the COUNTS of `features`, `votes` (array, by rule), `p_good`; one row per row. And the model.

    A null text has no words. Ids are only carried. An empty table gives an empty result and the starting model.
    """
    spark = docs.sparkSession
    ship(spark)
    rules = rules or default_rules()
    counted = two_columns(docs, id_col, text_col).mapInArrow(features.counts, f"doc_id long, {features.SCHEMA}")
    voted = durable_table(counted.withColumn("votes", F.array(*[r.vote().cast("int") for r in rules])), "votes")
    patterns = voted.groupBy("votes").count().collect()  # at most 3 ** len(rules) rows
    if not patterns:
        return voted.withColumn("p_good", F.lit(0.0)), fit(np.zeros((0, len(rules)), int), np.zeros(0), 0)
    votes, n = np.array([p.votes for p in patterns]), np.array([p["count"] for p in patterns], float)
    model = fit(votes, n)
    # the log odds add up rule by rule
    logs = np.log(model.given[1]) - np.log(model.given[0])
    odds = F.lit(float(np.log(model.prior) - np.log1p(-model.prior)))
    for j in range(len(rules)):
        v = F.col("votes")[j]
        odds = odds + F.when(v == -1, float(logs[j, 0])).when(v == 0, float(logs[j, 1])).otherwise(float(logs[j, 2]))
    return voted.withColumn("p_good", 1 / (1 + F.exp(-odds))), model


def op3_rule_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = judge(documents(spark, sf_dir))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("p_good") >= 0.5)).alias("kept"), "p_good",
    )


QUERIES = {"op3_rule_votes": op3_rule_votes}
