"""Quality rules as weak supervision.

Each rule looks at one statistic of the text and votes to keep, votes to reject or abstains.
Expectation-maximisation over the counts of vote patterns (at most 3 to the number of rules rows,
whatever the size of the corpus) estimates how often each rule votes either way on good and on bad
documents; a document is kept if the posterior probability that it is good reaches ``KEEP``.
Everything is a DataFrame expression: the texts are read once, without a shuffle, for the
statistics, which are written; only vote patterns are grouped.

Defined cases: a null or empty text has no words and fails the base rule; a null id stays null;
repeated rows each give a row; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE, apart, words
from tidemark.session import materialize

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
#: Statistic per rule; it votes to keep up to the first bound, to reject above the second, else abstains.
RULES = {
    "symbols": ("n_symbols / greatest(n_words, 1)", 0.05, 0.25),
    "symbol_share": ("n_symbols / greatest(word_chars, 1)", 0.01, 0.08),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 0.10, 0.25),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", 0.30, 0.60),
    "capitals": ("n_capitals / greatest(word_chars, 1)", 0.15, 0.40),
    "shouts": ("n_shouts / greatest(n_words, 1)", 0.05, 0.25),
    "word_length": ("abs(word_chars / greatest(n_words, 1) - 6)", 3.0, 8.0),
}
ROUNDS = 25
#: Before any evidence: four documents in five are good; a rule rejects few good ones (keep, reject, abstain) ...
PRIOR, GOOD = 0.8, {1: 0.945, -1: 0.005, 0: 0.05}
#: ... and finds its part of the bad ones.
BAD = {1: 0.55, -1: 0.35, 0: 0.10}
#: So many documents' worth of that is added to the counts, so that no estimate reaches 0 or 1.
SMOOTH = 10.0
KEEP = 0.5


def statistics(docs: DataFrame, kept: Sequence[str] | None = None) -> DataFrame:
    """(record, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ...) for every row.

    ``record`` holds the ``kept`` columns of ``docs``, by default all; those that repeat another's name, but for
    case, under names of their own (``common.apart``).
    """
    docs = apart(docs, *dict.fromkeys(["doc_id", "text", *(kept or [])]))
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("t", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept or docs.columns]).alias("record"), text.alias("t"))
    step = step.select(
        "record", "t",
        words(F.col("t")).alias("w"),
        lines.alias("lines"),
        F.regexp_replace("t", f"{WHITE}+", "").alias("bare"),
    )
    step = step.select(
        "record",
        F.size("w").cast("long").alias("n_words"),
        F.length("bare").cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{Lu}", ""))).cast("long").alias("n_capitals"),
        (F.length("t") - F.length(F.replace("t", F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
        F.transform("w", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    # Windows by the hash of their words. Texts whose windows all differ, most of them, end at the first test.
    windows = F.expr(
        f"if(n_words < {WINDOW}, array(), transform(sequence(1, cast(n_words as int) - {WINDOW - 1}), "
        f"i -> xxhash64(slice(hashes, i, {WINDOW}))))"
    )
    step = step.withColumn("windows", windows).drop("hashes")
    # Sorted with their places, equal windows lie side by side ...
    ordered = F.expr(
        "if(size(array_distinct(windows)) < size(windows), "
        "array_sort(transform(windows, (h, i) -> struct(h as h, i as i))), null)"
    )
    step = step.withColumn("ordered", ordered).drop("windows")
    places = F.expr(
        "array_sort(filter(transform(ordered, (x, k) -> if(x.h <=> get(ordered, k + 1).h "
        "or x.h <=> get(ordered, k - 1).h, cast(x.i as bigint), null)), i -> i is not null))"
    )
    step = step.withColumn("places", places).drop("ordered")
    # ... and the places of repeated windows, in order, cover a window each or up to the next place.
    covered = F.expr(
        f"coalesce(aggregate(transform(places, (p, k) -> least(get(places, k + 1) - p, {WINDOW}L)), 0L, (s, n) -> s + n), 0L)"
    )
    return step.withColumn("n_repeat_words", covered).drop("places")


def with_votes(stats: DataFrame) -> DataFrame:
    """Adds a column per rule: 1 to keep, -1 to reject, 0 to abstain."""
    return stats.select(
        "*",
        *[
            F.when(F.expr(value) <= keep, 1).when(F.expr(value) > reject, -1).otherwise(0).alias(f"vote_{name}")
            for name, (value, keep, reject) in RULES.items()
        ],
    )


def _log_odds(model: dict) -> Column:
    """Log odds that a document is good, given its votes."""
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for rule, rates in model["rates"].items():
        vote = F.col(f"vote_{rule}")
        odds = odds + F.when(vote == 1, math.log(rates["good"][1] / rates["bad"][1])).when(
            vote == -1, math.log(rates["good"][-1] / rates["bad"][-1])
        ).otherwise(math.log(rates["good"][0] / rates["bad"][0]))
    return odds


def _rates(keep: float, reject: float, total: float, before: dict) -> dict:
    counts = {1: keep, -1: reject, 0: max(0.0, total - keep - reject)}
    return {vote: (n + SMOOTH * before[vote]) / (total + SMOOTH) for vote, n in counts.items()}


def fit(votes: DataFrame, rounds: int = ROUNDS) -> dict:
    """Expectation-maximisation over the vote patterns; the driver sees one row of sums a round."""
    rules = list(RULES)
    columns = [f"vote_{r}" for r in rules]
    patterns = materialize(votes.groupBy(*columns).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    model = {"prior": PRIOR, "rates": {r: {"good": GOOD, "bad": BAD} for r in rules}}
    for _ in range(rounds):
        good = F.col("n") / (1 + F.exp(-_log_odds(model)))
        sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
        for r in rules:
            for vote, mark in ((1, "keep"), (-1, "reject")):
                here = F.col(f"vote_{r}") == vote
                sums += [
                    F.sum(F.when(here, F.col("good")).otherwise(0.0)).alias(f"good_{mark}_{r}"),
                    F.sum(F.when(here, F.col("n") - F.col("good")).otherwise(0.0)).alias(f"bad_{mark}_{r}"),
                ]
        row = patterns.withColumn("good", good).agg(*sums).first()
        if not row["n"]:
            return model
        bad = row["n"] - row["good"]
        model = {
            "prior": (row["good"] + SMOOTH * PRIOR) / (row["n"] + SMOOTH),
            "rates": {
                r: {
                    "good": _rates(row[f"good_keep_{r}"], row[f"good_reject_{r}"], row["good"], GOOD),
                    "bad": _rates(row[f"bad_keep_{r}"], row[f"bad_reject_{r}"], bad, BAD),
                }
                for r in rules
            },
        }
    return model


def judge(docs: DataFrame, keep: float = KEEP, kept: Sequence[str] | None = None) -> DataFrame:
    """Statistics, base rule, posterior and verdict of every row of ``docs`` (doc_id, text), with its ``kept`` columns."""
    votes = with_votes(materialize(statistics(docs, kept), "rule-statistics"))
    model = fit(votes.where(~_base_failed()))
    posterior = 1 / (1 + F.exp(-_log_odds(model)))
    return votes.withColumn("base_failed", _base_failed()).withColumn("posterior", posterior).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= keep)
    )


def _base_failed() -> Column:
    return F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
