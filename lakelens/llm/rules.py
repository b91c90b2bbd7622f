"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose statistic lies beyond a cutoff. For each stratum (language) and rule, cutoffs are
tested from the loosest to the strictest on a labelled holdout: a cutoff stands if the exact binomial tail says that
rejecting this few good documents would be unlikely (below delta) were the true false rejection rate above alpha.
Testing in a fixed sequence needs no correction within a rule; delta is divided by the number of (stratum, rule) pairs
and alpha by the number of rules, so with probability 1 - delta every stratum's false rejection rate is at most alpha.
The grid of cutoffs is fixed beforehand, so no label is used twice.

Nulls: a null text has no words and fails the base rules; a null lang is a stratum of its own; a null label is not
used. A stratum without labels has no cutoff and rejects nothing beyond the base. Repeated rows are judged alike. An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .textstats import STATS, with_stats

ALPHA, DELTA = 0.05, 0.05
GRID = 64
#: name: (statistic that grows as quality falls, its largest value on the grid)
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", 0.5),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", 1.0),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 1.0),
    "digits": ("n_digits / greatest(word_chars, 1)", 0.5),
    "long_words": ("word_chars / greatest(n_words, 1) / 40", 1.0),
    "few_words": ("1 / log10(10 + n_words)", 1.0),
    "low_variety": ("1 - n_distinct / greatest(n_words, 1)", 1.0),
}


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def steps() -> list[Column]:
    """Each rule's statistic as a step of its grid, 0 to GRID."""
    return [F.least(F.lit(GRID), F.greatest(F.lit(0), F.floor(F.expr(expr) / F.lit(top) * GRID))).cast("int").alias(f"step_{name}") for name, (expr, top) in RULES.items()]


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exactly."""
    log_term = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    return min(1.0, math.fsum(math.exp(log_term(i)) for i in range(k + 1)))


def cutoff(good_by_step: list[int], alpha: float, delta: float) -> int:
    """The strictest step such that it and all looser ones pass; GRID + 1 where not even the loosest does.
    A document is rejected where its step is at least the cutoff."""
    n, best = sum(good_by_step), GRID + 1
    for c, rejected in zip(range(GRID, 0, -1), accumulate(reversed(good_by_step[1:])), strict=True):
        if not n or rejected > alpha * n or binomial_tail(rejected, n, alpha) > delta:
            break
        best = c
    return best


def calibrate(stats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> list[tuple]:
    """(lang, a cutoff for each rule). What the driver gets is a count for each stratum, rule and step."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    held = stats.where(~base_failed()).join(good, "doc_id", "left_semi").select("lang", *steps())
    stacked = held.select("lang", F.posexplode(F.array(*[f"step_{r}" for r in RULES])).alias("rule", "step"))
    counts: dict = {}
    for x in stacked.groupBy("lang", "rule", "step").count().collect():
        counts.setdefault(x.lang, [[0] * (GRID + 1) for _ in RULES])[x.rule][x.step] = x["count"]
    share = delta / max(1, len(counts) * len(RULES))
    return [(lang, *(cutoff(x, alpha / len(RULES), share) for x in found)) for lang, found in counts.items()]


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """doc_id, lang, STATS, base_failed, kept."""
    stats = materialize(with_stats(docs, ["doc_id", "lang"]), "rule-stats")
    found = calibrate(stats, labels, alpha, delta)
    names = [f"cut_{r}" for r in RULES]
    limits = docs.sparkSession.createDataFrame(found, "stratum string, " + ", ".join(f"{x} int" for x in names))
    joined = stats.select("*", *steps()).join(limits, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    beyond = F.lit(False)
    for r in RULES:
        beyond = beyond | (F.col(f"step_{r}") >= F.coalesce(F.col(f"cut_{r}"), F.lit(GRID + 1)))
    return joined.select("doc_id", "lang", *STATS, base_failed().alias("base_failed"), (~base_failed() & ~beyond).alias("kept"))
