"""D5 for many patterns at once: exact tails and a bound on the share of false discoveries.

The p value of a pattern is the hypergeometric probability that as many rows, drawn at random, hold
at least its number of positives. Its terms fall from the first one on; they are dealt to rows in
blocks of ``BLOCK``, each block starts from its own exact term and goes on by the ratio of neighbouring terms.
A tail has at most about 14 standard deviations of terms above a share of e^-40 of the first; the rest is left out.
All is kept as logarithms, as p values of strong patterns are below the least double.
The q value is the least share of false discoveries at which the step-up rule
(p <= share * place / tests) takes the pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.probability import log_hypergeometric
from ..session import materialize
from .cells import totals
from .ranking import least_from_here, rank_by_ranges

BLOCK = 1024
NEGLIGIBLE = 40.0  # a term below e^-40 of the first


def _up(x: Column) -> Column:
    """Term x + 1 over term x."""
    return ((F.col("_positive") - x) * (F.col("_drawn") - x)) / ((x + 1) * (F.col("_rows") - F.col("_positive") - F.col("_drawn") + x + 1))


def _down(x: Column) -> Column:
    """Term x - 1 over term x."""
    return (x * (F.col("_rows") - F.col("_positive") - F.col("_drawn") + x)) / ((F.col("_positive") - x + 1) * (F.col("_drawn") - x + 1))


def _ratio(x: Column) -> Column:
    return F.when(F.col("_upper"), _up(x)).otherwise(_down(x))


def _step(j: Column) -> Column:
    """The j-th count from the first term of the tail that is summed."""
    return F.col("_start") + F.when(F.col("_upper"), j).otherwise(-j)


def _to_negligible(ratio: Column) -> Column:
    """Terms until they are negligible, if each is at most ``ratio`` of the one before."""
    return F.when((ratio > 0) & (ratio < 1), F.ceil(NEGLIGIBLE / -F.log(ratio)).cast("double") + 1)


def log_tails(patterns: DataFrame, key: str, n_total: int, p_total: int, base: str | None = None) -> DataFrame:
    """(``key``, log_p): log of the p value of each pattern (pattern_total, pattern_fraud). ``key`` is unique."""
    t = patterns.select(key, F.col("pattern_fraud").cast("double").alias("_held"), F.col("pattern_total").cast("double").alias("_drawn"),
                        F.lit(float(p_total)).alias("_positive"), F.lit(float(n_total)).alias("_rows"))
    # The side of the mean on which the terms fall is summed; the other one is what is left to 1.
    t = t.withColumn("_upper", F.col("_held") * F.col("_rows") > F.col("_drawn") * F.col("_positive"))
    t = t.withColumn("_start", F.when(F.col("_upper"), F.col("_held")).otherwise(F.col("_held") - 1))
    low = F.greatest(F.lit(0.0), F.col("_drawn") + F.col("_positive") - F.col("_rows"))
    t = t.withColumn("_all", F.when(F.col("_upper"), F.least("_drawn", "_positive") - F.col("_start") + 1)
                     .otherwise(F.col("_start") - low + 1))
    share = F.col("_positive") / F.greatest(F.col("_rows"), F.lit(1.0))
    sigma = F.sqrt(F.col("_drawn") * share * (1 - share) * (F.col("_rows") - F.col("_drawn")) / F.greatest(F.col("_rows") - 1, F.lit(1.0)))
    t = t.withColumn("_far", F.greatest(F.least(F.col("_all") - 1, F.ceil(9 * sigma).cast("double")), F.lit(0.0)))
    t = t.withColumns({"_first": _to_negligible(_ratio(F.col("_start"))),
                       "_then": F.col("_far") + _to_negligible(_ratio(_step(F.col("_far"))))})
    t = t.withColumn("_terms", F.least("_all", "_first", "_then").cast("long"))
    # Written, so that the terms are counted once and the next plan starts from columns.
    t = materialize(t.drop("_held", "_all", "_far", "_first", "_then"), "terms", base=base)
    some = t.where("_terms > 0").withColumn("_log_start", log_hypergeometric(F.col("_start"), F.col("_drawn"), F.col("_positive"), F.col("_rows")))
    blocks = some.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_terms") - 1, F.lit(BLOCK).cast("long"))))
    blocks = blocks.withColumn("_x", _step(F.col("_j").cast("double")))
    first = F.exp(log_hypergeometric(F.col("_x"), F.col("_drawn"), F.col("_positive"), F.col("_rows")) - F.col("_log_start"))
    blocks = blocks.withColumn("_term", first)
    sign = F.when(F.col("_upper"), 1.0).otherwise(-1.0)
    steps = F.sequence(F.lit(1).cast("long"), F.least(F.lit(BLOCK).cast("long"), F.col("_terms") - F.col("_j")))
    summed = F.aggregate(
        steps, F.struct(F.lit(0.0).alias("total"), F.col("_term").alias("term")),
        lambda a, i: F.struct((a["total"] + a["term"]).alias("total"),
                              (a["term"] * _ratio(F.col("_x") + sign * (i.cast("double") - 1))).alias("term")))["total"]
    sums = (blocks.withColumn("_sum", summed).groupBy(key, "_upper", "_log_start").agg(F.sum("_sum").alias("_sum"))
            .withColumn("_tail", F.least(F.col("_log_start") + F.log("_sum"), F.lit(0.0))))
    known = sums.select(key, F.when(F.col("_upper"), F.col("_tail")).otherwise(F.log1p(-F.exp("_tail"))).alias("log_p"))
    # No smaller count is possible: the p value is 1.
    return known.unionByName(t.where("_terms <= 0").select(key, F.lit(0.0).alias("log_p")))


def false_discovery(patterns: DataFrame, cells: DataFrame, key: str = "rank", share: float = 0.05,
                    base: str | None = None) -> DataFrame:
    """``patterns`` with log_p, log_q and ``significant`` (q <= ``share``), all patterns of the table being the tests."""
    sums = totals(cells).first()
    n_total, p_total = int(sums["n_total"] or 0), int(sums["p_total"] or 0)
    tails = materialize(log_tails(patterns, key, n_total, p_total, base), "tails", base=base)
    place, tests = "_place", tails.count()
    ranked = rank_by_ranges(tails, [F.asc("log_p"), F.asc(key)], rank=place, base=base, keep_part=True)
    ranked = ranked.withColumn("_v", F.col("log_p") + F.log(F.lit(float(max(tests, 1))) / F.col(place)))
    q = least_from_here(ranked, "_v", "log_q", rank=place).withColumn("log_q", F.least("log_q", F.lit(0.0)))
    q = q.withColumn("significant", F.col("log_q") <= F.log(F.lit(float(share))))
    return patterns.join(q.select(key, "log_p", "log_q", "significant"), key)
