"""Rule metrics as column expressions.

Operation order is fixed so that results are bit-equal to a plain
double-precision computation: support = n/N, confidence = p/n,
lift = confidence/(P/N) (0 when the base rate is 0), score = lift*confidence*support.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC_COLUMNS = ("support", "confidence", "lift", "score")


def rule_metrics(n: Column, p: Column, n_total: Column, p_total: Column) -> dict[str, Column]:
    n_d, p_d = n.cast("double"), p.cast("double")
    nt_d, pt_d = n_total.cast("double"), p_total.cast("double")
    support = n_d / nt_d
    confidence = F.when(n_d > 0, p_d / n_d).otherwise(F.lit(0.0))
    base_rate = pt_d / nt_d
    lift = F.when(base_rate > 0, confidence / base_rate).otherwise(F.lit(0.0))
    return {"support": support, "confidence": confidence, "lift": lift, "score": lift * confidence * support}


def with_rule_metrics(df: DataFrame, n: str, p: str, n_total: Column, p_total: Column) -> DataFrame:
    """Add support/confidence/lift/score; ``n_total``/``p_total`` are usually
    scalar subqueries over the cell table (computed once, inlined as values)."""
    m = rule_metrics(F.col(n), F.col(p), n_total, p_total)
    return df.withColumns({"support": m["support"], "confidence": m["confidence"]}) \
             .withColumns({"lift": m["lift"]}) \
             .withColumn("score", F.col("lift") * F.col("confidence") * F.col("support"))


def z_two_proportion(n: Column, p: Column, n_total: Column, p_total: Column) -> Column:
    """Two-proportion z: label rate inside the pattern vs outside it, pooled
    variance. Null when either side is empty or the pooled rate is 0 or 1."""
    n_d, p_d = n.cast("double"), p.cast("double")
    nt_d, pt_d = n_total.cast("double"), p_total.cast("double")
    rest = nt_d - n_d
    inside = p_d / n_d
    outside = (pt_d - p_d) / rest
    pooled = pt_d / nt_d
    var = pooled * (1.0 - pooled) * (1.0 / n_d + 1.0 / rest)
    return F.when((n_d > 0) & (rest > 0) & (var > 0), (inside - outside) / F.sqrt(var))
