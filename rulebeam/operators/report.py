"""Pattern reports and chart data: G10-G14, M7, C5-C9, D1-D7.

All inputs here are pattern or validation tables (bounded by beam x domain),
so single-partition windows are acceptable; nothing here touches rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import spec as S
from ..functions.items import as_percent, readable_label, truncate
from ..functions.metrics import z_two_proportion
from .cells import total_columns
from .profile import rate_by_feature


def pattern_counts(patterns: DataFrame) -> DataFrame:
    """Patterns per level plus a total row (level null, type Total)."""
    g = patterns.rollup("level").agg(F.count(F.lit(1)).alias("n_patterns"))
    return g.withColumn("pattern_type", F.when(F.col("level").isNull(), F.lit("Total"))
                        .otherwise(F.concat(F.col("level").cast("string"), F.lit(S.PATTERN_TYPE_SUFFIX))))


def pattern_type_counts(patterns: DataFrame) -> DataFrame:
    """Value counts of Pattern_Type, most frequent first."""
    return (patterns.groupBy("pattern_type").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "pattern_type"))


def pattern_summary(patterns: DataFrame, confidence_col: str = "confidence") -> DataFrame:
    """Pattern count, mean and best confidence in percent (a 0-1
    column is scaled when its max is at most 1). C9: with no confidence
    column only the count is returned."""
    if confidence_col not in patterns.columns:
        return patterns.agg(F.count(F.lit(1)).alias("n_patterns"))
    c = F.col(confidence_col)
    g = patterns.agg(F.count(F.lit(1)).alias("n_patterns"), F.avg(c).alias("_avg"), F.max(c).alias("_max"))
    return g.select("n_patterns",
                    as_percent(F.col("_avg"), F.col("_max")).alias("avg_confidence_pct"),
                    as_percent(F.col("_max"), F.col("_max")).alias("max_confidence_pct"))


def report_table(patterns: DataFrame, n: int = S.VALIDATE_N, width: int = S.REPORT_NAME_WIDTH) -> DataFrame:
    """M7: rank, name cut to ``width``, confidence, lift, score of the top n."""
    return (patterns.filter(F.col("rank") <= n)
            .select("rank", truncate(F.col("pattern_name"), width).alias("pattern_short"),
                    "confidence", "lift", "score"))


def pattern_labels(patterns: DataFrame, n: int = S.VALIDATE_N, confidence_col: str = "confidence") -> DataFrame:
    """Chart rows for the top n: readable label, numbered
    label, ``#k`` tick and confidence in percent (scale decided on the max of
    the shown rows)."""
    top = patterns.filter(F.col("rank") <= n)
    mx = F.max(F.col(confidence_col)).over(Window.partitionBy())
    readable = readable_label(F.col("pattern_name"))
    return top.select(
        "rank", "pattern_name", readable.alias("readable_label"),
        F.concat(F.col("rank").cast("string"), F.lit(". "), readable).alias("display_label"),
        F.concat(F.lit("#"), F.col("rank").cast("string")).alias("rank_label"),
        as_percent(F.col(confidence_col), mx).alias("confidence_pct"), "lift")


def run_summary(train_composition: DataFrame, test_rows: DataFrame, patterns: DataFrame,
                validated: DataFrame, run_id: str | None = None) -> DataFrame:
    """Metric/Value long table.

    ``train_composition``: one-row composition of the training split;
    ``test_rows``: one-row frame with ``n_rows`` of the test split;
    ``validated``: stability output. Best pattern = rank 1 by score; metrics
    of an empty pattern table are 0.
    """
    # Two scalar subqueries (one over the patterns, one over the validation)
    # carry all six values.
    pat = patterns.select(F.struct(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.max(F.when(F.col("rank") == 1, F.col("confidence") * 100)).alias("best_conf"),
        F.max(F.when(F.col("rank") == 1, F.col("lift"))).alias("best_lift"))).scalar()
    val = validated.select(F.struct(
        F.count_if(F.col("valid")).cast("double").alias("valid"),
        F.count_if(F.col("stable")).cast("double").alias("stable"))).scalar()
    test_n = test_rows.select(F.col("n_rows").cast("double")).scalar()
    m = S.SUMMARY_METRICS
    row = train_composition.select(
        F.coalesce(F.col("n_labelled").cast("double"), F.lit(0.0)).alias(m[0]),
        F.coalesce(test_n, F.lit(0.0)).alias(m[1]),
        F.coalesce(F.col("fraud_rate_pct"), F.lit(0.0)).alias(m[2]),
        F.coalesce(pat["n"], F.lit(0.0)).alias(m[3]),
        F.coalesce(val["valid"], F.lit(0.0)).alias(m[4]),
        F.coalesce(val["stable"], F.lit(0.0)).alias(m[5]),
        F.coalesce(pat["best_conf"], F.lit(0.0)).alias(m[6]),
        F.coalesce(pat["best_lift"], F.lit(0.0)).alias(m[7]))
    names = row.columns
    long = row.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("metric_no"), F.lit(m).alias("metric"), F.col(m).alias("value"),
                 F.lit(None).cast("string").alias("text"))
        for i, m in enumerate(names)])))
    if run_id is not None:
        stamp = long.sparkSession.range(1).select(
            F.lit(len(names) + 1).alias("metric_no"), F.lit(S.SUMMARY_METRICS[8]).alias("metric"),
            F.lit(None).cast("double").alias("value"), F.lit(run_id).alias("text"))
        long = long.unionByName(stamp)
    return long


# --- documented extras (D1-D7) ------------------------------------------------

def feature_matrix(patterns: DataFrame) -> DataFrame:
    """For every unordered feature pair that occurs together in a
    pattern: pattern count, max lift and max score. A pattern has at most
    C(max_len, 2) feature pairs."""
    idx = F.sequence(F.lit(0), F.size("items") - 1)
    pairs = F.flatten(F.transform(idx, lambda i: F.transform(
        F.filter(idx, lambda j: j > i),
        lambda j: F.struct(F.least(F.col("items")[i]["feature"], F.col("items")[j]["feature"]).alias("feature_a"),
                           F.greatest(F.col("items")[i]["feature"], F.col("items")[j]["feature"]).alias("feature_b")))))
    x = patterns.select("lift", "score", F.inline(pairs))
    return x.groupBy("feature_a", "feature_b").agg(
        F.count(F.lit(1)).alias("n_patterns"), F.max("lift").alias("max_lift"), F.max("score").alias("max_score"))


def temporal_profile(rows: DataFrame, label: str = "is_fraud",
                     features: Sequence[str] = ("hour", "day_of_week", "month")) -> DataFrame:
    """D3: label rate by hour, day of week and month (unrounded)."""
    return rate_by_feature(rows, features, label, round_to=None)


def feature_importance(patterns: DataFrame) -> DataFrame:
    """Per feature, number of kept patterns using it, mean/max score and
    max lift."""
    x = patterns.select("score", "lift", F.explode("items").alias("it"))
    return x.groupBy(F.col("it.feature").alias("feature")).agg(
        F.count(F.lit(1)).alias("n_patterns"), F.avg("score").alias("avg_score"),
        F.max("score").alias("max_score"), F.max("lift").alias("max_lift"))


def significance(patterns: DataFrame, cells: DataFrame) -> DataFrame:
    """Two-proportion z score of each pattern's label rate against the
    rate of all other rows."""
    n_total, p_total = total_columns(cells)
    return patterns.withColumn("z_score", z_two_proportion(F.col("pattern_total"), F.col("pattern_fraud"),
                                                           n_total, p_total))


def confidence_drop(validated: DataFrame) -> DataFrame:
    """Mean relative confidence drop train -> test over valid patterns."""
    v = validated.filter(F.col("valid") & (F.col("train_confidence") > 0))
    rel = (F.col("train_confidence") - F.col("test_confidence")) / F.col("train_confidence")
    return v.agg(F.count(F.lit(1)).alias("n_valid"), F.avg(rel).alias("avg_relative_drop"),
                 F.avg(F.col("train_confidence") - F.col("test_confidence")).alias("avg_absolute_drop"))


def validation_long(validated: DataFrame, key: str = "rank") -> DataFrame:
    """One row per (pattern, metric) with train and test values."""
    metrics = ("support", "confidence", "lift")
    return validated.select(key, "pattern_name", "valid", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"train_{m}").alias("train_value"),
                 F.col(f"test_{m}").alias("test_value")) for m in metrics])))


def summary_lines(patterns: DataFrame, source: str, generated: str, top: int = S.SUMMARY_TOP,
                  width: int = S.SUMMARY_NAME_WIDTH) -> DataFrame:
    """K6: the text summary as (line_no, line) rows: a blank line, header, pattern count,
    data source, then the top patterns (name cut to ``width``) and their
    rate in percent with one decimal."""
    spark = patterns.sparkSession
    n = patterns.select(F.count(F.lit(1))).scalar()
    head = spark.range(1).select(F.inline(F.array(
        F.struct(F.lit(0).alias("line_no"), F.lit("").alias("line")),
        F.struct(F.lit(1).alias("line_no"), F.lit(S.SUMMARY_HEADER).alias("line")),
        F.struct(F.lit(2).alias("line_no"), F.lit(S.SUMMARY_GENERATED.format(generated)).alias("line")),
        F.struct(F.lit(3).alias("line_no"), F.lit("").alias("line")),
        F.struct(F.lit(4).alias("line_no"), F.lit(S.SUMMARY_DATASET).alias("line")),
        F.struct(F.lit(5).alias("line_no"), F.concat(F.lit(S.SUMMARY_COUNT), n.cast("string")).alias("line")),
        F.struct(F.lit(6).alias("line_no"), F.lit(S.SUMMARY_SOURCE.format(source)).alias("line")),
        F.struct(F.lit(7).alias("line_no"), F.lit("").alias("line")),
        F.struct(F.lit(8).alias("line_no"), F.lit(S.SUMMARY_TOP_TITLE).alias("line")),
    )))
    mx = F.max("confidence").over(Window.partitionBy())
    top_rows = patterns.filter(F.col("rank") <= top).withColumn("_pct", as_percent(F.col("confidence"), mx))
    body = top_rows.select(F.inline(F.array(
        F.struct((F.lit(10) + F.col("rank") * 3).alias("line_no"),
                 F.format_string(S.SUMMARY_PATTERN_LINE, F.col("rank"),
                                 truncate(F.col("pattern_name"), width)).alias("line")),
        F.struct((F.lit(11) + F.col("rank") * 3).alias("line_no"),
                 F.format_string(S.SUMMARY_RATE_LINE, F.col("_pct")).alias("line")),
        F.struct((F.lit(12) + F.col("rank") * 3).alias("line_no"), F.lit("").alias("line")))))
    return head.unionByName(body)
