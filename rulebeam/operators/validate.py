"""Re-measure patterns on another cell table.

A pattern table of ours is evaluated by a hash join of the cells on one item plus a
containment test, then a group-by per pattern; funnels and imported labels walk a prefix trie
(``label_trie``). No per-pattern jobs.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.items import parse_pattern_label
from ..functions.metrics import rule_metrics
from .. import spec as S
from ..session import materialize
from ..spec import PatternSpec
from .cells import build_cells, total_columns
from .label_trie import funnel_counts
from .mine import match_patterns
from .profile import is_cells

NO_MATCH = S.REASON_NO_MATCH


def pattern_metrics(cells: DataFrame, patterns: DataFrame, spec: PatternSpec, key: str = "rank",
                    items_col: str = "items", bounded: bool = False) -> DataFrame:
    """G9 for a (small) table of patterns: key, pattern_total, pattern_fraud,
    support, confidence, lift, score. Patterns matching no row have no output
    row (left-join the result to keep them)."""
    n_total, p_total = total_columns(cells)
    m = match_patterns(cells, spec, patterns.select(key, items_col), items_col, bounded)
    g = m.groupBy(key).agg(F.sum("n").alias("pattern_total"), F.sum("p").alias("pattern_fraud"))
    met = rule_metrics(F.col("pattern_total"), F.col("pattern_fraud"), n_total, p_total)
    return g.withColumns({k: met[k] for k in ("support", "confidence", "lift", "score")})


def validate(train_patterns: DataFrame, test_cells: DataFrame, spec: PatternSpec,
             key: str = "rank", dataset: str = "Test", bounded: bool = False) -> DataFrame:
    """Train metrics next to test metrics, one row per pattern.

    ``valid`` means at least one matching test row; otherwise ``reason`` says
    why and the test columns are null. Differences are absolute.
    """
    test = pattern_metrics(test_cells, train_patterns, spec, key, bounded=bounded)
    test = test.select(key, *[F.col(c).alias(f"test_{c}") for c in
                              ("pattern_total", "pattern_fraud", "support", "confidence", "lift")])
    t = train_patterns.select(key, "pattern_name", "items",
                              *[F.col(c).alias(f"train_{c}") for c in
                                ("pattern_total", "pattern_fraud", "support", "confidence", "lift")])
    j = t.join(test, key, "left")
    valid = F.col("test_pattern_total").isNotNull() & (F.col("test_pattern_total") > 0)
    return j.withColumns({
        "dataset": F.lit(dataset),
        "valid": valid,
        "reason": F.when(~valid, F.lit(NO_MATCH)),
        "support_diff": F.abs(F.col("test_support") - F.col("train_support")),
        "confidence_diff": F.abs(F.col("test_confidence") - F.col("train_confidence")),
        "lift_diff": F.abs(F.col("test_lift") - F.col("train_lift")),
    })


def stability(validated: DataFrame, spec: PatternSpec) -> DataFrame:
    """M6: STABLE when valid and every difference is strictly below its
    tolerance, UNSTABLE when valid otherwise, FAILED when not valid."""
    ts, tc, tl = spec.tolerances
    stable = (F.col("valid") & (F.col("support_diff") < ts) & (F.col("confidence_diff") < tc)
              & (F.col("lift_diff") < tl))
    return validated.withColumns({
        "stable": F.coalesce(stable, F.lit(False)),
        "status": F.when(~F.col("valid"), S.STATUS_FAILED).when(stable, S.STATUS_STABLE)
                   .otherwise(S.STATUS_UNSTABLE),
    })


def label_report(labels: DataFrame, rows: DataFrame, spec: PatternSpec, key: str = "pattern_id",
                 label_col: str = "pattern_name") -> DataFrame:
    """M5/F9/P16 for imported label text over any column of ``rows``: the key and the label, after (rows left
    after each condition), pattern_total, pattern_fraud, support, confidence, lift, score, valid, reason.

    Values are compared in the column's own type (``hour=07`` is hour 7). The rows are aggregated
    once by the columns that some label names; the labels are a trie (``label_trie``), so their number is not limited and
    a key may repeat. Invalid labels say why: a part without ``=``, an unknown column, a value that is none of the
    column's type, no matching row, or a null label. ``rows`` may be a cell table: it is not aggregated again, its
    columns are the mining features, as text, and any other column is unknown.
    """
    parsed = labels.withColumn("_parsed", parse_pattern_label(F.col(label_col)))
    named_by = list(dict.fromkeys((key, label_col)))  # a label may be its own key
    parsed = materialize(parsed.select(
        *named_by, F.monotonically_increasing_id().alias("_row"), F.col("_parsed.items").alias("items"),
        F.coalesce(F.col("_parsed.ok"), F.lit(False)).alias("parsed_ok"),
        F.coalesce(F.col("_parsed.reason"), F.lit(S.REASON_NULL_LABEL)).alias("parse_reason")), "labels")
    given = is_cells(rows)
    columns = [c for c in rows.columns if c in spec.features] if given else rows.columns
    named = sorted(r[0] for r in parsed.where("parsed_ok").select(F.explode("items.feature")).distinct()
                   .where(F.col("col").isin(columns)).collect())  # at most the columns of rows
    types = {f.name: f.dataType for f in rows.schema.fields}

    def typed(it):
        value = F.lit(None).cast("string")
        for c in named:
            value = F.when(it["feature"] == c, it["value"].try_cast(types[c]).cast("string")).otherwise(value)
        return F.struct(it["feature"].alias("feature"), value.alias("value"))

    items = parsed.withColumn("typed", F.transform("items", typed))
    wrong = F.transform("items", lambda it, i: F.when(
        F.get("typed", i)["value"].isNull(), F.concat(
            F.lit(S.REASON_FILTER_ERROR), (i + 1).cast("string"), F.lit(": "),
            F.when(it["feature"].isin(named), F.concat(F.lit("malformed value "), it["value"]))
            .otherwise(F.concat(F.lit("unknown column "), it["feature"])))))
    items = items.withColumn("wrong", F.get(F.filter(wrong, lambda w: w.isNotNull()), F.lit(0)))
    known = items.where("parsed_ok AND wrong IS NULL").select("_row", F.col("typed").alias("items"))
    over = replace(spec, features=tuple(named or columns[:1]), label="_label")
    if not given:  # the label may be a named column too
        rows = materialize(build_cells(rows.withColumn("_label", F.col(spec.label)), over), "label-cells")
    cells = rows
    n_total, p_total = total_columns(cells)
    found = funnel_counts(cells, over, known, "_row").withColumns(
        {"pattern_total": F.when(F.col("n") > 0, F.col("n")), "pattern_fraud": F.when(F.col("n") > 0, F.col("p"))})
    met = rule_metrics(F.col("pattern_total"), F.col("pattern_fraud"), n_total, p_total)
    matched = F.col("pattern_total").isNotNull()
    found = found.withColumns({k: F.when(matched, met[k]) for k in ("support", "confidence", "lift", "score")})
    out = items.join(found, "_row", "left")
    return out.select(*named_by, "after", "pattern_total", "pattern_fraud", "support", "confidence", "lift", "score",
                      matched.alias("valid"),
                      F.when(~F.col("parsed_ok"), F.col("parse_reason")).when(F.col("wrong").isNotNull(), F.col("wrong"))
                      .when(~matched, F.lit(NO_MATCH)).alias("reason"))


def validate_labels(labels: DataFrame, rows: DataFrame, spec: PatternSpec, key: str = "pattern_id",
                    label_col: str = "pattern_name") -> DataFrame:
    """M5 for imported label text: ``label_report`` without the funnel."""
    return label_report(labels, rows, spec, key, label_col).drop("after")


validate_labels_on_rows = validate_labels  # the earlier name


def funnel(cells: DataFrame, patterns: DataFrame, spec: PatternSpec, key: str = "rank") -> DataFrame:
    """rows left after each successive item condition, for every pattern
    in one walk of their trie: ``after_k`` = rows matching the first k items (null where the
    pattern has fewer than k items). ``key`` names a pattern."""
    found = funnel_counts(cells, spec, patterns.select(key, "items"), key).select(key, "after")
    out = patterns.select(key, "pattern_name").join(found, key, "left")
    return out.select(key, "pattern_name", *[F.get("after", F.lit(k - 1)).cast("bigint").alias(f"after_{k}")
                                             for k in range(1, spec.max_len + 1)])
