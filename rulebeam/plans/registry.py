"""Named queries over the benchmark tables (``queries()`` of the entry file).

Every query reads whole driver tables through a transaction view (``events``;
``li_*``: lineitem joined to orders, customer and part), so its work grows
with the tables. Mining queries build the cell table of both splits in one
scan and write it once to the shared checkpoint folder.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec as S
from ..functions.features import add_features
from ..functions.items import parse_pattern_label, pattern_label
from ..functions.metrics import with_rule_metrics
from ..operators import profile as P
from ..operators import report as R
from ..operators.cells import build_cells, split_cells, total_columns
from ..operators.discovery import false_discovery
from ..operators.domain import item_domain, literal_table, top_values
from ..operators.heavy import heavy_top_values
from ..operators.mine import (extend_patterns, mine_pairs, pair_counts, rank_level, top_n)
from ..operators.validate import funnel, label_report, validate_labels
from ..plans.mining import MiningRun
from ..session import materialize, scratch_path
from ..sinks import writers as K
from ..sinks.publish import Publication
from ..sources.results import read_latest_patterns
from ..sources.transactions import TRANSACTION_SCHEMA, Holdout, event_transactions, read_checked, read_table
from ..spec import event_spec

Query = Callable[[SparkSession, str], DataFrame]

# Patterns given as label text (pattern_metrics_given): text, SQL condition, reason where invalid. The last but one matches
# no row.
GIVEN_PATTERNS = (
    ("time_period=night AND amt_category=very_high", "time_period = 'night' AND amt_category = 'very_high'", None),
    ("category=purchase AND amt_category=high AND gender=M", "category = 'purchase' AND amt_category = 'high' AND gender = 'M'", None),
    ("time_period=night AND amt_category=high AND distance_category=medium_distance",
     "time_period = 'night' AND amt_category = 'high' AND distance_category = 'medium_distance'", None),
    ("is_weekend=1 AND day_of_week=7", "is_weekend = 1 AND day_of_week = 7", None),
    ("age_group=senior AND time_period=morning AND amt_category=low AND is_weekend=0",
     "age_group = 'senior' AND time_period = 'morning' AND amt_category = 'low' AND is_weekend = 0", None),
    ("hour=23 AND time_period=night", "hour = 23 AND time_period = 'night'", None),
    ("is_weekend=01", "is_weekend = 1", None),
    ("nosuch=1", None, "Filter error on condition 1: unknown column nosuch"),
    ("gender=X AND category=view", "gender = 'X' AND category = 'view'", None),
    ("time_period night AND gender=F", None, "Invalid pattern part: time_period night"),
)

# Labels over any column (pattern_metrics_any_column): text, SQL condition, reason where invalid.
ANY_COLUMN_PATTERNS = (
    ("hour=23 AND time_period=night", "hour = 23 AND time_period = 'night'", None),
    ("month=01 AND gender=F", "month = 1 AND gender = 'F'", None),
    ("is_weekend=01", "is_weekend = 1", None),
    ("day_of_week = 7 AND category=purchase AND hour=7", "day_of_week = 7 AND category = 'purchase' AND hour = 7", None),
    ("hour=31", "hour = 31", None),
    ("gender=F AND nosuch=1", None, "Filter error on condition 2: unknown column nosuch"),
    ("day_of_week=x", None, "Filter error on condition 1: malformed value x"),
    ("hour 3 AND gender=F", None, "Invalid pattern part: hour 3"),
    (None, None, "No pattern label"),
)

PATTERN_OUT = ("pattern_name", "level", "pattern_total", "pattern_fraud", "support", "confidence", "lift",
               "score", "level_rank")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_features(event_transactions(spark, sf_dir))


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn(spark, sf_dir).filter(F.col("split") == "train")


def run(spark: SparkSession, sf_dir: str, **spec_kw) -> MiningRun:
    return MiningRun(txn(spark, sf_dir), event_spec(**spec_kw))


# --- features -----------------------------------------------------------------

def q_features_time(spark, sf):
    return txn(spark, sf).select("event_id", "split", "hour", "day_of_week", "month", "is_weekend", "time_period")


def q_features_amount_age(spark, sf):
    return txn(spark, sf).select("event_id", "amt", "amt_category", "age", "age_group")


def q_features_distance(spark, sf):
    return txn(spark, sf).select("event_id", F.round("distance_km", 3).alias("distance_km_3"), "distance_category")


# --- profiling ------------------------------------------------------------------

def q_dataset_shape(spark, sf):
    return P.dataset_shape(txn(spark, sf), by=["split"])


def q_null_profile(spark, sf):
    return P.null_profile(txn(spark, sf), by=["split"])


def q_label_distribution(spark, sf):
    return P.label_distribution(txn(spark, sf), by=["split"])


def q_composition(spark, sf):
    return P.composition(txn(spark, sf), by=["split"])


def _rate_query(feature: str) -> Query:
    def q(spark, sf):
        return P.rate_for_feature(train_rows(spark, sf), feature)
    q.__name__ = f"q_rate_by_feature_{feature}"
    return q


def q_rate_all_features(spark, sf):
    return P.rate_by_feature(train_rows(spark, sf), S.PROFILE_FEATURES, round_to=None)


def q_rate_time_period_series(spark, sf):
    return P.rate_for_feature(train_rows(spark, sf), "time_period", round_to=None)


def q_rate_amount_ordered(spark, sf):
    return P.rate_for_feature(train_rows(spark, sf), "amt_category", round_to=None, order=S.AMOUNT_ORDER)


def q_compare_datasets(spark, sf):
    return P.compare_datasets(txn(spark, sf))


def q_profile_rates_from_cells(spark, sf):
    """Entry point 1's rate table: both splits, rounded, read from the cell table."""
    from .eda import profile
    r = run(spark, sf)
    return profile(r.rows, cells=r.cells).rates


def q_temporal_profile(spark, sf):
    return R.temporal_profile(train_rows(spark, sf))


# --- cells and candidate domains -------------------------------------------------

def q_cells(spark, sf):
    spec = event_spec()
    return build_cells(txn(spark, sf), spec, by=["split"])


def _train_cells(spark, sf):
    spec = event_spec()
    return spec, materialize(split_cells(build_cells(txn(spark, sf), spec, by=["split"]), "train"), "cells")


def q_top_values(spark, sf):
    spec, cells = _train_cells(spark, sf)
    return top_values(cells, spec.features, spec.top_k(2))


def q_top_values_heavy(spark, sf):
    """``top_values`` from summaries of the raw train rows."""
    spec = event_spec()
    return heavy_top_values(train_rows(spark, sf), spec.features, spec.top_k(2))


# Columns of the events themselves: about one value per row, per customer and per day, and a few kinds.
NEAR_UNIQUE = ("event_id", "user_id", "day", "event_type")


def q_top_values_near_unique(spark, sf):
    """The ten most frequent values of columns of any width, from summaries of 64 counters a task."""
    events = read_table(spark, sf, "events").withColumn("day", F.to_date("ts").cast("string"))
    return heavy_top_values(events, NEAR_UNIQUE, 10, counters=64)


def q_item_domain_l2(spark, sf):
    spec, cells = _train_cells(spark, sf)
    return item_domain(cells, spec, 2)


def q_item_domain_l3(spark, sf):
    spec, cells = _train_cells(spark, sf)
    return item_domain(cells, spec, 3)


# --- mining -------------------------------------------------------------------------

def q_pairs_all(spark, sf):
    spec, cells = _train_cells(spark, sf)
    n_total, p_total = total_columns(cells)
    g = pair_counts(cells, spec)
    return with_rule_metrics(g, "pattern_total", "pattern_fraud", n_total, p_total).drop("ia", "ib")


def q_pairs_grouping_sets(spark, sf):
    """The same pair counts as one GROUPING SETS aggregate over the cells in Spark SQL."""
    spec = event_spec()
    cells = split_cells(build_cells(txn(spark, sf), spec, by=["split"]), "train")
    feats = spec.features
    sets = ", ".join(f"({a}, {b})" for i, a in enumerate(feats) for j, b in enumerate(feats) if i < j)

    def pick(order):
        name = " ".join(f"WHEN grouping({f}) = 0 THEN '{f}'" for f in order)
        val = " ".join(f"WHEN grouping({f}) = 0 THEN CAST({f} AS STRING)" for f in order)
        return f"CASE {name} END", f"CASE {val} END"

    fa, va = pick(feats)
    fb, vb = pick(tuple(reversed(feats)))
    return spark.sql(f"""
        SELECT {fa} AS fa, {va} AS va, {fb} AS fb, {vb} AS vb,
               sum(n) AS pattern_total, sum(p) AS pattern_fraud
        FROM {{cells}}
        GROUP BY GROUPING SETS ({sets})""", cells=cells)


def q_pairs_kept(spark, sf):
    spec, cells = _train_cells(spark, sf)
    n_total, p_total = total_columns(cells)
    lv = rank_level(mine_pairs(cells, spec, n_total, p_total), spec)
    return lv.select(pattern_label(F.col("items")).alias("pattern_name"), *PATTERN_OUT[1:])


def _extend(level: int) -> Query:
    def q(spark, sf):
        spec, cells = _train_cells(spark, sf)
        n_total, p_total = total_columns(cells)
        lv = materialize(rank_level(mine_pairs(cells, spec, n_total, p_total), spec))
        for k in range(3, level + 1):
            lv = materialize(rank_level(extend_patterns(cells, lv.filter(F.col("level_rank") <= spec.beam),
                                                        spec, k, n_total, p_total), spec))
        return lv.select(pattern_label(F.col("items")).alias("pattern_name"), *PATTERN_OUT[1:])
    q.__name__ = f"q_extend_l{level}"
    return q


def q_patterns_ranked(spark, sf):
    return run(spark, sf).patterns.select(*PATTERN_OUT, "rank", "pattern_type")


def q_wide_patterns_ranked(spark, sf):
    """Mining with a feature of about one value per customer."""
    return run(spark, sf, features=S.WIDE_FEATURES).patterns.select(*PATTERN_OUT, "rank", "pattern_type")


def q_patterns_top15(spark, sf):
    r = run(spark, sf)
    return K.to_export_shape(r.top)


def q_min_lift(spark, sf):
    r = run(spark, sf, min_lift=S.DOCUMENTED_MIN_LIFT)
    return r.patterns.select(*PATTERN_OUT, "rank")


def q_pattern_metrics_given(spark, sf):
    labels = literal_table(spark, [(i + 1, t) for i, (t, _, _) in enumerate(GIVEN_PATTERNS)],
                           "pattern_id int, pattern_name string")
    return validate_labels(labels, train_rows(spark, sf), event_spec())


def q_pattern_metrics_any_column(spark, sf):
    """Labels over any column of the enhanced train table, with a reason for each that fails."""
    labels = literal_table(spark, [(i + 1, t) for i, (t, _, _) in enumerate(ANY_COLUMN_PATTERNS)],
                           "pattern_id int, pattern_name string")
    return validate_labels(labels, train_rows(spark, sf), event_spec())


# --- validation -----------------------------------------------------------------------

def q_pattern_funnel(spark, sf):
    r = run(spark, sf)
    return funnel(r.test_cells, top_n(r.patterns, r.spec.validate_n), r.spec)


# Conditions of the labels of label_trie_funnel, in order.
TRIE_FEATURES = ("time_period", "category", "hour", "gender", "month")


def trie_labels(train: DataFrame) -> DataFrame:
    """Label text for each combination of ``TRIE_FEATURES`` in the train rows (hours with two digits), and
    two labels per category that no table can answer."""
    texts = [F.lpad(F.col(f).cast("string"), 2, "0") if f == "hour" else F.col(f).cast("string") for f in TRIE_FEATURES]
    items = F.array(*[F.struct(F.lit(f).alias("feature"), t.alias("value")) for f, t in zip(TRIE_FEATURES, texts)])
    good = train.select(*TRIE_FEATURES).distinct().select(pattern_label(items).alias("pattern_name"))
    kinds = train.select("category").distinct()
    wrong = kinds.select(F.explode(F.array(
        F.concat(F.lit("time_period=night AND merchant="), "category"),
        F.concat(F.lit("time_period=night AND hour="), "category"))).alias("pattern_name"))
    return good.unionByName(wrong)


def q_label_trie_funnel(spark, sf):
    """Funnel and validation on the test rows of every label found in the train rows."""
    rows = txn(spark, sf)
    report = label_report(trie_labels(rows.where("split = 'train'")), rows.where("split = 'test'"), event_spec(), "pattern_name")
    return report.select("pattern_name", F.posexplode_outer("after").alias("step", "rows_left"), "pattern_total", "pattern_fraud",
                         "score", "valid", "reason").withColumn("step", F.col("step") + 1)


# Values that a label must escape, for each event type.
AWKWARD_VALUES = (("purchase", "a=b AND c"), ("error", "back\\slash\\"), ("view", " AND "), ("click", "AND=, \"x\""), ("signup", " two  "))


def awkward_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enhanced rows with categories that hold separators, escapes, quotes and spaces at the ends."""
    case = F.lit(None).cast("string")
    for plain, awkward in AWKWARD_VALUES:
        case = F.when(F.col("category") == plain, awkward).otherwise(case)
    return txn(spark, sf_dir).withColumn("category", case)


def awkward_spec():
    return event_spec().with_(domains={k: {f: v for f, v in d.items() if f != "category"} for k, d in S.EVENT_DOMAINS.items()})


def q_labels_round_trip(spark, sf):
    """Patterns with such values, exported as text, read again, and their labels parsed to items."""
    from .mining import export
    r = MiningRun(awkward_transactions(spark, sf), awkward_spec())
    out = scratch_path(spark, "results")
    export(r, out)
    again = read_latest_patterns(spark, out, prefer="all").select("Rank", parse_pattern_label(F.col("Pattern_Name")).alias("parsed"))
    each = again.select(F.col("Rank").alias("rank"), F.posexplode("parsed.items").alias("i", "item"))
    return each.select("rank", (F.col("i") + 1).alias("position"), "item.feature", "item.value")


VALIDATION_OUT = ("rank", "pattern_name", "valid", "reason", "train_pattern_total", "train_pattern_fraud",
                  "train_support", "train_confidence", "train_lift", "test_pattern_total", "test_pattern_fraud",
                  "test_support", "test_confidence", "test_lift", "support_diff", "confidence_diff", "lift_diff",
                  "stable", "status")


def q_validate_top10(spark, sf):
    return run(spark, sf).validated.select(*VALIDATION_OUT)


def q_stability_top10(spark, sf):
    return K.to_validation_shape(run(spark, sf).validated)


# --- reports ------------------------------------------------------------------------------

def q_pattern_counts(spark, sf):
    return R.pattern_counts(run(spark, sf).patterns)


def q_pattern_type_counts(spark, sf):
    return R.pattern_type_counts(run(spark, sf).patterns)


def q_pattern_summary(spark, sf):
    s = R.pattern_summary(run(spark, sf).patterns)
    return s.select("n_patterns", F.round("avg_confidence_pct", 9).alias("avg_confidence_pct"),
                    "max_confidence_pct")


def q_run_summary(spark, sf):
    return run(spark, sf).summary()


def q_report_table(spark, sf):
    return R.report_table(run(spark, sf).patterns)


def q_pattern_labels(spark, sf):
    return R.pattern_labels(run(spark, sf).patterns)


def q_feature_matrix(spark, sf):
    return R.feature_matrix(run(spark, sf).patterns)


def q_feature_importance(spark, sf):
    f = R.feature_importance(run(spark, sf).patterns)
    return f.withColumn("avg_score", F.round("avg_score", 12))


def q_significance(spark, sf):
    r = run(spark, sf)
    return R.significance(r.top, r.train_cells).select("rank", "pattern_name", "pattern_total", "pattern_fraud",
                                                      "confidence", "z_score")


def q_false_discovery(spark, sf):
    """Exact p and q values of all patterns kept."""
    r = run(spark, sf)
    found = false_discovery(r.patterns, r.train_cells, base=r.workdir)
    return found.select("rank", "pattern_name", "pattern_total", "pattern_fraud",
                        F.round(F.col("log_p") / F.log(F.lit(10.0)), 6).alias("log10_p"),
                        F.round(F.col("log_q") / F.log(F.lit(10.0)), 6).alias("log10_q"), "significant")


def q_confidence_drop(spark, sf):
    d = R.confidence_drop(run(spark, sf).validated)
    return d.select("n_valid", F.round("avg_relative_drop", 12).alias("avg_relative_drop"),
                    F.round("avg_absolute_drop", 12).alias("avg_absolute_drop"))


def q_validation_long(spark, sf):
    return R.validation_long(run(spark, sf).validated)


def q_chart_summary_exported(spark, sf):
    """C8 on the exported column names (Confidence as a 0-1 column)."""
    from ..operators.charts import chart_summary
    s = chart_summary(K.to_export_shape(run(spark, sf).patterns))
    return s.select("n_patterns", F.round("avg_confidence_pct", 9).alias("avg_confidence_pct"),
                    "max_confidence_pct")


def q_chart_total_only(spark, sf):
    """A pattern table without any confidence column gives the count only."""
    from ..operators.charts import chart_summary
    exported = K.to_export_shape(run(spark, sf).patterns).drop("Confidence", "Fraud_Rate_Percent")
    return chart_summary(exported)


# --- order-line binding (lineitem x orders x customer x part) ----------------------

def li_run(spark: SparkSession, sf_dir: str, **spec_kw) -> MiningRun:
    from ..sources.transactions import lineitem_transactions
    from ..spec import lineitem_spec
    return MiningRun(lineitem_transactions(spark, sf_dir), lineitem_spec(**spec_kw))


def q_li_cells(spark, sf):
    r = li_run(spark, sf)
    return build_cells(r.rows, r.spec, by=["split"])


def q_li_patterns_ranked(spark, sf):
    return li_run(spark, sf).patterns.select(*PATTERN_OUT, "rank", "pattern_type")


def q_li_validate_top10(spark, sf):
    return li_run(spark, sf).validated.select(*VALIDATION_OUT)


def q_li_rate_all_features(spark, sf):
    r = li_run(spark, sf)
    return P.rate_by_feature(r.train_cells, S.LINEITEM_FEATURES, round_to=None)


def q_summary_lines(spark, sf):
    return R.summary_lines(run(spark, sf).patterns, source="patterns", generated="run")


def q_export_roundtrip(spark, sf):
    """K1-K5 + S3/S4: write all result tables of a run, reload the newest
    top-N table."""
    r = run(spark, sf)
    base = scratch_path(spark, "results")
    run_id = K.new_run_id()
    K.write_patterns(r.patterns, base, run_id, r.spec.top_n)
    K.write_validation(r.validated, base, run_id)
    K.write_summary(r.summary(run_id), base, run_id)
    return read_latest_patterns(spark, base).drop("kind", "run_id")


def q_results_published(spark, sf):
    """Two runs of one second and one that dies half-way: the newest committed top-N table is read."""
    r = run(spark, sf)
    base = scratch_path(spark, "results")
    first, second = sorted((K.new_run_id(), K.new_run_id()))
    K.write_patterns(r.patterns.where("rank <= 3"), base, first, r.spec.top_n)
    K.write_patterns(r.patterns, base, second, r.spec.top_n)
    try:
        with Publication(spark, base, K.new_run_id()) as out:
            K.stage_patterns(out, r.patterns.where("rank = 1"), r.spec.top_n)
            raise InterruptedError("the run dies before its manifest")
    except InterruptedError:
        pass
    return read_latest_patterns(spark, base).where(F.col("run_id") == second).drop("kind", "run_id")


def q_export_all_patterns(spark, sf):
    """K1: the file of all patterns as written, read again."""
    r = run(spark, sf)
    base = scratch_path(spark, "results")
    K.write_patterns(r.patterns, base, K.new_run_id(), r.spec.top_n)
    return read_latest_patterns(spark, base, prefer="all").drop("kind", "run_id")


def q_export_validation(spark, sf):
    """K3: the validation file as written, where the test rows of one gender are missing, so that some patterns
    fail (metrics ``N/A``); numbers as numbers, other text beside them."""
    rows = txn(spark, sf).where("split = 'train' OR gender <> 'M'")
    r = MiningRun(rows, event_spec(validate_n=S.TOP_N))
    base = scratch_path(spark, "results")
    path = K.write_validation(r.validated, base, K.new_run_id())
    written = spark.read.options(**S.CSV_TEXT).csv(path)
    out = [F.col("Pattern_ID").cast("int").alias("Pattern_ID"), "Pattern_Name", "Status", "Valid"]
    for c in K.VALIDATION_COLUMNS[2:8]:
        number = F.col(c).try_cast("double")
        out += [number.alias(c), F.when(number.isNull(), F.col(c)).alias(f"{c}_text")]
    return written.select(*out)


def q_predicate_counts(spark, sf):
    """Typed filters of literal patterns over the train rows, all counted in one pass."""
    from ..functions.items import items_to_predicate
    rows = train_rows(spark, sf)
    counts = [F.struct(F.lit(i + 1).alias("pattern_id"), F.count_if(items_to_predicate(p, rows.schema)).alias("n"),
                       F.count_if(items_to_predicate(p, rows.schema) & (F.col("is_fraud") == 1)).alias("p"))
              for i, (p, _) in enumerate(PREDICATES)]
    return rows.agg(F.array(*counts).alias("found")).select(F.inline("found"))


# Literal items and their SQL condition (predicate_counts).
PREDICATES = (
    ((("is_weekend", "01"), ("time_period", " night ")), "is_weekend = 1 AND time_period = 'night'"),
    ((("hour", "7"), ("gender", "F"), ("category", "purchase")), "hour = 7 AND gender = 'F' AND category = 'purchase'"),
    ((("month", "x"),), "false"),
    ((("amt", "0"),), "amt = 0"),
)


FIXED_RUN_ID = "20240101_000000"


def _files_run(spark, sf):
    """The run of two CSV files with an unnamed index column."""
    from .mining import run_from_files
    base = scratch_path(spark, "csv")
    t = event_transactions(spark, sf)
    columns = [f.name for f in TRANSACTION_SCHEMA.fields]
    for split in ("train", "test"):
        (t.where(F.col("split") == split).select(F.col("event_id").alias(""), *columns)
         .write.option("header", True).csv(f"{base}/{split}"))
    return run_from_files(spark, f"{base}/train", f"{base}/test", event_spec()), f"{base}/results"


def q_files_patterns_top15(spark, sf):
    """CSV files in, CSV results out, newest result read again."""
    from .mining import export
    r, out = _files_run(spark, sf)
    export(r, out, FIXED_RUN_ID)
    return read_latest_patterns(spark, out).drop("kind", "run_id")


def q_files_summary(spark, sf):
    """K4 as written: every metric as number, the run stamp as text."""
    from .mining import export
    r, out = _files_run(spark, sf)
    export(r, out, FIXED_RUN_ID)
    s = spark.read.option("header", True).csv(f"{out}/kind=summary/run_id={FIXED_RUN_ID}")
    number = F.col("Value").try_cast("double")
    return s.select("Metric", number.alias("number"), F.when(number.isNull(), F.col("Value")).alias("text"))


# Every how many-th event is written once more as a bad record, by kind (files_with_rejects).
BAD_NUMBER, BAD_DATE, SHORT_ROW = 97, 101, 103


def _rejects_run(spark, sf):
    """The files of ``_files_run`` with bad records among the good ones: numbers and dates that are none, and
    rows with too few fields. (Checked train file, checked test file)."""
    base = scratch_path(spark, "csv")
    t = event_transactions(spark, sf)
    columns = [f.name for f in TRANSACTION_SCHEMA.fields]
    every = t.select("split", "event_id", *[F.col(c).cast("string").alias(c) for c in columns])
    nth = F.col("event_id")
    bad_number = every.where(nth % BAD_NUMBER == 0).withColumn("amt", F.concat(F.lit("USD "), "amt"))
    bad_date = every.where(nth % BAD_DATE == 0).withColumn("dob", F.lit("1980-13-45"))
    line = F.concat_ws(",", F.col("event_id"), *[F.coalesce(c, F.lit("")) for c in columns])
    short = every.where(nth % SHORT_ROW == 0).select("split", F.concat_ws(",", "event_id", "category").alias("line"))
    lines = every.unionByName(bad_number).unionByName(bad_date).select("split", line.alias("line")).unionByName(short)
    # Eight files a side, each with its header first.
    lines = lines.select("split", F.pmod(F.xxhash64("line"), F.lit(8)).alias("part"), F.lit(1).alias("at"), "line")
    sides = spark.createDataFrame([("train",), ("test",)], "split string")
    heads = (sides.join(spark.range(8).select(F.col("id").alias("part")))
             .select("split", "part", F.lit(0).alias("at"), F.lit(",".join(["", *columns])).alias("line")))
    (lines.unionByName(heads).repartition("split", "part").sortWithinPartitions("split", "part", "at")
     .select("split", "part", "line").write.partitionBy("split", "part").text(f"{base}/in"))
    return [read_checked(spark, f"{base}/in/split={s}/part=*") for s in ("train", "test")], base


def q_files_with_rejects(spark, sf):
    """Patterns of files with bad records: those of the good records alone."""
    checked, _ = _rejects_run(spark, sf)
    train, test = (c.within(0.05).rows for c in checked)
    return K.to_export_shape(MiningRun(add_features(Holdout(train, test).stacked()), event_spec()).top)


def q_files_rejects(spark, sf):
    """The rejected records of these files."""
    checked, _ = _rejects_run(spark, sf)
    both = checked[0].rejects.withColumn("split", F.lit("train")).unionByName(checked[1].rejects.withColumn("split", F.lit("test")))
    return both.select("split", "row", F.col("column").alias("column_name"), "text", "reason")


def _observed_run(spark, sf):
    return MiningRun(txn(spark, sf), event_spec(), observe=True)


def q_dataset_shape_observed(spark, sf):
    """G1 from the scan that builds the cells."""
    r = _observed_run(spark, sf)
    assert r.observed.agrees_with(r.cells)
    return r.observed.dataset_shape()


def q_null_profile_observed(spark, sf):
    """G2 from the scan that builds the cells."""
    r = _observed_run(spark, sf)
    assert r.observed.agrees_with(r.cells)
    return r.observed.null_profile()


def q_label_distribution_observed(spark, sf):
    """G3/C1 of the one-scan profile."""
    from .eda import profile_run
    return profile_run(_observed_run(spark, sf)).class_balance


def q_streaming_cells(spark, sf):
    from ..streaming.cells import stream_cells_once
    return stream_cells_once(spark, sf, event_spec())


def all_queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "features_time": q_features_time,
        "features_amount_age": q_features_amount_age,
        "features_distance": q_features_distance,
        "dataset_shape": q_dataset_shape,
        "null_profile": q_null_profile,
        "label_distribution": q_label_distribution,
        "composition": q_composition,
    }
    for f in S.PROFILE_FEATURES:
        q[f"rate_by_feature_{f}"] = _rate_query(f)
    q.update({
        "rate_all_features": q_rate_all_features,
        "rate_time_period_series": q_rate_time_period_series,
        "rate_amount_ordered": q_rate_amount_ordered,
        "compare_datasets": q_compare_datasets,
        "temporal_profile": q_temporal_profile,
        "profile_rates_from_cells": q_profile_rates_from_cells,
        "cells": q_cells,
        "top_values": q_top_values,
        "item_domain_l2": q_item_domain_l2,
        "item_domain_l3": q_item_domain_l3,
        "pairs_all": q_pairs_all,
        "pairs_grouping_sets": q_pairs_grouping_sets,
        "pairs_kept": q_pairs_kept,
        "extend_l3": _extend(3),
        "extend_l4": _extend(4),
        "patterns_ranked": q_patterns_ranked,
        "wide_patterns_ranked": q_wide_patterns_ranked,
        "patterns_top15": q_patterns_top15,
        "min_lift": q_min_lift,
        "pattern_metrics_given": q_pattern_metrics_given,
        "pattern_metrics_any_column": q_pattern_metrics_any_column,
        "pattern_funnel": q_pattern_funnel,
        "label_trie_funnel": q_label_trie_funnel,
        "labels_round_trip": q_labels_round_trip,
        "validate_top10": q_validate_top10,
        "stability_top10": q_stability_top10,
        "pattern_counts": q_pattern_counts,
        "pattern_type_counts": q_pattern_type_counts,
        "pattern_summary": q_pattern_summary,
        "run_summary": q_run_summary,
        "report_table": q_report_table,
        "pattern_labels": q_pattern_labels,
        "feature_matrix": q_feature_matrix,
        "feature_importance": q_feature_importance,
        "significance": q_significance,
        "false_discovery": q_false_discovery,
        "confidence_drop": q_confidence_drop,
        "validation_long": q_validation_long,
        "chart_summary_exported": q_chart_summary_exported,
        "chart_total_only": q_chart_total_only,
        "li_cells": q_li_cells,
        "li_patterns_ranked": q_li_patterns_ranked,
        "li_validate_top10": q_li_validate_top10,
        "li_rate_all_features": q_li_rate_all_features,
        "summary_lines": q_summary_lines,
        "export_roundtrip": q_export_roundtrip,
        "files_patterns_top15": q_files_patterns_top15,
        "files_summary": q_files_summary,
        "files_with_rejects": q_files_with_rejects,
        "files_rejects": q_files_rejects,
        "results_published": q_results_published,
        "export_all_patterns": q_export_all_patterns,
        "export_validation": q_export_validation,
        "predicate_counts": q_predicate_counts,
        "dataset_shape_observed": q_dataset_shape_observed,
        "null_profile_observed": q_null_profile_observed,
        "label_distribution_observed": q_label_distribution_observed,
        "top_values_heavy": q_top_values_heavy,
        "top_values_near_unique": q_top_values_near_unique,
        "streaming_cells": q_streaming_cells,
    })
    return q
