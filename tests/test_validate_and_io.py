"""Validation failure paths, label parsing, thresholds, sinks round trip,
streaming cells, profiling edge cases."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from conftest import SF001, SF01
from rulebeam import spec as S
from rulebeam.functions.items import items_to_predicate, parse_pattern_label, readable_label
from rulebeam.operators import profile as P
from rulebeam.operators.cells import build_cells, split_cells
from rulebeam.operators.domain import literal_table
from rulebeam.operators.mine import apply_thresholds
from rulebeam.operators.validate import NO_MATCH, stability, validate, validate_labels
from rulebeam.plans.registry import run, txn
from rulebeam.spec import event_spec
from rulebeam.functions.features import add_features


def test_parse_label(spark):
    df = spark.createDataFrame([("a=1 AND b = x=y",), ("a=1 AND bad",)], "t string")
    r = df.select(parse_pattern_label(F.col("t")).alias("p")).collect()
    assert r[0].p.ok and [(i.feature, i.value) for i in r[0].p["items"]] == [("a", "1"), ("b", "x=y")]
    assert not r[1].p.ok and r[1].p.reason == "Invalid pattern part: bad" and r[1].p["items"] is None


def test_readable_label(spark):
    long = " AND ".join(f"feature_{i}=value_{i}" for i in range(6))
    df = spark.createDataFrame([("a=1 AND b=2",), (long,)], "t string")
    r = [x[0] for x in df.select(readable_label(F.col("t"))).collect()]
    assert r[0] == "a: 1 & b: 2"
    assert len(r[1]) == 80 and r[1].endswith("...")


def test_typed_predicate(spark):
    df = spark.createDataFrame([(0, "night"), (1, "night")], "is_weekend int, time_period string")
    cond = items_to_predicate([("is_weekend", "0"), ("time_period", " night ")], df.schema)
    assert df.filter(cond).count() == 1
    assert df.filter(items_to_predicate([("is_weekend", "01")], df.schema)).count() == 1
    assert df.filter(items_to_predicate([("is_weekend", "x")], df.schema)).count() == 0  # no error, no match
    with pytest.raises(ValueError, match="unknown column nosuch"):
        items_to_predicate([("nosuch", "1")], df.schema)


def test_labels_over_any_column_of_odd_tables(spark):
    from rulebeam.operators.validate import validate_labels_on_rows
    rows = spark.createDataFrame([(1, 7, 1.5, "x=y AND z"), (0, 7, None, None), (None, 8, 1.5, "b")],
                                 "is_fraud int, h int, `a b` double, s string")
    labels = spark.createDataFrame([(1, "h=07 AND a b=1.50"), (2, "is_fraud=1"), (3, "s=b AND h=8"), (4, "h=9"),
                                    (5, ""), (6, None), (7, "h=7 AND h=7"), (7, "a b=zz")], "pattern_id int, pattern_name string")
    r = [(x.pattern_id, x.valid, x.reason, x.pattern_total) for x in
         validate_labels_on_rows(labels.where("pattern_id < 7"), rows, event_spec()).orderBy("pattern_id").collect()]
    assert r == [(1, True, None, 1), (2, True, None, 1), (3, True, None, 1), (4, False, NO_MATCH, None),
                 (5, False, "Invalid pattern part: ", None), (6, False, "No pattern label", None)]
    assert validate_labels_on_rows(labels.limit(0), rows, event_spec()).count() == 0


def test_labels_sharing_a_frequent_item_meet_few_cells(spark):
    """Thousands of labels that start with the same item join on their rarest one."""
    from rulebeam.operators.mine import match_rarest_item
    from dataclasses import replace
    cells = spark.range(4000).selectExpr("'F' AS gender", "CAST(id AS STRING) AS who", "1L AS n", "0L AS p")
    labels = spark.range(3000).selectExpr(
        "CAST(id AS INT) AS rank", "array(named_struct('feature', 'gender', 'value', 'F'), "
        "named_struct('feature', 'who', 'value', CAST(id AS STRING))) AS items")
    spec = replace(event_spec(), features=("gender", "who"))
    assert match_rarest_item(cells, spec, labels).count() == 3000


def test_support_of_levels_beyond_the_configured_ones(spark):
    df = spark.createDataFrame([(0.0001, 0.5, 9.0), (0.0005, 0.5, 9.0)], "support double, confidence double, lift double")
    assert apply_thresholds(df, event_spec(), 5).count() == 1


def test_empty_test_split_gives_zero_metrics(spark):
    from rulebeam.plans.mining import MiningRun
    r = MiningRun(txn(spark, SF001).where("split = 'train'"), event_spec())
    kpis = {x.metric: x.value for x in r.summary().collect()}
    assert len(kpis) == 8 and None not in kpis.values() and kpis["Total_Test_Transactions"] == 0.0
    none = MiningRun(txn(spark, SF001).limit(0), event_spec())
    assert [x.value for x in none.summary().collect()] == [0.0] * 8


def test_streaming_reads_a_folder_of_files(spark, tmp_path):
    from rulebeam.sources.transactions import read_table
    from rulebeam.streaming.cells import stream_cells_once
    spec = event_spec()
    read_table(spark, SF001, "events").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    s = stream_cells_once(spark, str(tmp_path), spec)
    b = build_cells(txn(spark, SF001), spec, by=["split"])
    assert sorted(map(tuple, s.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))


def test_report_on_every_output_form(spark, run01, tmp_path):
    from rulebeam.plans.reporting import report
    from rulebeam.sinks import writers as K
    base = str(tmp_path / "csv")
    K.write_patterns(run01.patterns, base, "20240101_000000", 15)
    want = [tuple(r) for r in report(spark, base, "now").patterns.orderBy("rank").collect()]
    assert len(want) == 15
    pq = str(tmp_path / "pq")
    K.write_patterns(run01.patterns, pq, "20240101_000000", 15, fmt="parquet")
    assert [tuple(r) for r in report(spark, pq, "now", fmt="parquet").patterns.orderBy("rank").collect()] == want
    shaped = K.to_export_shape(run01.top)
    swapped = str(tmp_path / "swapped")
    K.write_result(shaped.select(*reversed(shaped.columns)), swapped, "top", "20240101_000000")
    assert [tuple(r) for r in report(spark, swapped, "now").patterns.orderBy("rank").collect()] == want
    rate = str(tmp_path / "rate")  # P24: the rate column stands in for a missing confidence
    K.write_result(shaped.drop("Confidence"), rate, "top", "20240101_000000")
    got = report(spark, rate, "now")
    assert [r.confidence for r in got.patterns.orderBy("rank").collect()] == [
        r.Fraud_Rate_Percent for r in shaped.orderBy("Rank").collect()]
    assert got.text.count() == 9 + 15
    count = str(tmp_path / "count")  # C9, and a table that is no pattern data is passed over
    K.write_result(shaped.drop("Confidence", "Fraud_Rate_Percent"), count, "all", "20240101_000000")
    K.write_result(spark.createDataFrame([(1,)], "x int"), count, "top", "20240101_000000")
    only = report(spark, count, "now")
    assert only.top_patterns is None and only.text is None and only.summary.collect()[0].n_patterns == 15
    broken = str(tmp_path / "broken")
    K.write_result(shaped.withColumn("Rank", F.lit("x")), broken, "top", "20240101_000000")
    with pytest.raises(ValueError, match="rows without rank"):
        report(spark, broken, "now")


def test_thresholds_inclusive(spark):
    df = spark.createDataFrame([(0.0005, 0.02, 1.0), (0.00049, 0.5, 1.0), (0.001, 0.0199, 1.0)],
                               "support double, confidence double, lift double")
    spec = event_spec()
    assert apply_thresholds(df, spec, 2).count() == 1
    assert apply_thresholds(df, spec, 3).count() == 3


def test_stability_tolerances_strict(spark):
    spec = event_spec()
    df = spark.createDataFrame(
        [(True, 0.002, 0.0, 0.0), (True, 0.0, 0.05, 0.0), (True, 0.0, 0.0, 10.0), (True, 0.0019, 0.049, 9.9),
         (False, None, None, None)],
        "valid boolean, support_diff double, confidence_diff double, lift_diff double")
    st = [r.status for r in stability(df, spec).collect()]
    assert st == ["UNSTABLE", "UNSTABLE", "UNSTABLE", "STABLE", "FAILED"]


def test_validate_missing_and_malformed(spark):
    spec = event_spec()
    cells = split_cells(build_cells(txn(spark, SF001), spec, by=["split"]), "test")
    labels = literal_table(spark, [(1, "gender=X AND category=view"), (2, "time_period night"),
                                   (3, "time_period=night AND gender=F")], "pattern_id int, pattern_name string")
    r = {x.pattern_id: x for x in validate_labels(labels, cells, spec).collect()}
    assert not r[1].valid and r[1].reason == NO_MATCH
    assert not r[2].valid and r[2].reason == "Invalid pattern part: time_period night"
    assert r[3].valid and r[3].reason is None and r[3].pattern_total > 0


def test_validate_absent_pattern_is_failed(spark, run01):
    from rulebeam.operators.mine import top_n
    top = top_n(run01.patterns, 3)
    fake = top.withColumn("items", F.array(F.struct(F.lit("gender").alias("feature"), F.lit("Z").alias("value")),
                                           F.struct(F.lit("category").alias("feature"), F.lit("view").alias("value"))))
    v = stability(validate(fake, run01.test_cells, run01.spec), run01.spec).collect()
    assert all((not r.valid) and r.status == "FAILED" and r.reason == NO_MATCH for r in v)


def test_funnel_monotone(spark, run01):
    from rulebeam.operators.validate import funnel
    from rulebeam.operators.mine import top_n
    for r in funnel(run01.test_cells, top_n(run01.patterns, 10), run01.spec).collect():
        steps = [x for x in (r.after_1, r.after_2, r.after_3, r.after_4) if x is not None]
        assert steps == sorted(steps, reverse=True)


def test_export_roundtrip(spark, run01, tmp_path):
    from rulebeam.sinks import writers as K
    from rulebeam.sources.results import check_columns, read_latest_patterns
    base = str(tmp_path / "results")
    K.write_patterns(run01.patterns, base, "20240101_000000", 15)
    K.write_patterns(run01.patterns.filter("rank <= 3"), base, "20240102_000000", 15)
    K.write_validation(run01.validated, base, "20240102_000000")
    K.write_summary(run01.summary("20240102_000000"), base, "20240102_000000")
    back = read_latest_patterns(spark, base)
    assert check_columns(back)
    assert back.count() == 3 and {r.run_id for r in back.collect()} == {"20240102_000000"}
    val = spark.read.option("header", True).csv(f"{base}/kind=validation")
    assert val.count() == 10 and set(val.columns) >= set(K.VALIDATION_COLUMNS)
    summ = spark.read.option("header", True).csv(f"{base}/kind=summary").collect()
    assert [r.Metric for r in summ][-1] == "Analysis_Timestamp" and len(summ) == 9


def test_streaming_cells_equal_batch(spark):
    from rulebeam.streaming.cells import stream_cells_once
    spec = event_spec()
    s = stream_cells_once(spark, SF001, spec)
    b = build_cells(txn(spark, SF001), spec, by=["split"])
    cols = b.columns
    assert sorted(map(tuple, s.select(*cols).collect())) == sorted(map(tuple, b.collect()))


def test_null_label_rate_is_null(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("b", 0)], "f string, is_fraud int")
    r = {x.value: x for x in P.rate_by_feature(df, ["f"]).collect()}
    assert r["a"].total == 0 and r["a"].fraud_rate is None
    assert r["b"].fraud_rate == 50.0


def test_null_profile_counts_nulls_and_nans(spark):
    df = spark.createDataFrame([(None, float("nan"), ""), ("x", 1.0, None)], "a string, b double, c string")
    r = {x.column: (x.null_count, x.nan_count) for x in P.null_profile(df).collect()}
    assert r == {"a": (1, 0), "b": (0, 1), "c": (1, 0)}
    assert [x.column for x in P.null_profile(df.select("b"), only_nonzero=True).collect()] == []


def test_top_values_null_takes_slot(spark):
    from rulebeam.operators.domain import top_values
    cells = spark.createDataFrame([(None, 10), ("a", 5), ("b", 5), ("c", 1)], "f string, n long")
    r = [(x.value, x.value_rank) for x in top_values(cells, ["f"], 2).orderBy("value_rank").collect()]
    assert r == [("a", 2)]


def test_compare_and_composition(spark):
    c = {r.dataset: r for r in P.compare_datasets(txn(spark, SF01)).collect()}
    assert c["train"].n_rows == 7000 and c["train"].n_fraud == 250
    assert abs(c["train"].rate_diff_abs - abs(c["train"].fraud_rate_pct - c["test"].fraud_rate_pct)) < 1e-12


def test_cells_equal_typed_filter_counts(spark, run01):
    """Cross-plan: test-split counts from cells = typed filter (P16) on rows."""
    from rulebeam.functions.items import items_to_predicate
    rows = run01.rows.filter(F.col("split") == "test")
    for r in run01.validated.collect():
        cond = items_to_predicate([(i.feature, i.value) for i in r["items"]], rows.schema)
        agg = rows.filter(cond).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_fraud") == 1).alias("p")).first()
        assert (agg.n, agg.p) == (r.test_pattern_total, r.test_pattern_fraud)


def test_permuted_itemsets_have_equal_metrics(run01):
    from rulebeam.functions.items import itemset_key
    p = run01.patterns.withColumn("k", itemset_key(F.col("items")))
    g = p.groupBy("k").agg(F.countDistinct("score").alias("s"), F.countDistinct("pattern_total").alias("t"))
    assert g.filter("s > 1 OR t > 1").count() == 0


def test_empty_input_gives_empty_tables(spark):
    from rulebeam.plans.mining import MiningRun
    rows = txn(spark, SF001).limit(0)
    r = MiningRun(rows, event_spec())
    assert r.patterns.count() == 0 and r.validated.count() == 0
    kpis = {x.metric: x.value for x in r.summary().collect()}
    assert kpis["Total_Patterns_Discovered"] == 0.0 and kpis["Best_Pattern_Lift"] == 0.0
    assert kpis["Patterns_Validated"] == 0.0


def test_streaming_cells_incremental_restart(spark, tmp_path):
    """Two file batches, the query stopped and restarted on the same
    checkpoint: the published cells equal the batch cells of all rows."""
    from rulebeam.sources.transactions import read_table
    from rulebeam.streaming.cells import read_cells, stream_cells
    spec = event_spec()
    src, out, state = str(tmp_path / "in"), str(tmp_path / "cells"), str(tmp_path / "state")
    import glob
    import os
    import shutil
    events = read_table(spark, SF001, "events")
    os.makedirs(src)

    def land(part: int, name: str):
        staged = str(tmp_path / f"stage{part}")
        events.filter(F.col("event_id") % 2 == part).coalesce(1).write.parquet(staged)
        for i, f in enumerate(glob.glob(staged + "/*.parquet")):
            shutil.copy(f, f"{src}/{name}-{i}.parquet")

    land(0, "a")
    q = stream_cells(spark, src, spec, out, state, path_glob="*.parquet", schema=events.schema)
    q.awaitTermination()
    first = read_cells(spark, out).agg(F.sum("n")).first()[0]
    land(1, "b")
    q = stream_cells(spark, src, spec, out, state, path_glob="*.parquet", schema=events.schema)
    q.awaitTermination()
    s = read_cells(spark, out)
    b = build_cells(txn(spark, SF001), spec, by=["split"])
    assert first < b.agg(F.sum("n")).first()[0]
    assert sorted(map(tuple, s.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))


def test_read_latest_falls_back_to_all(spark, run01, tmp_path):
    from rulebeam.sinks import writers as K
    from rulebeam.sources.results import read_latest_patterns
    base = str(tmp_path / "r")
    K.write_result(K.to_export_shape(run01.patterns), base, "all", "20240101_000000")
    K.write_summary(run01.summary("20240102_000000"), base, "20240102_000000")
    back = read_latest_patterns(spark, base)
    assert back.count() == run01.patterns.count()
    assert {r.kind for r in back.select("kind").distinct().collect()} == {"all"}


def test_release_deletes_run_folder(spark):
    import os
    r = run(spark, SF001)
    assert r.patterns.count() > 0
    folder = r.workdir.replace("file:", "")
    assert os.path.isdir(folder) and len(os.listdir(folder)) >= 5  # cells, domains, 3 levels, patterns
    assert r.release()
    assert not os.path.exists(folder)


def test_read_transactions_unnamed_index(spark, tmp_path):
    from rulebeam.sources.transactions import TRANSACTION_SCHEMA, read_transactions
    text = (",trans_date_trans_time,cc_num,category,amt,gender,lat,long,dob,merch_lat,merch_long,is_fraud\n"
            "0,2019-01-01 00:00:18,42,misc_net,4.97,F,36.08,-81.18,1988-03-09,36.01,-82.05,0\n"
            "1,2019-01-01 23:10:00,43,shopping_net,950.5,M,48.89,-118.21,1962-01-19,49.16,-118.19,1\n")
    path = tmp_path / "t.csv"
    path.write_text(text)
    for df in (read_transactions(spark, str(path), schema=TRANSACTION_SCHEMA),
               read_transactions(spark, str(path), infer_schema=True)):
        assert "_c0" not in df.columns and "cc_num" in df.columns
        rows = add_features(df).orderBy("trans_date_trans_time").collect()
        assert [(r.time_period, r.amt_category, r.is_fraud) for r in rows] == [
            ("night", "very_low", 0), ("night", "very_high", 1)]


def test_export_roundtrip_parquet(spark, run01, tmp_path):
    from rulebeam.sinks import writers as K
    from rulebeam.sources.results import read_latest_patterns
    base = str(tmp_path / "pq")
    K.write_patterns(run01.patterns, base, "20240101_000000", 15, fmt="parquet")
    K.write_validation(run01.validated, base, "20240101_000000", fmt="parquet")
    back = read_latest_patterns(spark, base, fmt="parquet")
    assert back.count() == 15 and back.filter("Rank = 1").first().Pattern_Name == \
        run01.patterns.filter("rank = 1").first().pattern_name
    val = spark.read.parquet(f"{base}/kind=validation")
    assert dict(val.dtypes)["Train_Confidence"] == "double"  # nulls, not N/A text, in Parquet
