"""Entry-point plans from files: CSV in, same patterns out; report from results."""

from pyspark.sql import functions as F

from conftest import SF001
from rulebeam.plans.eda import profile
from rulebeam.plans.mining import export, run_from_files
from rulebeam.plans.registry import run, txn
from rulebeam.plans.reporting import report
from rulebeam.spec import event_spec


def test_csv_files_to_report(spark, tmp_path):
    rows = txn(spark, SF001)
    cols = ["trans_date_trans_time", "dob", "amt", "category", "gender", "lat", "long", "merch_lat",
            "merch_long", "is_fraud"]
    for split in ("train", "test"):
        (rows.filter(F.col("split") == split)
         .select(F.monotonically_increasing_id().alias("_c0"), *cols)
         .write.option("header", True).csv(str(tmp_path / split)))
    r = run_from_files(spark, str(tmp_path / "train"), str(tmp_path / "test"), event_spec())
    direct = run(spark, SF001)
    got = [(x.pattern_name, x.pattern_total, x.score) for x in r.patterns.orderBy("rank").collect()]
    want = [(x.pattern_name, x.pattern_total, x.score) for x in direct.patterns.orderBy("rank").collect()]
    assert got == want

    out = str(tmp_path / "results")
    run_id = export(r, out, "20240101_000000")
    rep = report(spark, out, generated=run_id)
    assert rep.patterns.count() == 15
    assert rep.top_patterns.count() == 10
    assert rep.summary.first().n_patterns == 15
    lines = [x.line for x in rep.text.orderBy("line_no").collect()]
    assert lines[:2] == ["", "FRAUD PATTERN ANALYSIS SUMMARY"] and "TOP 5 PATTERNS:" in lines

    p = profile(r.rows, cells=r.cells)
    assert p.composition.count() == 2 and p.nulls.count() == 0
    assert {x.dataset for x in p.comparison.collect()} == {"train", "test"}
