"""The command line runs the three steps end to end on CSV files."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from conftest import ROOT, SF001
from rulebeam.plans.registry import txn

COLS = ["trans_date_trans_time", "dob", "amt", "category", "gender", "lat", "long", "merch_lat", "merch_long",
        "is_fraud"]


def test_cli_profile_mine_report(spark, tmp_path):
    rows = txn(spark, SF001)
    for split in ("train", "test"):
        rows.filter(F.col("split") == split).select(*COLS).write.option("header", True).csv(str(tmp_path / split))
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false pyspark-shell")

    def cli(*args):
        return subprocess.run([sys.executable, "-m", "rulebeam", *args], cwd=ROOT, env=env,
                              capture_output=True, text=True, timeout=600)

    train, test, out = str(tmp_path / "train"), str(tmp_path / "test"), str(tmp_path / "results")
    p = cli("profile", "--train", train, "--test", test)
    assert p.returncode == 0, p.stderr[-2000:]
    assert "== composition" in p.stdout and "== rates: gender" in p.stdout and "... the first" not in p.stdout
    cut = cli("profile", "--train", train, "--test", test, "--rows", "1", "--out", str(tmp_path / "profile"))
    assert cut.returncode == 0 and "... the first 1 of" in cut.stdout
    rates = spark.read.option("header", True).csv(str(tmp_path / "profile" / "kind=profile_rates"))
    assert {r.feature for r in rates.collect()} >= {"gender", "time_period"} and rates.count() > 50
    m = cli("mine", "--train", train, "--test", test, "--out", out)
    assert m.returncode == 0, m.stderr[-2000:]
    assert "results written under" in m.stdout
    assert sorted(os.listdir(out)) == ["kind=all", "kind=summary", "kind=top", "kind=validation"]
    r = cli("report", "--out", out)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "FRAUD PATTERN ANALYSIS SUMMARY" in r.stdout
    text = [x.value for x in spark.read.text(out + "/kind=summary_text").collect()]
    assert text[:2] == ["", "FRAUD PATTERN ANALYSIS SUMMARY"] and len(text) == 9 + 15
