"""The commit protocol of result tables."""
import json
import os

import pytest
from pyspark.sql import functions as F

from rulebeam.sinks import publish
from rulebeam.sinks.publish import Publication, committed, discard_unfinished, new_run_id
from rulebeam.sinks.writers import EXPORT_COLUMNS, write_result
from rulebeam.sources.results import read_latest_patterns


def table(spark, mark):
    return spark.createDataFrame([(1, mark)], "Rank int, Pattern_Name string")


def newest(spark, base, **kw):
    return read_latest_patterns(spark, base, **kw).first().Pattern_Name


def test_two_runs_of_one_second(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "r")

    class Clock:
        ticks = iter([100, 200])

        @classmethod
        def now(cls, zone):
            import datetime
            return datetime.datetime(2024, 1, 1, 0, 0, 0, next(cls.ticks), tzinfo=zone)

    monkeypatch.setattr(publish, "datetime", Clock)
    first, second = new_run_id(), new_run_id()
    assert first[:15] == second[:15] == "20240101_000000" and first < second
    write_result(table(spark, "new"), base, "top", second)  # the later run commits first
    write_result(table(spark, "old"), base, "top", first)
    assert newest(spark, base) == "new"
    assert [r for r, _ in committed(spark, base)] == [second, first]


def test_a_run_that_dies_is_not_read(spark, tmp_path):
    base = str(tmp_path / "r")
    with pytest.raises(ZeroDivisionError):
        with Publication(spark, base, "20240103_000000") as out:
            out.write(table(spark, "dead"), "top")
            1 / 0
    with pytest.raises(FileNotFoundError):  # nothing is committed yet, and nothing half-written is read
        read_latest_patterns(spark, base)
    write_result(table(spark, "good"), base, "top", "20240101_000000")
    # Killed between two moves: a folder is in place, staging is left, no manifest names the run.
    out = Publication(spark, base, "20240102_000000")
    out.write(table(spark, "killed"), "top")
    out.write(table(spark, "killed"), "all")
    os.makedirs(f"{base}/kind=top", exist_ok=True)
    os.rename(f"{out.staging}/kind=top", out.path("top"))
    assert newest(spark, base) == "good" and newest(spark, base, prefer="all", fallback="top") == "good"
    # The same run again: what it left is replaced.
    with Publication(spark, base, "20240102_000000") as again:
        again.write(table(spark, "again"), "top")
    assert newest(spark, base) == "again"
    gone = discard_unfinished(spark, base)
    assert [os.path.basename(g)[:15] for g in gone] == ["20240102_000000"] and not os.listdir(f"{base}.commits/staging")
    assert newest(spark, base) == "again"


def test_a_reader_between_moves_and_manifest(spark, tmp_path, monkeypatch):
    """Whatever moment a reader comes at, it sees a whole run."""
    base = str(tmp_path / "r")
    write_result(table(spark, "before"), base, "top", "20240101_000000")
    seen = []
    move = publish.rename_path

    def watched(*args):
        move(*args)
        seen.append(newest(spark, base))

    monkeypatch.setattr(publish, "rename_path", watched)
    with Publication(spark, base, "20240102_000000") as out:
        out.write(table(spark, "after"), "top")
        out.write(table(spark, "after"), "all")
    assert seen == ["before", "before"] and newest(spark, base) == "after"


def test_run_ids_are_published_once(spark, tmp_path):
    base = str(tmp_path / "r")
    write_result(table(spark, "x"), base, "top", "20240101_000000")
    write_result(table(spark, "x"), base, "all", "20240101_000000")  # another kind of the same run
    with pytest.raises(FileExistsError, match="already published top"):
        write_result(table(spark, "y"), base, "top", "20240101_000000")
    assert newest(spark, base) == "x"
    for bad in ("a/b", "a~b", "a b"):
        with pytest.raises(ValueError):
            Publication(spark, base, bad)
    with pytest.raises(ValueError), Publication(spark, base) as out:
        out.write(table(spark, "x"), "a+b")


def test_results_from_before_manifests(spark, tmp_path):
    base = str(tmp_path / "r")
    for run, mark in (("20230101_000000", "a"), ("20230102_000000", "b")):
        table(spark, mark).write.option("header", True).csv(f"{base}/kind=top/run_id={run}")
    assert newest(spark, base) == "b"


def test_manifest_lists_the_tables(spark, tmp_path):
    base = str(tmp_path / "r")
    with Publication(spark, base, "20240101_000000") as out:
        out.write(table(spark, "x"), "top")
        out.write(table(spark, "x").select(F.col("Pattern_Name").alias("line")), "summary_text", "text")
    name = next(n for n in os.listdir(f"{base}.commits/manifests") if n.endswith(".json"))
    assert name == "20240101_000000~top+summary_text.json"
    with open(f"{base}.commits/manifests/{name}") as f:
        assert json.load(f)["tables"]["top"] == "kind=top/run_id=20240101_000000"
    assert "Rank" in EXPORT_COLUMNS
