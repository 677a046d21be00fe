"""Labels: the escape grammar, and validation and funnels by the prefix trie."""
import random

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from rulebeam.functions.items import parse_pattern_label, pattern_label
from rulebeam.operators.label_trie import funnel_counts, label_steps, trie_counts
from rulebeam.operators.validate import NO_MATCH, label_report, validate_labels
from rulebeam.spec import event_spec

ITEMS = "items array<struct<feature:string,value:string>>"
SIGNS = [" ", "AND", "=", "\\", "a", "é", " AND ", "  ", "x", '"', ",", "\n", "\U0001F511"]


def written_and_read(spark, patterns):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(patterns)], f"i int, {ITEMS}")
    df = df.withColumn("label", pattern_label(F.col("items"))).withColumn("parsed", parse_pattern_label(F.col("label")))
    return [(r.label, [tuple(x) for x in r.parsed["items"]] if r.parsed["ok"] else None) for r in df.orderBy("i").collect()]


def test_awkward_items_round_trip(spark):
    rng = random.Random(1)
    text = lambda: "".join(rng.choice(SIGNS) for _ in range(rng.randrange(7)))
    patterns = [[(text(), text()) for _ in range(rng.randrange(1, 4))] for _ in range(3000)]
    assert [got for _, got in written_and_read(spark, patterns)] == patterns


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=12), st.text(max_size=12)), min_size=1, max_size=3))
def test_any_text_round_trips(spark, items):
    assert written_and_read(spark, [items])[0][1] == items


def test_plain_labels_are_unchanged(spark):
    patterns = [[("gender", "F"), ("category", "a=b")], [("a b", "x y"), ("n", "1.5")], [("brand", "BAND ANDY")]]
    assert [label for label, _ in written_and_read(spark, patterns)] == [
        "gender=F AND category=a=b", "a b=x y AND n=1.5", "brand=BAND ANDY"]


@pytest.mark.parametrize("label, items, reason", [
    ("a=1 AND b=2", [("a", "1"), ("b", "2")], None),
    (" a = 1  AND  b= x=y ", [("a", "1"), ("b", "x=y")], None),
    (r"category=a=b \AND c AND gender=F", [("category", "a=b AND c"), ("gender", "F")], None),
    (r"p=C:\Apps AND q=\ ", [("p", r"C:\Apps"), ("q", " ")], None),
    ("a 1 AND b=2", None, "Invalid pattern part: a 1"),
    ("a=1 AND  b ", None, "Invalid pattern part:  b "),
    ("", None, "Invalid pattern part: "),
])
def test_parse(spark, label, items, reason):
    r = spark.createDataFrame([(label,)], "label string").select(parse_pattern_label(F.col("label")).alias("p")).first().p
    assert (None if r["items"] is None else [tuple(i) for i in r["items"]], r["reason"]) == (items, reason)


def brute(rows, items):
    """Rows left after each condition, positives at the end; rows are dicts of text."""
    after = []
    for feature, value in items:
        rows = [r for r in rows if r.get(feature) == value]
        after.append(len(rows))
    return after, sum(r["is_fraud"] == "1" for r in rows)


def table(spark, rng, n):
    rows = [{"f": rng.choice("ab") if rng.random() < .9 else None, "g": str(rng.randrange(40)), "h": str(rng.randrange(5)),
             "is_fraud": rng.choice("01")} for _ in range(n)]
    df = spark.createDataFrame([(r["f"], int(r["g"]), r["h"], int(r["is_fraud"])) for r in rows], "f string, g int, h string, is_fraud int")
    return rows, df


def test_report_equals_counting_by_hand(spark):
    rng = random.Random(4)
    rows, df = table(spark, rng, 800)
    labels = [[(rng.choice("fgh"), rng.choice(["a", "b", *map(str, range(6))])) for _ in range(rng.randrange(1, 5))] for _ in range(200)]
    text = spark.createDataFrame([(i % 150, " AND ".join(f"{f}={v}" for f, v in p)) for i, p in enumerate(labels)],
                                 "pattern_id int, pattern_name string")  # some keys repeat
    got = sorted((r.pattern_name, r.pattern_id, r.after, r.pattern_total, r.pattern_fraud, r.reason)
                 for r in label_report(text, df, event_spec()).collect())
    want = []
    for i, p in enumerate(labels):
        bad = next((j for j, (f, v) in enumerate(p, 1) if f == "g" and not v.isdigit()), None)
        name = " AND ".join(f"{f}={v}" for f, v in p)
        if bad:
            want.append((name, i % 150, None, None, None, f"Filter error on condition {bad}: malformed value {p[bad - 1][1]}"))
            continue
        after, positives = brute(rows, p)
        hit = after[-1] > 0
        want.append((name, i % 150, after, after[-1] if hit else None, positives if hit else None, None if hit else NO_MATCH))
    assert got == sorted(want)


def test_thousands_of_labels_behind_one_frequent_condition(spark):
    """5,000 labels begin with f=a, which most cells hold: a cell meets that node once, then only the children it holds."""
    rng = random.Random(6)
    rows, df = table(spark, rng, 400)
    spec = event_spec().with_(features=("f", "g", "h"))
    cells = df.select("f", F.col("g").cast("string").alias("g"), "h", F.lit(1).alias("n"), F.col("is_fraud").alias("p"),
                      (1 - F.col("is_fraud")).alias("q"))
    labels = spark.range(5000).select(F.col("id").alias("pattern_id"), F.array(
        F.struct(F.lit("f").alias("feature"), F.lit("a").alias("value")),
        F.struct(F.lit("g").alias("feature"), F.col("id").cast("string").alias("value"))).alias("items"))
    steps = label_steps(labels, "pattern_id")
    assert steps.select("node").distinct().count() == 5001
    reached = trie_counts(cells, spec, steps)
    held = sum(r["f"] == "a" for r in rows)
    # Every pair of a cell and a node that arises is counted in n once: at most two per cell, not 5,000.
    assert reached.agg(F.sum("n")).first()[0] == 2 * held <= 2 * len(rows)
    found = {r.pattern_id: (r.after, r.p) for r in funnel_counts(cells, spec, labels, "pattern_id").collect()}
    assert len(found) == 5000
    for i in (0, 7, 39, 40, 4999):
        assert found[i] == brute(rows, [("f", "a"), ("g", str(i))])


def test_cells_know_their_own_columns_only(spark):
    cells = spark.createDataFrame([("F", 3, 1, 2)], "gender string, n long, p long, q long")
    labels = spark.createDataFrame([(1, "hour=23"), (2, "gender=F")], "pattern_id int, pattern_name string")
    r = {x.pattern_id: (x.valid, x.reason) for x in validate_labels(labels, cells, event_spec()).collect()}
    assert r == {1: (False, "Filter error on condition 1: unknown column hour"), 2: (True, None)}


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "f string, is_fraud int")
    labels = spark.createDataFrame([(1, "f=a"), (2, None)], "pattern_id int, pattern_name string")
    r = {x.pattern_id: (x.after, x.valid, x.reason) for x in label_report(labels, rows, event_spec()).collect()}
    assert r == {1: ([0], False, NO_MATCH), 2: (None, False, "No pattern label")}
    assert label_report(labels.limit(0), rows, event_spec()).count() == 0
