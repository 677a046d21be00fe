"""Ranks by ranges, exact tails and the step-up rule against brute force."""

import math

import pytest
from pyspark.sql import functions as F

from rulebeam.operators.discovery import false_discovery, log_tails
from rulebeam.operators.mine import GEN_KEYS, beam, rank_all, rank_level
from rulebeam.operators.ranking import least_from_here, rank_by_ranges
from rulebeam.session import materialize
from rulebeam.spec import event_spec


def log_int(x):
    shift = max(0, x.bit_length() - 1000)
    return math.log(x >> shift) + shift * math.log(2)


def exact_log_tail(k, n, p, big):
    """From whole numbers only."""
    lo, hi = max(0, n + p - big), min(n, p)
    if k <= lo:
        return 0.0
    return log_int(sum(math.comb(p, x) * math.comb(big - p, n - x) for x in range(k, hi + 1))) - log_int(math.comb(big, n))


def tails(spark, rows, big, p):
    df = spark.createDataFrame(rows, "rank int, pattern_total long, pattern_fraud long")
    return {r.rank: r.log_p for r in log_tails(df, "rank", big, p).collect()}


@pytest.mark.parametrize("big, p", [(60, 20), (60, 0), (60, 60), (1, 1), (7000, 250), (500, 490)])
def test_tails_are_exact(spark, big, p):
    rows, i = [], 0
    for n in sorted({0, 1, 2, big // 10, big // 3, big - 1, big}):
        lo, hi = max(0, n + p - big), min(n, p)
        for k in sorted({lo, lo + 1, (lo + hi) // 2, round(n * p / big), round(n * p / big) + 1, hi} & set(range(lo, hi + 1))):
            rows.append((i, n, k))
            i += 1
    got = tails(spark, rows, big, p)
    assert len(got) == len(rows)
    for i, n, k in rows:
        assert got[i] == pytest.approx(exact_log_tail(k, n, p, big), rel=1e-9, abs=1e-11), (n, k)


def test_tails_of_large_counts(spark):
    # Several blocks of terms; a short exact sum needs the ratio of neighbouring terms only.
    big, p, n = 10 ** 12, 10 ** 9, 10 ** 11
    mean, sigma = 10 ** 8, math.sqrt(1e11 * 1e-3 * (1 - 1e-3) * 0.9)
    got = tails(spark, [(i, n, mean + round(z * sigma)) for i, z in enumerate((-3, 0.5, 2, 6, 40))], big, p)
    for i, z in enumerate((-3, 0.5, 2)):
        normal = 0.5 * math.erfc(z / math.sqrt(2))
        assert math.exp(got[i]) == pytest.approx(normal, rel=2e-3)
    # Far out: log of the tail by its asymptotic series, up to the skew of the distribution.
    for i, z in ((3, 6), (4, 40)):
        assert got[i] == pytest.approx(-z * z / 2 - math.log(z * math.sqrt(2 * math.pi)) - 1 / z / z, rel=3e-3)


def test_step_up_rule(spark):
    cells = spark.createDataFrame([(7000, 250)], "n long, p long").withColumn("q", F.col("n") - F.col("p"))
    rows = [(i + 1, 40 + 10 * (i % 50), min(40, (i * 7) % 30)) for i in range(200)]
    df = spark.createDataFrame(rows, "rank int, pattern_total long, pattern_fraud long")
    got = {r.rank: r for r in false_discovery(df, cells).collect()}
    logs = sorted((exact_log_tail(k, n, 250, 7000), i) for i, n, k in rows)
    least = 0.0
    for place in range(len(logs), 0, -1):
        lp, i = logs[place - 1]
        least = min(least, lp + math.log(len(logs) / place))
        assert got[i].log_q == pytest.approx(least, rel=1e-8, abs=1e-10)
        assert got[i].significant == (least <= math.log(0.05))
    assert false_discovery(df.limit(0), cells).count() == 0


def patterns(spark, n):
    """Scores with many ties, over three levels."""
    return materialize(spark.range(n).select(
        F.array(F.struct(F.lit("f").alias("feature"), F.col("id").cast("string").alias("value"))).alias("items"),
        (F.col("id") % 3 + 2).cast("int").alias("level"), ((F.col("id") * 7919) % 1000 / 1000.0).alias("score"),
        *[F.col("id").alias(g) if g == "g1" else F.lit(0).alias(g) for g in GEN_KEYS]))


def test_100000_patterns_are_ranked_by_several_tasks(spark):
    rows = patterns(spark, 100_000)
    got = rank_all(rows)
    want = sorted(range(100_000), key=lambda i: (-((i * 7919) % 1000) / 1000.0, i % 3 + 2, i))
    place = {int(r.v): (r.rank, r.level_rank) for r in got.select(F.col("items")[0]["value"].alias("v"), "rank", "level_rank").collect()}
    seen = [0, 0, 0]
    for at, i in enumerate(want):
        seen[i % 3] += 1
        assert place[i] == (at + 1, seen[i % 3])
    # So few rows are otherwise merged into one range.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = rank_by_ranges(rows, [F.desc("score"), F.asc("level"), F.asc("g1")], keep_part=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r["items"][0]["value"]: r["rank"] for r in kept.collect()} == {str(i): at + 1 for at, i in enumerate(want)}
    sizes = [r["count"] for r in kept.groupBy("_part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 50_000
    # The least value from each row on, over all ranges.
    low = least_from_here(kept.withColumn("v", (F.col("g1") * 31) % 977), "v", "least").select("rank", "v", "least").collect()
    least = None
    for r in sorted(low, key=lambda r: -r.rank):
        least = r.v if least is None else min(least, r.v)
        assert r.least == least


def test_level_ranks_and_beam(spark):
    rows = patterns(spark, 3000)
    ranked = {r.g1: r.level_rank for r in rank_level(rows).where("level = 2").collect()}
    assert sorted(ranked.values()) == list(range(1, 1001))
    best = {r.g1: r.level_rank for r in beam(rows.where("level = 2"), 15).collect()}
    assert len(best) == 15 and all(ranked[i] == r for i, r in best.items())
    twice = materialize(rows.where("level = 2").unionByName(rows.where("level = 2").withColumn("g1", F.col("g1") + 10_000)))
    kept = rank_level(twice, event_spec(dedupe=True)).collect()
    assert len(kept) == 1000 and {r.g1 for r in kept} == set(ranked)
    assert rank_level(rows.limit(0)).count() == 0
