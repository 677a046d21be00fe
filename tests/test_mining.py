"""Mining: golden values, brute-force equality of the beam, properties."""

import os
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from rulebeam import spec as S
from rulebeam.operators.cells import build_cells, split_cells
from rulebeam.operators.mine import mine, pair_counts
from rulebeam.plans.registry import run, txn
from rulebeam.spec import event_spec


def test_golden_sf001(run01):
    p = run01.patterns
    levels = dict(p.groupBy("level").count().collect())
    assert levels == {2: 179, 3: 217, 4: 165}
    top = p.filter("rank = 1").first()
    assert top.pattern_name == "time_period=night AND amt_category=high"
    assert (top.pattern_total, top.pattern_fraud) == (281, 192)
    assert abs(top.score - 0.524754) < 5e-7
    second = p.filter("rank = 2").first()
    assert second.pattern_name == "time_period=night AND amt_category=high AND is_weekend=0"
    assert (second.pattern_total, second.pattern_fraud) == (212, 147)
    comp = run01.train_cells.agg(F.sum("n"), F.sum("p")).first()
    assert tuple(comp) == (7000, 250)


def test_distinct_itemsets_and_duplicates(run01):
    from rulebeam.functions.items import itemset_key
    p = run01.patterns.withColumn("k", itemset_key(F.col("items")))
    distinct = dict(p.groupBy("level").agg(F.countDistinct("k")).collect())
    assert distinct[3] == 183 and distinct[4] == 57


def test_validation_golden(run01):
    v = run01.validated
    assert v.count() == 10
    assert v.filter("stable").count() == 0
    r1 = v.filter("rank = 1").first()
    assert (r1.test_pattern_total, r1.test_pattern_fraud, r1.status) == (111, 81, "UNSTABLE")


# --- brute force on the small fixture ---------------------------------------

def _brute_force(rows, spec):
    """Direct transcription of the level-wise search semantics in Python."""
    feats = spec.features
    N = len(rows)
    P = sum(1 for r in rows if r["is_fraud"] == spec.positive)

    def domain(level):
        fixed = spec.fixed_domain(level)
        out = {}
        for f in feats:
            if f in fixed:
                out[f] = list(fixed[f])
            else:
                c = Counter(r[f] for r in rows)
                ordered = sorted(c.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))
                out[f] = [v for v, _ in ordered[:spec.top_k(spec.domain_level(level))] if v is not None]
        return out

    def metrics(items):
        m = [r for r in rows if all(r[f] == v for f, v in items)]
        n = len(m)
        if n == 0:
            return None
        p = sum(1 for r in m if r["is_fraud"] == spec.positive)
        support = n / N
        conf = p / n
        base = P / N
        lift = conf / base if base > 0 else 0.0
        return dict(items=items, n=n, p=p, support=support, confidence=conf, lift=lift,
                    score=lift * conf * support)

    d2 = domain(2)
    level2 = []
    for a, b in combinations(feats, 2):
        for va in d2[a]:
            for vb in d2[b]:
                m = metrics([(a, va), (b, vb)])
                if m and m["support"] >= spec.min_support[2] and m["confidence"] >= spec.min_confidence[2]:
                    level2.append(m)
    level2.sort(key=lambda m: m["score"], reverse=True)
    levels = [level2]
    d3 = domain(3)
    for k in range(3, spec.max_len + 1):
        out = []
        for base in levels[-1][:spec.beam]:
            used = {f for f, _ in base["items"]}
            for f in feats:
                if f in used:
                    continue
                for v in d3[f]:
                    m = metrics(base["items"] + [(f, v)])
                    if m and m["support"] >= spec.min_support[k]:
                        out.append(m)
        out.sort(key=lambda m: m["score"], reverse=True)
        levels.append(out)
    merged = [m for lv in levels for m in lv]
    merged.sort(key=lambda m: m["score"], reverse=True)
    return merged


def test_beam_equals_brute_force(spark):
    spec = event_spec()
    rows_df = txn(spark, SF001).filter("split = 'train'").select(
        *[F.col(f).cast("string").alias(f) for f in spec.features], "is_fraud")
    rows = [r.asDict() for r in rows_df.collect()]
    expected = _brute_force(rows, spec)
    cells = split_cells(build_cells(txn(spark, SF001), spec, by=["split"]), "train")
    got = mine(cells, spec).orderBy("rank").collect()
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert [(i.feature, i.value) for i in g["items"]] == e["items"]
        assert (g.pattern_total, g.pattern_fraud) == (e["n"], e["p"])
        assert g.score == e["score"] and g.lift == e["lift"]


# --- cross-plan and properties -------------------------------------------------

def test_pairs_explode_equals_grouping_sets(spark):
    from __spark_entry__ import queries
    q = queries()
    a = q["pairs_all"](spark, SF001).select("fa", "va", "fb", "vb", "pattern_total", "pattern_fraud")
    b = q["pairs_grouping_sets"](spark, SF001)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_properties(run01):
    p = run01.patterns
    bad = p.filter((F.col("support") < 0) | (F.col("support") > 1) | (F.col("confidence") < 0)
                   | (F.col("confidence") > 1)).count()
    assert bad == 0
    # every value total over a feature sums to N
    cells = run01.train_cells
    n = cells.agg(F.sum("n")).first()[0]
    for f in S.MINING_FEATURES:
        assert cells.groupBy(f).agg(F.sum("n").alias("s")).agg(F.sum("s")).first()[0] == n


def test_extension_total_not_above_base(run01):
    from rulebeam.functions.items import pattern_label
    p = run01.patterns
    ext = p.filter("level = 3").withColumn("base", pattern_label(F.slice("items", 1, 2)))
    base = p.filter("level = 2").select(F.col("pattern_name").alias("base"), F.col("pattern_total").alias("bt"))
    assert ext.join(base, "base").filter(F.col("pattern_total") > F.col("bt")).count() == 0


def test_self_validation_is_stable(spark, run01):
    """Validating the train patterns on the train cells gives zero differences."""
    from rulebeam.operators.validate import stability, validate
    from rulebeam.operators.mine import top_n
    v = stability(validate(top_n(run01.patterns, 10), run01.train_cells, run01.spec), run01.spec)
    rows = v.collect()
    assert all(r.valid and r.status == "STABLE" and r.confidence_diff == 0 and r.lift_diff == 0 for r in rows)


def test_dedupe_option(spark):
    r = run(spark, SF001, dedupe=True)
    from rulebeam.functions.items import itemset_key
    p = r.patterns.withColumn("k", itemset_key(F.col("items")))
    assert p.groupBy("level", "k").count().filter("count > 1").count() == 0


def test_min_lift_filter(spark):
    r = run(spark, SF001, min_lift=5.0)
    assert r.patterns.filter("lift < 5.0").count() == 0


def test_pair_counts_cover_all_rows(spark):
    spec = event_spec()
    cells = split_cells(build_cells(txn(spark, SF001), spec, by=["split"]), "train")
    n = cells.agg(F.sum("n")).first()[0]
    per_pair = pair_counts(cells, spec).groupBy("fa", "fb").agg(F.sum("pattern_total").alias("s"))
    assert {r.s for r in per_pair.collect()} == {n}


def test_golden_sf01(spark):
    """FIXTURES §6, sf0.1 column."""
    r = run(spark, "/root/testdata/sf0.1")
    p = r.patterns
    assert dict(p.groupBy("level").count().collect()) == {2: 184, 3: 215, 4: 163}
    top = p.filter("rank = 1").first()
    assert top.pattern_name == "time_period=night AND amt_category=high"
    assert (top.pattern_total, top.pattern_fraud) == (2947, 2001)
    assert abs(top.score - 0.527229) < 5e-7
    v = {x.rank: x for x in r.validated.collect()}
    assert sum(x.stable for x in v.values()) == 6
    assert (v[1].test_pattern_total, v[1].test_pattern_fraud, v[1].status) == (1340, 901, "UNSTABLE")
    assert v[2].pattern_name == "time_period=night AND amt_category=high AND is_weekend=0"
    assert (v[2].train_pattern_total, v[2].train_pattern_fraud, v[2].status) == (2148, 1459, "STABLE")


def test_pairs_agree_with_fpgrowth(spark):
    """Spark ML FPGrowth on feature=value baskets (plus the label item) gives
    the same confidence and lift for rules {a, b} => label as the pair counts."""
    from pyspark.ml.fpm import FPGrowth
    spec = event_spec()
    rows = txn(spark, SF001).filter("split = 'train'")
    baskets = rows.select(F.array_compact(F.array(
        *[F.concat(F.lit(f + "="), F.col(f).cast("string")) for f in spec.features],
        F.when(F.col("is_fraud") == 1, F.lit("LABEL")))).alias("items"))
    n_rows = baskets.count()
    model = FPGrowth(itemsCol="items", minSupport=1.0 / n_rows, minConfidence=0.0).fit(baskets)
    rules = (model.associationRules.filter((F.size("antecedent") == 2) & (F.col("consequent")[0] == "LABEL"))
             .select(F.array_sort("antecedent").alias("k"), "confidence", "lift"))
    got = {tuple(r.k): (r.confidence, r.lift) for r in rules.collect()}

    cells = split_cells(build_cells(txn(spark, SF001), spec, by=["split"]), "train")
    from rulebeam.functions.metrics import with_rule_metrics
    from rulebeam.operators.cells import total_columns
    n_total, p_total = total_columns(cells)
    pairs = with_rule_metrics(pair_counts(cells, spec), "pattern_total", "pattern_fraud", n_total, p_total)
    ours = {tuple(sorted([f"{r.fa}={r.va}", f"{r.fb}={r.vb}"])): (r.confidence, r.lift)
            for r in pairs.filter("pattern_fraud > 0").collect()}
    assert set(got) == set(ours)
    for k, (c, l) in ours.items():
        assert abs(got[k][0] - c) < 1e-12 and abs(got[k][1] - l) < 1e-9


def test_wide_feature_cells_are_bounded_by_the_domain(spark):
    """Birth date has about one value per customer; what is paired is bounded by the candidates."""
    r = run(spark, SF01, features=S.WIDE_FEATURES)
    assert r.patterns.count() > 0
    folded = next(p for p in os.listdir(r.workdir.replace("file:", "")) if p.startswith("folded"))
    paired, cells = spark.read.parquet(f"{r.workdir}/{folded}"), r.train_cells
    assert paired.select("dob").distinct().count() <= r.spec.top_k(2) + 1 < cells.select("dob").distinct().count()
    assert paired.count() < cells.count() / 2
    assert paired.agg(F.sum("n"), F.sum("p")).first() == cells.agg(F.sum("n"), F.sum("p")).first()
    r.release()
