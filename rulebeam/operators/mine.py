"""M2-M4: level-wise class-rule mining over the cell table.

Level 2 explodes the C(k,2) feature pairs of every cell (a fixed number per
cell, set by the spec), keeps the candidate values of both items (broadcast
hash joins with the spec-bounded domain), and sums counts per pair. Levels
3+ take the best ``beam`` patterns of the previous level as bases, find the
cells that contain each base (hash join on the base's first item, then a
containment test) and add one item from a feature the base does not use.

All candidate counting is a group-by over cells; the beam is a DataFrame
filter, never a driver loop. Each finished level is written to the shared
checkpoint folder, so the next level does not recompute it.

Ordering reproduces a stable score sort over generation order:
level 2 by (feature i, feature j, value rank i, value rank j), levels 3+ by
(base rank, new feature index, new value rank), all levels by
(score desc, level, level rank). Patterns reached from different bases in a
different item order are kept as separate rows unless ``spec.dedupe``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.items import cell_items, itemset_key, pattern_label, pattern_type, quoted
from ..functions.metrics import with_rule_metrics
from ..session import materialize
from ..spec import PatternSpec
from .cells import totals
from .domain import all_domains, item_domain, value_counts
from .ranking import rank_by_ranges

GEN_KEYS = ("g1", "g2", "g3", "g4")


def apply_thresholds(df: DataFrame, spec: PatternSpec, level: int) -> DataFrame:
    """Support (and confidence / lift where configured), inclusive."""
    # Levels beyond the configured ones keep the last configured support.
    known = [k for k in spec.min_support if k <= level]
    cond = F.col("support") >= F.lit(float(spec.min_support[max(known)] if known else 0.0))
    if level in spec.min_confidence:
        cond = cond & (F.col("confidence") >= F.lit(float(spec.min_confidence[level])))
    if spec.min_lift is not None:
        cond = cond & (F.col("lift") >= F.lit(float(spec.min_lift)))
    return df.filter(cond)


def pair_counts(cells: DataFrame, spec: PatternSpec, domain: DataFrame | None = None) -> DataFrame:
    """(ia, fa, va, ib, fb, vb[, ra, rb], n, p) for every feature pair i<j
    present in the data; restricted to ``domain`` values when given."""
    feats = spec.features
    pairs = F.array(*[
        F.struct(F.lit(i).alias("ia"), F.lit(a).alias("fa"), F.col(quoted(a)).alias("va"),
                 F.lit(j).alias("ib"), F.lit(b).alias("fb"), F.col(quoted(b)).alias("vb"))
        for i, a in enumerate(feats) for j, b in enumerate(feats) if i < j])
    x = cells.select("n", "p", F.inline(pairs))
    keys = [x["ia"], x["fa"], x["va"], x["ib"], x["fb"], x["vb"]]
    if domain is not None:
        # The domain (spec-bounded) is broadcast for each side of the pair.
        d = F.broadcast(domain.select("feature", "value", "vrank"))
        da, db = d.alias("da"), d.alias("db")
        x = (x.join(da, (x["fa"] == F.col("da.feature")) & (x["va"] == F.col("da.value")))
              .join(db, (x["fb"] == F.col("db.feature")) & (x["vb"] == F.col("db.value"))))
        keys += [F.col("da.vrank").alias("ra"), F.col("db.vrank").alias("rb")]
    return x.groupBy(*keys).agg(F.sum("n").alias("pattern_total"), F.sum("p").alias("pattern_fraud"))


def mine_pairs(cells: DataFrame, spec: PatternSpec, n_total: Column, p_total: Column,
               domain: DataFrame | None = None) -> DataFrame:
    """M2: kept 2-feature patterns with metrics and generation keys."""
    g = pair_counts(cells, spec, item_domain(cells, spec, 2) if domain is None else domain)
    g = g.select(
        F.array(F.struct(F.col("fa").alias("feature"), F.col("va").alias("value")),
                F.struct(F.col("fb").alias("feature"), F.col("vb").alias("value"))).alias("items"),
        F.lit(2).alias("level"), "pattern_total", "pattern_fraud",
        F.col("ia").alias("g1"), F.col("ib").alias("g2"), F.col("ra").alias("g3"), F.col("rb").alias("g4"))
    g = with_rule_metrics(g, "pattern_total", "pattern_fraud", n_total, p_total)
    return apply_thresholds(g, spec, 2)


def cells_with_items(cells: DataFrame, spec: PatternSpec) -> DataFrame:
    """(n, p, cell) with ``cell`` = array of (fidx, feature, value)."""
    return cells.select("n", "p", cell_items(spec.features).alias("cell"))


def contains_all(cell: Column, items: Column) -> Column:
    """Every (feature, value) of ``items`` occurs in ``cell``."""
    return F.forall(items, lambda it: F.exists(
        cell, lambda c: (c["feature"] == it["feature"]) & (c["value"] == it["value"])))


def match_first_item(cells: DataFrame, spec: PatternSpec, patterns: DataFrame, items_col: str = "items",
                     bounded: bool = False) -> DataFrame:
    """Cells joined to the patterns whose first item they hold (equi-join on
    (feature, value)).

    ``bounded=True`` states that ``patterns`` has a structural size bound (a
    beam or a top-N table) and broadcasts it. Otherwise the join strategy is
    left to the optimizer, which broadcasts only when the measured size is
    under ``spark.sql.autoBroadcastJoinThreshold`` and else shuffles both
    sides (AQE splits a hot first item)."""
    c = cells_with_items(cells, spec).select("n", "p", "cell", F.explode("cell").alias("it"))
    pats = patterns.withColumns({"_f0": F.col(items_col)[0]["feature"], "_v0": F.col(items_col)[0]["value"]})
    if bounded:
        pats = F.broadcast(pats)
    j = c.join(pats, (c["it"]["feature"] == pats["_f0"]) & (c["it"]["value"] == pats["_v0"]))
    return j.drop("it", "_f0", "_v0")


def match_rarest_item(cells: DataFrame, spec: PatternSpec, patterns: DataFrame,
                      items_col: str = "items") -> DataFrame:
    """Cells joined to the patterns whose rarest item they hold. For pattern tables
    of any size: patterns that share a frequent item meet its cells only if they have
    no rarer one. Patterns with an item that no cell holds have no output."""
    counts = value_counts(cells, spec.features).select(
        F.struct("feature", "value").alias("_rare"), F.col("count").alias("_rows"))
    pats = patterns.withColumn("_id", F.xxhash64(items_col))
    ask = pats.select("_id", F.explode(F.transform(
        items_col, lambda i: F.struct(i["feature"].alias("feature"), i["value"].alias("value")))).alias("_rare")).distinct()
    best = (ask.join(counts, "_rare", "left").groupBy("_id")
            .agg(F.min(F.struct(F.coalesce("_rows", F.lit(0)).alias("rows"), F.col("_rare"))).alias("_best"))
            .where(F.col("_best.rows") > 0).select("_id", F.col("_best._rare").alias("_rare")))
    c = cells_with_items(cells, spec).select("n", "p", "cell", F.explode("cell").alias("it")).select(
        "n", "p", "cell", F.struct(F.col("it.feature").alias("feature"), F.col("it.value").alias("value")).alias("_rare"))
    return c.join(pats.join(best, "_id"), "_rare").drop("_rare", "_id")


def match_patterns(cells: DataFrame, spec: PatternSpec, patterns: DataFrame, items_col: str = "items",
                   bounded: bool = False) -> DataFrame:
    """Cells joined to every pattern they contain completely."""
    m = (match_first_item(cells, spec, patterns, items_col, bounded) if bounded
         else match_rarest_item(cells, spec, patterns, items_col))
    return m.filter(contains_all(F.col("cell"), F.col(items_col)))


def extend_patterns(cells: DataFrame, bases: DataFrame, spec: PatternSpec, level: int,
                    n_total: Column, p_total: Column, domain: DataFrame | None = None) -> DataFrame:
    """M3: bases (items, level_rank) + one item of an unused feature."""
    domain = item_domain(cells, spec, level) if domain is None else domain
    b = bases.select(F.col("items").alias("base_items"), F.col("level_rank").alias("base_rank"))
    m = match_patterns(cells, spec, b, "base_items", bounded=True)  # at most spec.beam bases
    new = m.select("n", "p", "base_rank", F.explode(F.filter(
        "cell", lambda c: ~F.exists("base_items", lambda bi: bi["feature"] == c["feature"]))).alias("it"))
    new = new.select("n", "p", "base_rank", F.col("it.fidx").alias("fidx"), F.col("it.feature").alias("feature"),
                     F.col("it.value").alias("value"))
    d = F.broadcast(domain.select("feature", "value", "vrank"))
    g = (new.join(d, ["feature", "value"])
         .groupBy("base_rank", "fidx", "vrank", "feature", "value")
         .agg(F.sum("n").alias("pattern_total"), F.sum("p").alias("pattern_fraud")))
    g = g.join(F.broadcast(b), "base_rank")
    g = g.select(
        F.concat("base_items", F.array(F.struct("feature", "value"))).alias("items"),
        F.lit(level).alias("level"), "pattern_total", "pattern_fraud",
        F.col("base_rank").alias("g1"), F.col("fidx").alias("g2"), F.col("vrank").alias("g3"),
        F.lit(0).alias("g4"))
    g = with_rule_metrics(g, "pattern_total", "pattern_fraud", n_total, p_total)
    return apply_thresholds(g, spec, level)


def first_of_itemset(df: DataFrame) -> DataFrame:
    """The best row of each itemset of a level."""
    first = Window.partitionBy("level", "_key").orderBy(F.desc("score"), *GEN_KEYS)
    return (df.withColumn("_key", itemset_key(F.col("items")))
            .withColumn("_dup", F.row_number().over(first)).filter("_dup = 1").drop("_key", "_dup"))


def rank_level(df: DataFrame, spec: PatternSpec | None = None, workdir: str | None = None) -> DataFrame:
    """``level_rank`` = position in a stable score sort of generation
    order, per level, by a sort in ranges (any number of patterns)."""
    df = materialize(first_of_itemset(df) if spec is not None and spec.dedupe else df, "unranked", base=workdir)
    return rank_by_ranges(df, [F.desc("score"), *map(F.asc, ("level", *GEN_KEYS))], within="level", base=workdir).drop("rank")


def beam(level_patterns: DataFrame, width: int) -> DataFrame:
    """The ``width`` best patterns of one level, with their ``level_rank``."""
    order = [F.desc("score"), *map(F.asc, GEN_KEYS)]
    best = level_patterns.orderBy(*order).limit(width)
    return best.withColumn("level_rank", F.row_number().over(Window.orderBy(*order)))


def rank_all(patterns: DataFrame, workdir: str | None = None) -> DataFrame:
    """Merged list of written levels ranked by (score desc, level, generation order), with the
    ``level_rank`` of each, by one sort in ranges (any number of patterns)."""
    return rank_by_ranges(patterns, [F.desc("score"), *map(F.asc, ("level", *GEN_KEYS))], within="level", base=workdir)


def mine(cells: DataFrame, spec: PatternSpec, workdir: str | None = None) -> DataFrame:
    """M4: levels 2..max_len, merged and ranked.

    ``cells`` is the training cell table without split columns; values that are no candidate
    at any level are folded first. The domains, the folded cells and finished levels are written under ``workdir`` (default: a new folder
    in the checkpoint folder).
    Returns pattern_name, items, level, pattern_total, pattern_fraud,
    support, confidence, lift, score, level_rank, rank, pattern_type.
    """
    # Two numbers, read once; every level uses them as constants.
    sums = totals(cells).first()
    n_total, p_total = (F.lit(int(x or 0)).cast("bigint") for x in (sums["n_total"], sums["p_total"]))
    domains = materialize(all_domains(cells, spec), "domains", base=workdir)

    # The candidate lists are bounded by the spec.
    values: dict[str, list[str]] = {}
    for r in domains.select("feature", "value").distinct().collect():
        values.setdefault(r["feature"], []).append(r["value"])
    cells = materialize(fold_cells(cells, spec, values), "folded", base=workdir)

    def domain(k):
        return domains.filter(F.col("level") == spec.domain_level(k)).drop("level")

    def written(found, k):
        return materialize(first_of_itemset(found) if spec.dedupe else found, f"level{k}", base=workdir)

    level = written(mine_pairs(cells, spec, n_total, p_total, domain(2)), 2)
    levels = [level]
    for k in range(3, spec.max_len + 1):
        level = written(extend_patterns(cells, beam(level, spec.beam), spec, k, n_total, p_total, domain(k)), k)
        levels.append(level)
    merged = levels[0]
    for lv in levels[1:]:
        merged = merged.unionByName(lv)
    ranked = rank_all(merged, workdir)
    return ranked.select(pattern_label(F.col("items")).alias("pattern_name"), "items", "level",
                         "pattern_total", "pattern_fraud", "support", "confidence", "lift", "score",
                         "level_rank", "rank", pattern_type(F.col("items")).alias("pattern_type"))


def fold_cells(cells: DataFrame, spec: PatternSpec, values: dict[str, list[str]]) -> DataFrame:
    """Cells with every value outside ``values`` set to null (never a candidate) and added up
    again. The result is bounded by the candidate lists, also where a feature has as many
    values as there are rows."""
    keep = [F.when(F.col(quoted(f)).isin(values.get(f, [])), F.col(quoted(f))).alias(f) for f in spec.features]
    return (cells.select(*keep, "n", "p").groupBy(*[quoted(f) for f in spec.features])
            .agg(F.sum("n").alias("n"), F.sum("p").alias("p")))


def top_n(patterns: DataFrame, n: int) -> DataFrame:
    """The first ``n`` patterns by rank."""
    return patterns.filter(F.col("rank") <= n)
