"""Candidate values per feature and level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..spec import PatternSpec

DOMAIN_SCHEMA = "feature string, fidx int, value string, vrank int"


def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def literal_table(spark, rows, schema: str) -> DataFrame:
    """A small parameter table (spec constants), built JVM-side in one call."""
    if not rows:
        return spark.createDataFrame([], schema)
    cols = [c.strip().split(" ", 1) for c in schema.split(",")]
    values = ", ".join("(" + ", ".join(f"CAST({sql_literal(v)} AS {t})" for v, (_, t) in zip(r, cols)) + ")"
                       for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(n for n, _ in cols)})")


def value_counts(cells: DataFrame, features) -> DataFrame:
    """(feature, value, count) over all rows, from the cell table."""
    long = cells.unpivot(ids=["n"], values=list(features), variableColumnName="feature",
                         valueColumnName="value")
    return long.groupBy("feature", "value").agg(F.sum("n").alias("count"))


def top_values(cells: DataFrame, features, k: int) -> DataFrame:
    """The k most frequent values per feature.

    Order: count desc, value asc, null last. A null value takes a slot and
    is dropped afterwards, so a feature may return fewer than k values.
    """
    w = Window.partitionBy("feature").orderBy(F.desc("count"), F.asc_nulls_last("value"))
    ranked = value_counts(cells, features).withColumn("value_rank", F.row_number().over(w))
    return ranked.filter((F.col("value_rank") <= k) & F.col("value").isNotNull())


def item_domain(cells: DataFrame, spec: PatternSpec, level: int) -> DataFrame:
    """(feature, fidx, value, vrank): fixed lists from the spec, top-k from
    the data for every other feature. ``vrank`` is the value's position in
    the candidate list (generation order). At most
    ``sum(max(len(fixed), top_k))`` rows over the spec's features, so it is
    safe to broadcast."""
    spark = cells.sparkSession
    fixed = spec.fixed_domain(level)
    fidx = {f: i for i, f in enumerate(spec.features)}
    fixed_rows = [(f, fidx[f], v, r + 1)
                  for f in spec.features if f in fixed
                  for r, v in enumerate(fixed[f])]
    parts = [literal_table(spark, fixed_rows, DOMAIN_SCHEMA)]
    ranked_features = [f for f in spec.features if f not in fixed]
    if ranked_features:
        idx = F.create_map(*[x for f in ranked_features for x in (F.lit(f), F.lit(fidx[f]))])
        top = top_values(cells, ranked_features, spec.top_k(spec.domain_level(level)))
        parts.append(top.select("feature", idx[F.col("feature")].cast("int").alias("fidx"), "value",
                                F.col("value_rank").cast("int").alias("vrank")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def all_domains(cells: DataFrame, spec: PatternSpec) -> DataFrame:
    """Candidate domains of every distinct domain level, tagged ``level``."""
    levels = sorted({spec.domain_level(k) for k in range(2, spec.max_len + 1)})
    fidx = {f: i for i, f in enumerate(spec.features)}
    fixed = {lv: spec.fixed_domain(lv) for lv in levels}
    out = literal_table(cells.sparkSession, [(f, fidx[f], v, r + 1, lv) for lv in levels for f in spec.features
                                             if f in fixed[lv] for r, v in enumerate(fixed[lv][f])],
                        f"{DOMAIN_SCHEMA}, level int")
    # Features without a fixed list at some level are counted and ranked once for all levels.
    open_at = {f: [lv for lv in levels if f not in fixed[lv]] for f in spec.features}
    ranked = [f for f in spec.features if open_at[f]]
    if ranked:
        top = top_values(cells, ranked, max(spec.top_k(lv) for lv in levels))
        keys = F.create_map(*[x for f in ranked for x in (F.lit(f), F.struct(
            F.lit(fidx[f]).alias("fidx"),
            F.array(*[F.struct(F.lit(lv).alias("level"), F.lit(spec.top_k(lv)).alias("k"))
                      for lv in open_at[f]]).alias("levels")))])
        each = top.withColumn("_key", keys[F.col("feature")]).withColumn("_level", F.explode("_key.levels"))
        out = out.unionByName(each.where("value_rank <= _level.k").select(
            "feature", F.col("_key.fidx").alias("fidx"), "value", F.col("value_rank").cast("int").alias("vrank"),
            F.col("_level.level").alias("level")))
    return out
