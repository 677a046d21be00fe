"""Per-row feature derivation (calendar, amount, age, distance buckets).

Pure column expressions: no shuffle, all inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import spec as S


def bucketize(col: Column, edges: Sequence[float], labels: Sequence[str], null_label: str | None = None) -> Column:
    """``col < edges[0] -> labels[0]`` ... otherwise ``labels[-1]``.

    A null or NaN value fails every test and lands in the last bucket, unless
    ``null_label`` is given: then a null gets that label.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    expr = F.when(col.isNull(), null_label) if null_label is not None else None
    for edge, label in zip(edges, labels):
        expr = F.when(col < edge, label) if expr is None else expr.when(col < edge, label)
    return expr.otherwise(labels[-1])


def time_period(hour: Column, null_label: str | None = None) -> Column:
    expr = F.when(hour.isNull(), null_label) if null_label is not None else None
    for label, lo, hi in S.TIME_PERIODS:
        cond = hour.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(S.TIME_PERIOD_OTHERWISE)


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, clamp: bool = True) -> Column:
    """Spherical law of cosines. ``clamp`` keeps the cosine in [-1, 1] so
    identical points give 0 instead of NaN from rounding just above 1."""
    cos_angle = (F.sin(F.radians(lat1)) * F.sin(F.radians(lat2))
                 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
                 * F.cos(F.radians(lon1) - F.radians(lon2)))
    if clamp:
        # CASE, not least/greatest: those skip nulls and would turn missing
        # coordinates into a cosine of -1.
        cos_angle = F.when(cos_angle > 1.0, 1.0).when(cos_angle < -1.0, -1.0).otherwise(cos_angle)
    return F.acos(cos_angle) * S.EARTH_RADIUS_KM


@dataclass(frozen=True)
class FeatureConfig:
    event_time: str = "trans_date_trans_time"
    birth_date: str = "dob"
    amount: str = "amt"
    lat: str = "lat"
    lon: str = "long"
    merch_lat: str = "merch_lat"
    merch_lon: str = "merch_long"
    clamp_distance: bool = True
    # None: a null input falls into the last bucket (night, very_high, senior,
    # very_far; is_weekend 0). A label: nulls get that label instead.
    null_bucket: str | None = None


def add_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Append hour, day_of_week, month, is_weekend, time_period, amt_category,
    age, age_group, distance_km and distance_category; other columns pass
    through unchanged."""
    ts = F.col(cfg.event_time)
    base = df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "month": F.month(ts),
        "age": F.floor(F.datediff(ts, F.col(cfg.birth_date)) / S.DAYS_PER_YEAR),
        "distance_km": great_circle_km(F.col(cfg.lat), F.col(cfg.lon),
                                       F.col(cfg.merch_lat), F.col(cfg.merch_lon),
                                       clamp=cfg.clamp_distance),
    })
    nb = cfg.null_bucket
    return base.withColumns({
        "is_weekend": F.when(F.col("day_of_week").isin(*S.WEEKEND_DAYS), 1).otherwise(0),
        "time_period": time_period(F.col("hour"), nb),
        "amt_category": bucketize(F.col(cfg.amount), S.AMOUNT_EDGES, S.AMOUNT_LABELS, nb),
        "age_group": bucketize(F.col("age"), S.AGE_EDGES, S.AGE_LABELS, nb),
        "distance_category": bucketize(F.col("distance_km"), S.DISTANCE_EDGES, S.DISTANCE_LABELS, nb),
    })


FEATURE_COLUMNS = ("hour", "day_of_week", "month", "is_weekend", "time_period", "amt_category",
                   "age", "age_group", "distance_km", "distance_category")
