"""Boundary rows for every derived feature (null, NaN, bucket edges)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rulebeam.functions.features import FeatureConfig, add_features, bucketize, great_circle_km

SCHEMA = ("trans_date_trans_time timestamp, dob date, amt double, lat double, long double, "
          "merch_lat double, merch_long double")


def ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S") if s else None


BOUNDARY = [
    # time, hour, day_of_week, is_weekend, time_period, amt, amt_category
    ("2024-01-06 05:59:59", 5, 7, 1, "night", 9.99, "very_low"),
    ("2024-01-07 06:00:00", 6, 1, 1, "morning", 10.0, "low"),
    ("2024-01-08 11:59:59", 11, 2, 0, "morning", 49.99, "low"),
    ("2024-01-08 12:00:00", 12, 2, 0, "afternoon", 50.0, "medium"),
    ("2024-01-08 17:59:59", 17, 2, 0, "afternoon", 199.99, "medium"),
    ("2024-01-08 18:00:00", 18, 2, 0, "evening", 200.0, "high"),
    ("2024-01-08 21:59:59", 21, 2, 0, "evening", 499.99, "high"),
    ("2024-01-08 22:00:00", 22, 2, 0, "night", 500.0, "very_high"),
    (None, None, None, 0, "night", None, "very_high"),
]


def test_time_and_amount_boundaries(spark):
    rows = [(ts(t), dt.date(1990, 1, 1), amt, 0.0, 0.0, 0.0, 0.0) for t, *_, amt, _ in BOUNDARY]
    out = add_features(spark.createDataFrame(rows, SCHEMA)).collect()
    for r, (t, hour, dow, wk, period, amt, cat) in zip(out, BOUNDARY):
        assert (r.hour, r.day_of_week, r.is_weekend, r.time_period, r.amt_category) == (hour, dow, wk, period, cat)


def test_age_is_floor_of_days_over_365(spark):
    rows = [(ts("2019-01-01 00:00:00"), dt.date(1990, 5, 5), 1.0, 0.0, 0.0, 0.0, 0.0),
            (ts("2019-01-01 00:00:00"), None, 1.0, 0.0, 0.0, 0.0, 0.0)]
    df = add_features(spark.createDataFrame(rows, SCHEMA))
    assert dict(df.dtypes)["age"] == "bigint"
    r = df.collect()
    assert r[0].age == 28 and r[0].age_group == "young_adult"
    assert r[1].age is None and r[1].age_group == "senior"


@pytest.mark.parametrize("age,group", [(24, "young"), (25, "young_adult"), (34, "young_adult"), (35, "middle_aged"),
                                       (49, "middle_aged"), (50, "older_adult"), (64, "older_adult"), (65, "senior")])
def test_age_group_edges(spark, age, group):
    from rulebeam import spec as S
    v = spark.range(1).select(bucketize(F.lit(age), S.AGE_EDGES, S.AGE_LABELS).alias("g")).first().g
    assert v == group


@pytest.mark.parametrize("km,cat", [(4.999, "very_close"), (5, "close"), (24.9, "close"), (25, "medium_distance"),
                                    (99.9, "medium_distance"), (100, "far"), (499.9, "far"), (500, "very_far"),
                                    (float("nan"), "very_far")])
def test_distance_edges(spark, km, cat):
    from rulebeam import spec as S
    df = spark.createDataFrame([(float(km),)], "d double")
    assert df.select(bucketize(F.col("d"), S.DISTANCE_EDGES, S.DISTANCE_LABELS)).first()[0] == cat


def test_identical_points_clamp(spark):
    # Points where the cosine rounds above 1: NaN without the clamp, 0 with it;
    # null coordinates stay null (no antipodal distance from the clamp).
    df = spark.createDataFrame([(37.7749, -122.4194)] * 3 + [(40.1, -73.9)], "a double, b double")
    clamped = df.select(great_circle_km("a", "b", "a", "b").alias("d")).collect()
    assert all(r.d == 0.0 or r.d < 1e-3 for r in clamped)
    raw = df.select(great_circle_km(F.col("a"), F.col("b"), F.col("a"), F.col("b"), clamp=False).alias("d"))
    cats = add_features(spark.createDataFrame(
        [(ts("2024-01-01 00:00:00"), dt.date(1990, 1, 1), 1.0, 37.7749, -122.4194, 37.7749, -122.4194)], SCHEMA),
        FeatureConfig(clamp_distance=True)).first()
    assert cats.distance_category == "very_close"
    for r in raw.collect():
        assert r.d is None or math.isnan(r.d) or r.d < 1e-3


def test_unknown_columns_pass_through(spark):
    rows = [(ts("2024-01-08 12:00:00"), dt.date(1990, 1, 1), 60.0, 0.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("extra", F.lit("x"))
    out = add_features(df)
    assert "extra" in out.columns and out.first().extra == "x"


def test_null_bucket_option(spark):
    rows = [(None, None, None, None, None, None, None)]
    out = add_features(spark.createDataFrame(rows, SCHEMA), FeatureConfig(null_bucket="unknown")).first()
    assert (out.time_period, out.amt_category, out.age_group, out.distance_category) == ("unknown",) * 4
    default = add_features(spark.createDataFrame(rows, SCHEMA)).first()
    assert (default.time_period, default.amt_category, default.age_group, default.distance_category) == \
        ("night", "very_high", "senior", "very_far")


def test_null_coordinates_give_null_distance(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    assert df.select(great_circle_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0] is None
