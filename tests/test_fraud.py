import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyworks.functions import haversine_km
from tallyworks.plans import fraud
from tests.conftest import plan_of, ts

DAY = dt.date(2024, 1, 30)
CARD = "trx_id string, account_id string, merchant_id string, amount double, trx_timestamp timestamp, trx_date date"


def card(trx_id, when, account="a", amount=10.0, merchant="m"):
    moment = ts(when)
    return (trx_id, account, merchant, amount, moment, moment.date())


@pytest.mark.parametrize(
    "points, km",
    [
        ((0.0, 0.0, 0.0, 180.0), 20015.087),
        ((12.5, 7.0, 12.5, 7.0), 0.0),
        ((None, 0.0, 0.0, 0.0), -1.0),
        ((0.0, 0.0, 0.0, None), -1.0),
        ((48.8566, 2.3522, 51.5074, -0.1278), 343.556),
    ],
)
def test_distance(spark, points, km):
    df = spark.createDataFrame([points], "a double, b double, c double, d double")
    assert df.select(haversine_km(*[F.col(c) for c in "abcd"])).first()[0] == pytest.approx(km, abs=1e-3)


def test_antipodes_are_never_nan(spark):
    grid = spark.range(0, 181, 3).select((F.col("id") - 90).cast("double").alias("lat")).crossJoin(
        spark.range(0, 360, 7).select((F.col("id") - 180).cast("double").alias("lon"))
    )
    km = haversine_km(F.col("lat"), F.col("lon"), -F.col("lat"), F.col("lon") + 180)
    low, high = grid.select(F.min(km), F.max(km)).first()
    assert low == pytest.approx(20015.087, abs=0.01) and high == pytest.approx(20015.087, abs=0.01)


def test_profile_bounds_and_single_row(spark):
    trx = spark.createDataFrame(
        [
            card("before", "2023-10-31 23:59:59", amount=999.0),
            card("first", "2023-11-01 00:00:00", amount=10.0),
            card("last", "2024-01-29 23:59:59", amount=20.0),
            card("today", "2024-01-30 00:00:00", amount=999.0),
            card("one", "2024-01-01 00:00:00", account="b", amount=5.0),
        ],
        CARD,
    )
    got = {r["account_id"]: r for r in fraud.account_profile(trx, DAY).collect()}
    assert got["a"]["avg_trx_amount_90d"] == 15.0
    assert got["a"]["avg_daily_trx_count"] == pytest.approx(2 / 90)
    assert got["b"]["stddev_trx_amount_90d"] == 0.0


def test_velocity_edges(spark):
    day = spark.createDataFrame(
        [card("1", "2024-01-30 10:00:00"), card("2", "2024-01-30 11:00:00"), card("3", "2024-01-30 11:00:01"), card("4", "2024-01-30 11:00:01")],
        CARD,
    )
    got = {r["trx_id"]: r["trx_last_hour_cnt"] for r in fraud.with_velocity(day).collect()}
    assert got == {"1": 1, "2": 2, "3": 3, "4": 3}
    before = spark.createDataFrame([card("0", "2024-01-29 23:30:00")], CARD)
    early = spark.createDataFrame([card("5", "2024-01-30 00:10:00")], CARD)
    assert fraud.with_velocity(early).first()["trx_last_hour_cnt"] == 1
    assert fraud.with_velocity(early, context=before).first()["trx_last_hour_cnt"] == 2


@pytest.mark.parametrize(
    "distance, z, count, points",
    [
        (500.0, 3.0, 5, (0, 20, 15)),
        (500.1, 3.1, 6, (30, 40, 30)),
        (-1.0, 2.0, 3, (0, 0, 0)),
        (0.0, -9.0, 4, (0, 0, 15)),
    ],
)
def test_points(spark, distance, z, count, points):
    df = spark.createDataFrame(
        [(distance, z, count)], "distance_from_home_km double, amount_z_score double, trx_last_hour_cnt long"
    )
    row = fraud.with_fraud_score(fraud.with_risk_points(df)).first()
    assert (row["distance_risk_score"], row["amount_risk_score"], row["velocity_risk_score"]) == points
    assert row["fraud_score"] == sum(points)
    assert row["is_fraud_alert"] == (sum(points) >= 60)


def test_alert_at_exactly_sixty(spark):
    df = spark.createDataFrame([(30, 0, 30)], "distance_risk_score int, amount_risk_score int, velocity_risk_score int")
    assert fraud.with_fraud_score(df).first()["is_fraud_alert"] is True


def test_scores(spark):
    trx = spark.createDataFrame(
        [card("h1", "2024-01-10 10:00:00", amount=10.0), card("h2", "2024-01-11 10:00:00", amount=12.0)]
        + [card(f"t{i}", f"2024-01-30 10:0{i}:00", amount=100.0) for i in range(6)]
        + [card("new", "2024-01-30 10:00:00", account="b"), card("gone", "2024-01-30 10:00:00", account="zz")]
        + [card("lost", "2024-01-30 23:00:00", merchant="zz")],
        CARD,
    )
    accounts = spark.createDataFrame(
        [("a", 0.0, 0.0), ("b", 0.0, 0.0)], "account_id string, home_lat double, home_lon double"
    )
    merchants = spark.createDataFrame([("m", 0.0, 90.0)], "merchant_id string, merchant_lat double, merchant_lon double")
    result = fraud.fraud_scores(trx, accounts, merchants, DAY)
    got = {r["trx_id"]: r for r in result.collect()}
    assert set(got) == {"t0", "t1", "t2", "t3", "t4", "t5", "new", "lost"}
    assert [got[f"t{i}"]["fraud_score"] for i in range(6)] == [70, 70, 70, 85, 85, 100]
    # No profile: no amount points. No merchant: no distance points.
    assert (got["new"]["amount_z_score"], got["new"]["fraud_score"]) == (0.0, 30)
    assert (got["lost"]["distance_from_home_km"], got["lost"]["fraud_score"]) == (-1.0, 0)
    assert result.columns == [
        "trx_id", "account_id", "amount", "distance_from_home_km", "amount_z_score", "trx_last_hour_cnt",
        "fraud_score", "is_fraud_alert", "scoring_date",
    ]
    assert "Python" not in plan_of(result)
