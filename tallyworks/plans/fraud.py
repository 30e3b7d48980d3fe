"""Rule-based scoring of card transactions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions import haversine_km
from tallyworks.operators import trailing_count
from tallyworks.rules import FraudRules

PROFILE = ("avg_trx_amount_90d", "stddev_trx_amount_90d", "avg_daily_trx_count")


def trx_of_day(trx: DataFrame, run_date: dt.date) -> DataFrame:
    return trx.filter(F.col("trx_date") == F.lit(run_date))


def account_profile(trx: DataFrame, run_date: dt.date, rules: FraudRules = FraudRules()) -> DataFrame:
    """Spending profile per account over the days before the run date.

    A single transaction has no deviation (0). The rate divides by the length of the period, not by
    the days with activity.
    """
    first = run_date - dt.timedelta(days=rules.profile_days)
    last = run_date - dt.timedelta(days=1)
    return (
        trx.filter(F.col("trx_date").between(F.lit(first), F.lit(last)))
        .groupBy("account_id")
        .agg(
            F.avg("amount").alias("avg_trx_amount_90d"),
            F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("stddev_trx_amount_90d"),
            (F.count("trx_id") / F.lit(float(rules.profile_days))).alias("avg_daily_trx_count"),
        )
    )


def daily_moments(trx: DataFrame) -> DataFrame:
    """Per account and day what profiles of any period are merged from: counts, sums and squared deviations of the amount.

    The sum is kept as that of the whole numbers, which is exact, and that of the rests, so the means of days differ by what they
    really differ. Stored by ``trx_date``, a day's rows are written once; profiles of later days read them instead of facts.
    """
    counted = F.count("amount")
    whole = F.rint("amount")
    return trx.groupBy("account_id", "trx_date").agg(
        F.count("trx_id").alias("n_trx"),
        counted.alias("n_amounts"),
        F.sum(whole).alias("whole_sum"),
        F.sum(F.col("amount") - whole).alias("rest_sum"),
        (F.var_pop("amount") * counted).alias("squared_deviations"),
    )


def profile_from_moments(moments: DataFrame, run_date: dt.date, rules: FraudRules = FraudRules()) -> DataFrame:
    """The profile of ``account_profile`` from the daily moments of the period.

    Means and deviations are merged around a whole number next to the smallest daily mean, never as differences of sums of squares,
    so amounts that differ little from one another keep their deviation however large they are. Rows of one
    account and day add up, so a day that is stored in parts needs no second pass.
    """
    first = run_date - dt.timedelta(days=rules.profile_days)
    last = run_date - dt.timedelta(days=1)
    period = moments.filter(F.col("trx_date").between(F.lit(first), F.lit(last)))
    n = F.col("n_amounts")
    near = F.min(F.rint(F.try_divide(F.col("whole_sum"), n))).over(Window.partitionBy("account_id"))
    shift = F.col("whole_sum") - n * F.col("_near") + F.col("rest_sum")
    merged = (
        period.withColumn("_near", near)
        .withColumn("_shift", shift)
        .groupBy("account_id")
        .agg(
            F.sum("n_trx").alias("_trx"),
            F.sum(n).alias("_n"),
            F.min("_near").alias("_near"),
            F.sum("_shift").alias("_first"),
            F.sum(F.col("squared_deviations") + F.try_divide(F.col("_shift") * F.col("_shift"), n)).alias("_second"),
        )
    )
    off = F.try_divide(F.col("_first"), F.col("_n"))
    spread = F.greatest(F.col("_second") - F.col("_first") * off, F.lit(0.0))
    return merged.select(
        "account_id",
        (F.col("_near") + off).alias("avg_trx_amount_90d"),
        F.coalesce(F.when(F.col("_n") > 1, F.sqrt(spread / (F.col("_n") - 1))), F.lit(0.0)).alias("stddev_trx_amount_90d"),
        (F.col("_trx") / F.lit(float(rules.profile_days))).alias("avg_daily_trx_count"),
    )


def _account_features(
    trx: DataFrame, accounts: DataFrame, run_date: dt.date, rules: FraudRules, moments: DataFrame | None = None
) -> DataFrame:
    """Home location and profile per account; joined before they meet the transactions."""
    profile = account_profile(trx, run_date, rules) if moments is None else profile_from_moments(moments, run_date, rules)
    return accounts.select("account_id", "home_lat", "home_lon").join(profile, "account_id", "left")


def with_distance(df: DataFrame) -> DataFrame:
    points = [F.col(c) for c in ("home_lat", "home_lon", "merchant_lat", "merchant_lon")]
    return df.withColumn("distance_from_home_km", haversine_km(*points))


def fraud_features(
    trx: DataFrame, accounts: DataFrame, merchants: DataFrame, run_date: dt.date, rules: FraudRules = FraudRules()
) -> DataFrame:
    """The day's transactions of known accounts with locations, distance and the account's profile."""
    return with_distance(
        trx_of_day(trx, run_date)
        .join(_account_features(trx, accounts, run_date, rules), "account_id")
        .join(merchants.select("merchant_id", "merchant_lat", "merchant_lon"), "merchant_id", "left")
    )


def velocity(day: DataFrame, rules: FraudRules = FraudRules(), context: DataFrame | None = None) -> DataFrame:
    """``trx_last_hour_cnt`` per account and ``_second``.

    Only the given day is counted, so its first hour sees fewer rows; ``context`` adds the rows of
    the hour before midnight.
    """
    counted = ["account_id", "trx_timestamp", "trx_id"]
    rows = day.select(*counted)
    if context is not None:
        rows = rows.unionByName(context.select(*counted))
    return trailing_count(
        rows, "account_id", "trx_timestamp", "trx_id", rules.velocity_seconds, "trx_last_hour_cnt"
    )


def _join_by_second(day: DataFrame, per_second: DataFrame, how: str) -> DataFrame:
    right = per_second.withColumnsRenamed({"account_id": "_account", "_second": "_at"})
    same = (F.col("account_id") == F.col("_account")) & F.unix_timestamp("trx_timestamp").eqNullSafe(F.col("_at"))
    return day.join(right, same, how).drop("_account", "_at")


def with_velocity(df: DataFrame, rules: FraudRules = FraudRules(), context: DataFrame | None = None) -> DataFrame:
    """Add the number of the account's transactions in the last hour, peers of the second included."""
    return _join_by_second(df, velocity(df, rules, context), "left")


def with_amount_zscore(df: DataFrame) -> DataFrame:
    """Distance from the mean in deviations; 0.0 without a profile or deviation."""
    deviation = F.col("stddev_trx_amount_90d")
    score = (F.col("amount") - F.col("avg_trx_amount_90d")) / deviation
    return df.withColumn("amount_z_score", F.when(deviation > 0, score).otherwise(F.lit(0.0)))


def _steps(value: Column, steps: Sequence[tuple[float, int]]) -> Column:
    """Points of the first step the value lies above, 0 below all of them."""
    (bound, points), *rest = steps
    result = F.when(value > bound, points)
    for bound, points in rest:
        result = result.when(value > bound, points)
    return result.otherwise(0)


def with_risk_points(df: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    """Points for distance, amount and velocity."""
    return df.withColumns(
        {
            "distance_risk_score": _steps(F.col("distance_from_home_km"), ((rules.far_km, rules.far_points),)),
            "amount_risk_score": _steps(F.col("amount_z_score"), rules.amount_steps),
            "velocity_risk_score": _steps(F.col("trx_last_hour_cnt"), rules.velocity_steps),
        }
    )


def with_fraud_score(df: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    score = F.col("distance_risk_score") + F.col("amount_risk_score") + F.col("velocity_risk_score")
    return df.withColumn("fraud_score", score).withColumn("is_fraud_alert", F.col("fraud_score") >= rules.alert_score)


def hour_before(trx: DataFrame, run_date: dt.date, rules: FraudRules = FraudRules()) -> DataFrame:
    """Transactions that the velocity of the run date's first hour looks back to, from the day before."""
    midnight = F.lit(run_date).cast("timestamp")
    oldest = midnight - F.expr(f"INTERVAL {rules.velocity_seconds} SECONDS")
    days = F.col("trx_date").between(F.lit(run_date - dt.timedelta(days=1 + rules.velocity_seconds // 86_400)), F.lit(run_date - dt.timedelta(days=1)))
    return trx.filter(days & (F.col("trx_timestamp") >= oldest) & (F.col("trx_timestamp") < midnight))


def scored_transactions(
    trx: DataFrame,
    accounts: DataFrame,
    merchants: DataFrame,
    run_date: dt.date,
    rules: FraudRules = FraudRules(),
    context: DataFrame | None = None,
    moments: DataFrame | None = None,
) -> DataFrame:
    """The day's transactions with every feature and the points.

    ``context`` (from ``hour_before``) lets the velocity of the first hour see the day before; with ``moments`` the profile
    comes from stored daily moments, and of the facts only the day is read.

    Velocity and account features are joined with each other by account, then once with the
    transactions by account and second. A hot account is so spread over its seconds.
    """
    day = trx_of_day(trx, run_date)
    features = velocity(day, rules, context).join(_account_features(trx, accounts, run_date, rules, moments), "account_id")
    joined = _join_by_second(day, features, "inner").join(
        merchants.select("merchant_id", "merchant_lat", "merchant_lon"), "merchant_id", "left"
    )
    return with_fraud_score(with_risk_points(with_amount_zscore(with_distance(joined)), rules), rules)


def fraud_scores(
    trx: DataFrame,
    accounts: DataFrame,
    merchants: DataFrame,
    run_date: dt.date,
    rules: FraudRules = FraudRules(),
    context: DataFrame | None = None,
    moments: DataFrame | None = None,
) -> DataFrame:
    """Score and alert flag per transaction of the run date; ``context`` and ``moments`` as for ``scored_transactions``."""
    return scored_transactions(trx, accounts, merchants, run_date, rules, context, moments).select(
        "trx_id",
        "account_id",
        "amount",
        "distance_from_home_km",
        "amount_z_score",
        "trx_last_hour_cnt",
        "fraud_score",
        "is_fraud_alert",
        F.lit(run_date.isoformat()).alias("scoring_date"),
    )
