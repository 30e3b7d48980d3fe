"""Customer dimension from customer, KYC and account files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import instant
from tallyworks.operators import keep_latest_ties, latest_per_key
from tallyworks.rules import SegmentRules


def latest_kyc(kyc: DataFrame, ties: str = "all") -> DataFrame:
    """The newest verification per customer; undated ones are ignored.

    ``ties="all"`` keeps every record of the newest date, ``"one"`` the largest by status and rating.
    """
    dated = kyc.filter(F.col("verification_date").isNotNull())
    if ties == "all":
        newest = keep_latest_ties(dated, ["customer_id"], "verification_date")
    elif ties == "one":
        order = [F.col(c).desc() for c in ("verification_date", "status", "risk_rating")]
        newest = latest_per_key(dated, ["customer_id"], order)
    else:
        raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")
    return newest.withColumnsRenamed({"status": "kyc_status", "risk_rating": "kyc_risk_rating"})


def funding_totals(accounts: DataFrame) -> DataFrame:
    """Initial deposits and the last opening date over a customer's active accounts."""
    return (
        accounts.filter(F.col("account_status") == "ACTIVE")
        .groupBy("customer_id")
        .agg(
            F.sum("initial_deposit").alias("total_initial_deposit"),
            F.max("open_date").alias("last_account_open_date"),
        )
    )


def with_segment(df: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    funding = F.col("total_initial_deposit")
    segment = (
        F.when(funding > rules.wealth_above, "PRIVATE_WEALTH")
        .when(funding.between(rules.premium_from, rules.wealth_above), "PREMIUM")
        .when(F.col("kyc_status") == rules.rejected_status, "RESTRICTED")
        .otherwise("RETAIL")
    )
    return df.withColumn("customer_segment", segment)


def customer_dim(
    customers: DataFrame,
    kyc: DataFrame,
    accounts: DataFrame,
    as_of_ts: dt.datetime | None = None,
    rules: SegmentRules = SegmentRules(),
    ties: str = "all",
) -> DataFrame:
    """One row per customer and newest KYC record, with funding, segment and opening month.

    KYC grows with the customers, so it carries no broadcast hint; Spark broadcasts it where its
    measured size allows.
    """
    joined = customers.join(
        latest_kyc(kyc, ties).select("customer_id", "kyc_status", "kyc_risk_rating"), "customer_id", "left"
    ).join(funding_totals(accounts), "customer_id", "left")
    dim = joined.select(
        "customer_id",
        "first_name",
        "last_name",
        F.col("ssn_hash").alias("national_id_hash"),
        F.col("dob").alias("date_of_birth"),
        F.col("address.state").alias("state_code"),
        F.coalesce("kyc_status", F.lit("PENDING")).alias("kyc_status"),
        F.coalesce("kyc_risk_rating", F.lit("UNKNOWN")).alias("risk_rating"),
        F.coalesce("total_initial_deposit", F.lit(0.0)).alias("total_initial_deposit"),
        "last_account_open_date",
        instant(as_of_ts).alias("etl_insert_ts"),
        F.col("address.country").alias("country_code"),
    )
    return with_segment(dim, rules).select(
        *[c for c in dim.columns if c != "country_code"],
        "customer_segment",
        F.year("last_account_open_date").alias("onboarding_year"),
        F.month("last_account_open_date").alias("onboarding_month"),
        "country_code",
    )
