import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import HotSplit
from tallyworks.plans import balances, ledger
from tests.conftest import ts

DAY = dt.date(2024, 1, 2)
RAW = (
    "trx_uuid string, source_account_id string, destination_account_id string, transaction_type string,"
    " amount_base_currency decimal(18,4), currency_code string, exchange_rate decimal(10,4),"
    " transaction_timestamp timestamp, merchant_category_code string, channel string, status string, error_code string"
)
FACT = (
    "trx_uuid string, customer_id string, customer_segment string, region_id string,"
    " normalized_usd_amount decimal(18,4), merchant_category_code string, destination_account_id string, trx_date date"
)


def trx(uuid, amount="1", rate=None, when="2024-01-02 10:00:00", kind="PAYMENT", status="COMPLETED", source="a", dest="b"):
    return (uuid, source, dest, kind, Decimal(amount), "USD", rate, ts(when), "5411", "WEB", status, None)


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


@pytest.fixture
def dims(spark):
    accounts = spark.createDataFrame(
        [("a", "c1", "EUROPE"), ("n", "c9", None)], "account_id string, customer_id string, region_id string"
    )
    customers = spark.createDataFrame(
        [("c1", "RETAIL", "VERIFIED")], "customer_id string, customer_segment string, kyc_status string"
    )
    return accounts, customers


def test_day_slice_is_half_open(spark):
    rows = [trx("x", when=w) for w in ("2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-02 23:59:59", "2024-01-03 00:00:00")]
    assert ledger.day_slice(raw(spark, rows), DAY).count() == 2


def test_missing_rate_counts_as_one(spark):
    df = ledger.with_normalized_amount(raw(spark, [trx("x", "10"), trx("y", "10", Decimal("1.5"))]))
    assert [r[0] for r in df.orderBy("trx_uuid").select("normalized_usd_amount").collect()] == [
        Decimal("10.0000"),
        Decimal("15.0000"),
    ]


def test_rolling_window_spans_eleven_rows(spark):
    rows = [trx(f"{i:02}", when=f"2024-01-02 10:00:{i:02}") for i in range(12)]
    df = ledger.with_rolling_amount(raw(spark, rows))
    assert df.orderBy(F.col("trx_uuid").desc()).first()["rolling_10_trx_amount"] == 11


@pytest.mark.parametrize("split", [HotSplit(), HotSplit(share=0.2, floor=0)])
def test_enrich(spark, dims, split):
    rows = [trx(f"{i:02}", when=f"2024-01-02 10:00:{i:02}") for i in range(30)]
    rows += [
        trx("other-day", when="2024-01-03 00:00:00"),
        trx("failed", status="FAILED"),
        trx("reversal", kind="INTERNAL_TRANSFER_REVERSAL"),
        trx("no-type", kind=None),
        trx("no-region", source="n"),
        trx("no-account", source="zz"),
        trx("null-account", source=None),
    ]
    facts = ledger.enrich_ledger(raw(spark, rows), *dims, DAY, split=split)
    got = {r["trx_uuid"]: r for r in facts.collect()}
    assert facts.count() == len(got) == 33
    assert [got[f"{i:02}"]["rolling_10_trx_amount"] for i in range(30)] == [min(i + 1, 11) for i in range(30)]
    assert {(got[f"{i:02}"]["customer_id"], got[f"{i:02}"]["region_id"]) for i in range(30)} == {("c1", "EUROPE")}
    # The account is known, its owner is not.
    assert (got["no-region"]["customer_id"], got["no-region"]["region_id"]) == (None, "UNKNOWN")
    assert (got["no-account"]["customer_segment"], got["null-account"]["region_id"]) == (None, "UNKNOWN")


def facts(spark, groups):
    rows = []
    for customer, segment, amounts in groups:
        rows += [(f"{customer}{i}", customer, segment, "EU", Decimal(a), "7995", f"d{i % 2}", DAY) for i, a in enumerate(amounts)]
    return spark.createDataFrame(rows, FACT)


def test_risk_flags(spark):
    groups = [
        ("edge", "RETAIL", ["50000"]),
        ("both", "RETAIL", ["600"] * 101),
        ("premium", "PREMIUM", ["600"] * 101),
        ("hundred", "PREMIUM", ["600"] * 100),
    ]
    got = {r["customer_id"]: r for r in ledger.risk_daily_summary(facts(spark, groups), DAY).collect()}
    assert {k: r["daily_risk_flag"] for k, r in got.items()} == {
        "edge": "LOW",
        "both": "HIGH",
        "premium": "MEDIUM",
        "hundred": "LOW",
    }
    both = got["both"]
    assert (both["total_daily_transactions"], both["high_risk_mcc_count"], both["unique_destinations_count"]) == (101, 101, 2)
    assert both["summary_date"] == "2024-01-02"


def movement_fact(spark, rows):
    schema = "destination_account_id string, source_account_id string, transaction_type string, amount_base_currency decimal(18,4), trx_date date"
    return spark.createDataFrame([(d, s, k, Decimal(a), DAY) for d, s, k, a in rows], schema)


def test_movements(spark):
    rows = [
        ("b", "a", "PAYMENT", "5"),
        ("b", "a", "FEE", "1"),
        ("b", "a", "REVERSAL_CREDIT", "2"),
        ("b", "a", None, "100"),
        (None, "a", "PAYMENT", "7"),
        ("b", None, "PAYMENT", "9"),
    ]
    fact = movement_fact(spark, rows)
    got = [tuple(r) for r in balances.daily_movements(fact, DAY).collect()]
    assert sorted(got, key=str) == sorted(
        [
            ("a", Decimal("0.0000"), Decimal("13.0000")),
            ("b", Decimal("16.0000"), Decimal("0.0000")),
            (None, Decimal("7.0000"), Decimal("0.0000")),
            (None, Decimal("0.0000"), Decimal("9.0000")),
        ],
        key=str,
    )
    assert {r["account_id"] for r in balances.daily_movements(fact, DAY, null_accounts=False).collect()} == {"a", "b"}
    # Every leg is counted once: the two sides agree with the separate sums.
    assert balances.daily_credits(fact, DAY).agg(F.sum("total_credits")).first()[0] == Decimal("23.0000")
    assert balances.daily_debits(fact, DAY).agg(F.sum("total_debits")).first()[0] == Decimal("22.0000")


@pytest.fixture
def snapshot(spark):
    accounts = spark.createDataFrame(
        [
            ("a", "c", "SAVINGS", "OPEN", "EU"),
            ("new", "c", "SAVINGS", "DORMANT", None),
            ("minus", "c", "SAVINGS", "FROZEN", "EU"),
            ("closed", "c", "CHECKING", "CLOSED", "EU"),
        ],
        "account_id string, customer_id string, account_type string, status string, region_code string",
    ).withColumns({"open_date": F.lit(dt.date(2020, 1, 1)), "currency_code": F.lit("USD")})
    previous = spark.createDataFrame(
        [("a", DAY - dt.timedelta(days=1), Decimal("9000")), ("a", DAY, Decimal("1")), ("minus", DAY - dt.timedelta(days=1), Decimal("-1"))],
        "account_id string, balance_date date, ending_balance decimal(18,4)",
    )
    fact = movement_fact(spark, [("a", "closed", "PAYMENT", "1000"), (None, "closed", "PAYMENT", "3")])
    result = balances.eod_balances(accounts, previous, balances.daily_movements(fact, DAY), DAY, dt.datetime(2024, 1, 3))
    return {r["account_id"]: r for r in result.collect()}


def test_eod_balances(snapshot):
    assert set(snapshot) == {"a", "new", "minus"}
    for row in snapshot.values():
        assert row["ending_balance"] == row["beginning_balance"] + row["total_credits"] - row["total_debits"]
    assert snapshot["a"]["ending_balance"] == 10000
    assert snapshot["a"]["interest_accrued"] == Decimal("1.3699")
    assert (snapshot["new"]["beginning_balance"], snapshot["new"]["interest_accrued"]) == (0, 0)
    assert snapshot["new"]["region_code"] == "UN"
    assert (snapshot["minus"]["is_overdrawn"], snapshot["minus"]["interest_accrued"]) == (True, 0)
    assert snapshot["a"]["etl_timestamp"] == ts("2024-01-03")


def test_days_chain(spark):
    """Yesterday's result is today's input: movements over two days add up."""
    accounts = spark.createDataFrame(
        [("a", "c", "CHECKING", "OPEN", "EU", dt.date(2020, 1, 1), "USD")],
        "account_id string, customer_id string, account_type string, status string, region_code string, open_date date, currency_code string",
    )
    fact = movement_fact(spark, [("a", "x", "PAYMENT", "10.5"), ("x", "a", "PAYMENT", "4")])
    empty = spark.createDataFrame([], "account_id string, balance_date date, ending_balance decimal(18,4)")
    first = balances.eod_balances(accounts, empty, balances.daily_movements(fact, DAY), DAY)
    tomorrow = DAY + dt.timedelta(days=1)
    second = balances.eod_balances(
        accounts, first, balances.daily_movements(fact.withColumn("trx_date", F.lit(tomorrow)), tomorrow), tomorrow
    )
    assert second.first()["ending_balance"] == Decimal("13.0000")
