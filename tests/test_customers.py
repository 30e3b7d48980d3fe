import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyworks.plans import onboarding, scd2
from tests.conftest import ts

D = dt.date
RUN = D(2024, 1, 1)


@pytest.fixture
def kyc(spark):
    rows = [
        ("tie", D(2024, 1, 5), "VERIFIED", "LOW"),
        ("tie", D(2024, 1, 5), "REJECTED", "HIGH"),
        ("tie", D(2024, 1, 1), "PENDING", "LOW"),
        ("undated", None, "VERIFIED", "LOW"),
        ("rejected", D(2024, 1, 5), "REJECTED", "HIGH"),
        ("edge", D(2024, 1, 5), "REJECTED", "HIGH"),
    ]
    return spark.createDataFrame(rows, "customer_id string, verification_date date, status string, risk_rating string")


def test_latest_kyc(kyc):
    rows = onboarding.latest_kyc(kyc).collect()
    assert sorted((r["customer_id"], r["kyc_status"]) for r in rows) == [
        ("edge", "REJECTED"),
        ("rejected", "REJECTED"),
        ("tie", "REJECTED"),
        ("tie", "VERIFIED"),
    ]
    one = {r["customer_id"]: r["kyc_status"] for r in onboarding.latest_kyc(kyc, ties="one").collect()}
    assert one == {"tie": "VERIFIED", "rejected": "REJECTED", "edge": "REJECTED"}
    with pytest.raises(ValueError):
        onboarding.latest_kyc(kyc, ties="some")


@pytest.mark.parametrize(
    "funding, status, expected",
    [
        (100000.0, "VERIFIED", "PREMIUM"),
        (1000000.0, "VERIFIED", "PREMIUM"),
        (1000000.01, "VERIFIED", "PRIVATE_WEALTH"),
        (100000.0, "REJECTED", "PREMIUM"),
        (99999.99, "REJECTED", "RESTRICTED"),
        (0.0, "PENDING", "RETAIL"),
    ],
)
def test_segments(spark, funding, status, expected):
    df = spark.createDataFrame([(funding, status)], "total_initial_deposit double, kyc_status string")
    assert onboarding.with_segment(df).first()["customer_segment"] == expected


def test_customer_dim(spark, kyc):
    names = ["tie", "undated", "bare"]
    customers = spark.createDataFrame(
        [(n, "F", "L", "h", D(1990, 1, 1), ("FR", "S")) for n in names],
        "customer_id string, first_name string, last_name string, ssn_hash string, dob date, address struct<country:string,state:string>",
    )
    accounts = spark.createDataFrame(
        [("tie", "ACTIVE", 40.0, D(2023, 5, 1)), ("tie", "ACTIVE", 2.0, D(2023, 7, 1)), ("tie", "CLOSED", 900.0, D(2024, 1, 1))],
        "customer_id string, account_status string, initial_deposit double, open_date date",
    )
    dim = onboarding.customer_dim(customers, kyc, accounts, dt.datetime(2024, 1, 2))
    rows = dim.collect()
    assert sorted(r["customer_id"] for r in rows) == ["bare", "tie", "tie", "undated"]
    bare = next(r for r in rows if r["customer_id"] == "bare")
    assert (bare["kyc_status"], bare["risk_rating"], bare["total_initial_deposit"]) == ("PENDING", "UNKNOWN", 0.0)
    assert (bare["customer_segment"], bare["onboarding_year"], bare["onboarding_month"]) == ("RETAIL", None, None)
    tie = next(r for r in rows if r["customer_id"] == "tie")
    assert (tie["total_initial_deposit"], tie["onboarding_year"], tie["onboarding_month"]) == (42.0, 2023, 7)
    assert (tie["country_code"], tie["state_code"], tie["etl_insert_ts"]) == ("FR", "S", ts("2024-01-02"))
    assert onboarding.customer_dim(customers, kyc, accounts, ties="one").count() == 3


ROW = "customer_id string, first_name string, last_name string, email_address string, phone_number string, residential_address string, marital_status string"


@pytest.fixture
def dim(spark):
    end, old = ts("9999-12-31 23:59:59"), ts("2020-01-01")
    active = ["same", "blank", "untracked", "changed", "silent", "twice"]
    rows = [(f"k-{n}", n, "F", "L", None, "1", "addr", "SINGLE", old, end, True) for n in active]
    rows.append(("k-old", "changed", "F", "Lold", None, "1", "addr", "SINGLE", ts("2015-01-01"), old, False))
    return spark.createDataFrame(
        rows, f"customer_surrogate_key string, {ROW}, effective_start_date timestamp, effective_end_date timestamp, is_active boolean"
    )


@pytest.fixture
def updates(spark):
    def row(name, when="2024-01-01 10:00:00", first="F", last="L", email=None, phone="1", status="SINGLE"):
        return (name, first, last, email, phone, "addr", status, ts(when))

    rows = [
        row("same"),
        row("blank", email=""),
        row("untracked", first="G", phone="2"),
        row("changed", last="M"),
        row("twice", "2024-01-01 09:00:00", last="OLD"),
        row("twice", "2024-01-01 11:00:00", last="NEW"),
        row("silent", "2024-01-02 00:00:00", last="LATER"),
        row("fresh", status=None),
        row(None),
    ]
    return spark.createDataFrame(rows, f"{ROW}, update_ts timestamp")


def test_changes(dim, updates):
    changes = scd2.scd2_changes(dim, scd2.updates_of_day(updates, RUN))
    got = {r["customer_id"]: r for r in changes.collect()}
    assert {k: r["change_type"] for k, r in got.items()} == {
        "same": "NO CHANGE",
        "blank": "NO CHANGE",
        "untracked": "NO CHANGE",
        "changed": "UPDATE",
        "twice": "UPDATE",
        "silent": "NO CHANGE",
        "fresh": "INSERT",
    }
    assert (got["twice"]["last_name_new"], got["twice"]["last_name_old"]) == ("NEW", "L")
    assert (got["fresh"]["old_sk"], got["silent"]["first_name_new"]) == (None, "F")
    assert scd2.rejected_updates(updates, RUN).count() == 1


def test_append_log_keeps_superseded_rows(dim, updates):
    changes = scd2.scd2_changes(dim, scd2.updates_of_day(updates, RUN))
    log = scd2.scd2_append(dim, changes, RUN)
    assert log.count() == dim.count() + 2 + 3
    assert log.filter("customer_id = 'changed' and is_active").count() == 2


def test_snapshot(dim, updates):
    changes = scd2.scd2_changes(dim, scd2.updates_of_day(updates, RUN))
    snapshot = scd2.scd2_apply(dim, changes, RUN)
    assert snapshot.count() == dim.count() + 3
    active = snapshot.filter("is_active").groupBy("customer_id").count()
    assert active.filter("count <> 1").count() == 0 and active.count() == 7
    changed = {r["customer_surrogate_key"]: r for r in snapshot.filter("customer_id = 'changed'").collect()}
    assert len(changed) == 3
    retired, opened = changed["k-changed"], next(r for r in changed.values() if r["is_active"])
    # Validity is half open: the old end is the new start.
    assert retired["effective_end_date"] == opened["effective_start_date"] == ts("2024-01-01")
    assert (retired["last_name"], opened["last_name"], retired["is_active"]) == ("L", "M", False)
    overlaps = snapshot.alias("x").join(
        snapshot.alias("y"),
        (F.col("x.customer_id") == F.col("y.customer_id"))
        & (F.col("x.effective_start_date") < F.col("y.effective_start_date"))
        & (F.col("x.effective_end_date") > F.col("y.effective_start_date")),
    )
    assert overlaps.count() == 0


def test_running_a_day_again_changes_nothing(dim, updates):
    day = scd2.updates_of_day(updates, RUN)
    once = scd2.scd2_apply(dim, scd2.scd2_changes(dim, day), RUN)
    again = scd2.scd2_apply(once, scd2.scd2_changes(once, day), RUN)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    assert once.filter("customer_id = 'fresh'").first()[0] == again.filter("customer_id = 'fresh'").first()[0]
