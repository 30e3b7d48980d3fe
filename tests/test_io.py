import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyworks import jobs, schemas, sinks
from tallyworks.session import scratch_dir
from tallyworks.sources import read_csv, read_json, read_table
from tests.conftest import plan_of, ts

DAY = dt.date(2024, 1, 2)
NEXT = dt.date(2024, 1, 3)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, day date, region string")


def content(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def test_scratch_is_below_the_shared_folder(spark):
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_partition_overwrite_of_a_path(spark):
    path = scratch_dir(spark, "t")
    parts = ["day", "region"]
    assert sinks.write_partitions(frame(spark, [(1, "a", DAY, "EU"), (2, "a", DAY, "US"), (3, "a", NEXT, "EU")]), path, parts) == 3
    assert sinks.write_partitions(frame(spark, [(4, "b", DAY, "EU")]), path, parts) == 1
    assert content(spark.read.parquet(path)) == [(2, "a"), (3, "a"), (4, "b")]


MODE = "spark.sql.sources.partitionOverwriteMode"


@pytest.fixture(params=["static", "dynamic"])
def session_mode(spark, request):
    before = spark.conf.get(MODE)
    spark.conf.set(MODE, request.param)
    yield request.param
    spark.conf.set(MODE, before)


def test_partition_overwrite_of_a_table(spark, session_mode):
    table = f"overwrite_{session_mode}"
    parts = ["day", "region"]
    rows = frame(spark, [(1, "a", DAY, "EU"), (2, "a", DAY, "US"), (3, "a", NEXT, None)])
    sinks.ensure_table(spark, table, rows.schema, parts, "parquet", scratch_dir(spark, table))
    sinks.overwrite_table_partitions(rows, table, parts)
    # Columns in another order land where they belong.
    sinks.overwrite_table_partitions(frame(spark, [(4, "b", DAY, "EU")]).select("region", "v", "day", "id"), table, parts)
    assert content(read_table(spark, table)) == [(2, "a"), (3, "a"), (4, "b")]
    assert read_table(spark, table).filter("region is null").count() == 1
    assert spark.conf.get(MODE) == session_mode


def test_append_matches_columns_by_name_and_counts(spark):
    rows = frame(spark, [(1, "a", DAY, "EU"), (2, "b", DAY, "EU")])
    sinks.ensure_table(spark, "append_here", rows.schema, ["day"], "orc", scratch_dir(spark, "append"))
    assert sinks.append_rows(rows, "append_here", ["day"]) == 2
    assert sinks.append_rows(rows.select("region", "day", "v", "id"), "append_here", ["day"]) == 2
    assert content(read_table(spark, "append_here")) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]


@pytest.mark.parametrize("external", [True, False])
def test_replace_drops_old_partitions(spark, session_mode, external):
    where = scratch_dir(spark, "replace") if external else None
    table = f"replaced_{session_mode}_{external}"
    sinks.replace_table(frame(spark, [(1, "a", DAY, "EU")]), table, ["region"], "orc", where)
    sinks.replace_table(frame(spark, [(2, "b", DAY, "US")]), table, ["region"], "orc", where)
    assert content(read_table(spark, table)) == [(2, "b")]


def test_run_date_can_be_run_again(spark):
    path = scratch_dir(spark, "runs")
    for day, value in ((DAY, "old"), (NEXT, "other"), (DAY, "new")):
        sinks.write_run(frame(spark, [(1, value, day, "EU")]), path, day)
    assert content(spark.read.parquet(path)) == [(1, "new"), (1, "other")]


def test_run_date_can_be_emptied(spark):
    path = scratch_dir(spark, "runs")
    for day, rows in ((DAY, [(1, "old", DAY, "EU")]), (NEXT, [(1, "other", NEXT, "EU")]), (DAY, [])):
        assert sinks.write_run(frame(spark, rows), path, day) == len(rows)
    assert content(spark.read.parquet(path)) == [(1, "other")]


@pytest.mark.parametrize("again", [[(2, "new", DAY, "EU")], []])
def test_second_run_of_a_day_leaves_nothing_of_the_first(spark, session_mode, again):
    table, parts = f"day_again_{session_mode}_{len(again)}", ["day", "region"]
    first = frame(spark, [(2, "old", DAY, "UN"), (3, "kept", NEXT, "UN")])
    sinks.ensure_table(spark, table, first.schema, parts, "orc", scratch_dir(spark, "again"))
    for day, rows in ((DAY, first.filter("id = 2")), (NEXT, first.filter("id = 3")), (DAY, frame(spark, again))):
        assert sinks.replace_day(rows, table, parts, day) == rows.count()
    assert content(read_table(spark, table)) == sorted([(3, "kept"), *[(i, v) for i, v, *_ in again]])


def test_csv_columns_are_found_by_name(spark):
    path = scratch_dir(spark, "csv")
    row = dict(open_date="2024-01-02", account_no="7", initial_deposit="1.5", customer_id="c", account_status="ACTIVE")
    spark.range(1).select(*[F.lit(v).alias(c) for c, v in row.items()]).write.csv(path, header=True)
    assert tuple(read_csv(spark, path, schemas.FUNDING_ACCOUNTS).first()) == tuple(
        {"initial_deposit": 1.5, "open_date": DAY}.get(c, row[c]) for c in schemas.FUNDING_ACCOUNTS.names
    )


def test_readers_use_the_given_schema(spark):
    path = scratch_dir(spark, "json")
    spark.range(1).select(F.lit('{"customer_id":"c","dob":"1990-01-02","address":{"country":"FR","state":"S"},"other":1}')).write.text(path)
    row = read_json(spark, path, schemas.RAW_CUSTOMERS).first()
    assert (row["dob"], row["address"]["country"], row["first_name"]) == (dt.date(1990, 1, 2), "FR", None)
    path = scratch_dir(spark, "csv")
    spark.range(1).select(F.lit("c").alias("customer_id"), F.lit("ACTIVE").alias("account_status"), F.lit("1.5").alias("initial_deposit"), F.lit("2024-01-02").alias("open_date")).write.csv(path, header=True)
    row = read_csv(spark, path, schemas.FUNDING_ACCOUNTS).first()
    assert (row["initial_deposit"], row["open_date"]) == (1.5, DAY)
    with pytest.raises(Exception, match="(?i)header"):
        wrong = StructType().add("x", "string").add("y", "string").add("z", "string").add("w", "string")
        read_csv(spark, path, wrong).collect()


def test_contract_names_missing_columns(spark):
    with pytest.raises(ValueError, match="exchange_rate"):
        schemas.require_columns(spark.range(1), schemas.RAW_TRANSACTIONS, "raw")


def test_filters_and_columns_reach_the_scan(spark, small):
    from checks.queries import BUILDERS, Inputs

    plan = plan_of(BUILDERS["account_profile_90d"](Inputs(spark, small)))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint,value:double>" in plan


def save(df, table):
    database = table.split(".")[0]
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    df.write.mode("overwrite").saveAsTable(table)


def make(spark, schema, rows):
    """Rows given as dictionaries; columns that are left out are null."""
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


@pytest.fixture(scope="module")
def warehouse(spark):
    trx = [
        dict(trx_uuid=f"t{i}", source_account_id="a1", destination_account_id="a2", transaction_type="PAYMENT",
             amount_base_currency=Decimal(10), transaction_timestamp=ts(f"2024-01-0{d} 10:00:0{i}"), status="SETTLED")
        for d in (2, 3) for i in range(3)
    ]
    save(make(spark, schemas.RAW_TRANSACTIONS, trx), "fin_landing.raw_transactions")
    accounts = [
        dict(account_id="a1", customer_id="c1", account_type="CHECKING", status="OPEN", region_id="EUROPE", region_code="EU", home_lat=0.0, home_lon=0.0),
        dict(account_id="a2", customer_id="c2", account_type="SAVINGS", status="OPEN"),
    ]
    save(make(spark, schemas.DIM_ACCOUNTS, accounts), "fin_core.dim_accounts")
    return spark


def test_ledger_and_balance_jobs(warehouse):
    spark = warehouse
    customers = [dict(customer_id="c1", customer_segment="RETAIL", kyc_status="VERIFIED")]
    save(make(spark, schemas.DIM_CUSTOMERS, customers), "fin_core.ledger_customers")
    for day in (DAY, NEXT, NEXT):
        counts = jobs.run_ledger(spark, day, customers="fin_core.ledger_customers")
        assert counts == {"fin_core.fact_transactions": 3, "fin_mart.risk_daily_summary": 1}
        assert jobs.run_daily_balances(spark, day, as_of_ts=dt.datetime(2024, 1, 4)) == 2
    assert spark.table("fin_core.fact_transactions").count() == 6
    assert spark.table("fin_mart.risk_daily_summary").count() == 2
    got = {(r["account_id"], r["balance_date"]): r["ending_balance"] for r in spark.table("fin_core.fact_daily_balances").collect()}
    assert got == {("a1", DAY): -30, ("a1", NEXT): -60, ("a2", DAY): 30, ("a2", NEXT): 60}


def test_fraud_job_can_be_run_again(warehouse):
    spark = warehouse
    trx = [dict(trx_id=f"x{i}", account_id="a1", merchant_id="m", amount=5.0, trx_timestamp=ts("2024-01-02 10:00:00"), trx_date=DAY) for i in range(4)]
    save(make(spark, schemas.CC_TRANSACTIONS, trx), "fin_core.cc_transactions")
    save(make(spark, schemas.DIM_MERCHANTS, [dict(merchant_id="m", merchant_lat=50.0, merchant_lon=0.0)]), "fin_core.dim_merchants")
    for _ in range(2):
        assert jobs.run_fraud_scores(spark, DAY) == 4
    scores = spark.table("fin_mart.fraud_scores_daily")
    assert scores.count() == 4 and {r["fraud_score"] for r in scores.collect()} == {45}


def test_onboarding_job(warehouse):
    spark = warehouse
    base = scratch_dir(spark, "landing")
    customers = [dict(customer_id="c1", first_name="A", address=("FR", "S")), dict(customer_id="c2", address=("DE", "T"))]
    make(spark, schemas.RAW_CUSTOMERS, customers).write.json(f"{base}/customers")
    make(spark, schemas.KYC_STATUS, [dict(customer_id="c1", verification_date=DAY, status="VERIFIED", risk_rating="LOW")]).write.parquet(f"{base}/kyc")
    make(spark, schemas.FUNDING_ACCOUNTS, [dict(customer_id="c1", account_status="ACTIVE", initial_deposit=5e5, open_date=DAY)]).write.csv(f"{base}/accounts", header=True)
    for _ in range(2):
        assert jobs.run_onboarding(spark, f"{base}/customers", f"{base}/kyc", f"{base}/accounts") == 2
    got = {r["customer_id"]: (r["customer_segment"], r["onboarding_year"], r["country_code"]) for r in spark.table("fin_core.dim_customers").collect()}
    assert got == {"c1": ("PREMIUM", 2024, "FR"), "c2": ("RETAIL", None, "DE")}


def test_history_job(warehouse):
    spark = warehouse
    updates = [dict(customer_id="c1", last_name=n, timestamp=ts(f"2024-01-0{d} 10:00:00")) for d, n in ((2, "A"), (3, "B"))]
    save(make(spark, schemas.CUSTOMER_UPDATES, updates), "fin_landing.customer_updates")
    assert jobs.run_customer_history(spark, DAY) == 1
    assert jobs.run_customer_history(spark, NEXT, target="fin_core.customers_next") == 2
    rows = {r["last_name"]: r["is_active"] for r in spark.table("fin_core.customers_next").collect()}
    assert rows == {"A": False, "B": True}
    assert jobs.run_customer_history(spark, NEXT, log=True) == 2
    assert jobs.run_customer_history(spark, NEXT, log=True) == 0
    active = spark.table("fin_core.dim_customers_scd2").filter("is_active")
    assert active.count() == active.select("customer_surrogate_key").distinct().count() == 2
    with pytest.raises(ValueError):
        jobs.run_customer_history(spark, NEXT, target="fin_core.dim_customers_scd2")


def test_history_job_replaces_the_history_by_default(warehouse):
    spark = warehouse
    updates = [dict(customer_id="c1", last_name=n, timestamp=ts(f"2024-01-0{d} 10:00:00")) for d, n in ((2, "A"), (3, "B"), (4, "C"))]
    save(make(spark, schemas.CUSTOMER_UPDATES, updates), "fin_landing.updates_by_day")
    for day, rows in ((DAY, 1), (NEXT, 2), (NEXT, 2), (NEXT + dt.timedelta(days=1), 3)):
        assert jobs.run_customer_history(spark, day, updates="fin_landing.updates_by_day", history="fin_core.history_by_day") == rows
    got = {r["last_name"]: r["is_active"] for r in spark.table("fin_core.history_by_day").collect()}
    assert got == {"A": False, "B": False, "C": True}


@pytest.mark.parametrize("quote_ids", [True, False])
def test_trading_job(warehouse, quote_ids):
    spark = warehouse
    base = scratch_dir(spark, "trading")
    at = lambda t: ts(f"2024-01-02 {t}")
    parents = [dict(order_id="o", client_id="c", ticker="T", side="BUY", requested_shares=100), dict(order_id="p", client_id="c", ticker="X", side="SELL", requested_shares=1)]
    events = [dict(order_id="o", client_id="c", trade_date=DAY, protocol_version="V2", event_type="FILL", status="FILLED", event_timestamp=at("15:00:00"), last_exec_price=11.0, last_exec_qty=50.0)]
    quotes = [dict(ticker="T", quote_timestamp=at("14:29:00"), best_bid=9.0, best_ask=11.0)]
    trades = [dict(ticker="T", trade_timestamp=at("16:00:00"), trade_price=10.0, trade_size=7)]
    for name, schema, rows in (("parents", schemas.PARENT_ORDERS, parents), ("events", schemas.ORDER_EVENTS, events), ("quotes", schemas.LEVEL1_QUOTES, quotes), ("trades", schemas.MARKET_TRADES, trades)):
        rows = make(spark, schema, rows)
        rows = rows.withColumn("quote_id", F.lit(1)) if name == "quotes" and quote_ids else rows
        rows.write.parquet(f"{base}/{name}")
    paths = {f"{n}_path": f"{base}/{n}" for n in ("parents", "events", "quotes", "trades")}
    for _ in range(2):
        assert jobs.run_trading_costs(spark, DAY, out_path=f"{base}/out", **paths) == 2
    got = {r["order_id"]: r for r in spark.read.parquet(f"{base}/out").collect()}
    assert len(got) == 2 and got["o"]["run_date"] == DAY
    assert (got["o"]["arrival_mid_price"], got["o"]["market_interval_vwap"], got["o"]["slippage_from_vwap_bps"]) == (10.0, 10.0, 1000.0)
    assert (got["o"]["implementation_shortfall_pl"], got["p"]["market_interval_volume"]) == (-50.0, None)
