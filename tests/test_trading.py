import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyworks.plans import tca
from tallyworks.rules import TcaRules
from tests.conftest import plan_of, ts

DAY = dt.date(2024, 1, 2)
EVENT = (
    "order_id string, client_id string, trade_date date, protocol_version string, status string, event_type string,"
    " event_timestamp timestamp, routing_timestamp timestamp, last_exec_price double, last_exec_qty double"
)
PARENT = "order_id string, client_id string, ticker string, side string, requested_shares long"


def event(order, kind, status, when, version="V2", routed=None, price=None, qty=None, day=DAY):
    moment = ts(f"2024-01-02 {when}")
    return (order, "c", day, version, status, kind, moment, None if routed is None else ts(f"2024-01-02 {routed}"), price, qty)


def fill(order, when, price=10.0, qty=100.0, **kw):
    return event(order, "FILL", "FILLED", when, price=price, qty=qty, **kw)


def test_fills(spark):
    rows = [
        event("v1", "TRADE", "FILLED", "15:00:00", "V1"),
        event("v1-busted", "TRADE", "BUSTED", "15:00:00", "V1"),
        event("v1-fill", "FILL", "FILLED", "15:00:00", "V1"),
        event("v2", "FILL", "ANY", "15:00:00"),
        event("v3", "FILL", None, "15:00:00", "V3"),
        event("v10", "FILL", "FILLED", "15:00:00", "V10"),
        event("none", "FILL", "FILLED", "15:00:00", None),
    ]
    got = {r["order_id"] for r in tca.fills(spark.createDataFrame(rows, EVENT)).collect()}
    assert got == {"v1", "v2", "v3"}


@pytest.fixture
def lifecycle(spark):
    rows = [
        fill("two", "15:05:00", 11.0, 300.0, routed="15:04:00"),
        fill("two", "15:01:00", 10.0, 100.0),
        event("two", "ACK", "NEW", "15:00:00", routed="14:59:00"),
        event("two", "ACK", "REPLACED", "14:58:30"),
        event("two", "ANY", "CANCELED", "15:10:00", routed="15:11:00"),
        fill("zero", "15:00:00", 10.0, 0.0),
        event("acked", "ACK", "NEW", "15:00:00"),
        fill("days", "15:00:00", day=dt.date(2024, 1, 1)),
        fill("days", "16:00:00"),
    ]
    parents = spark.createDataFrame(
        [(o, "c", "T", "BUY", 1000) for o in ("two", "zero", "acked", "days", "quiet")], PARENT
    )
    return tca.order_lifecycle(parents, spark.createDataFrame(rows, EVENT))


def test_lifecycle(lifecycle):
    got = {r["order_id"]: r for r in lifecycle.collect()}
    assert lifecycle.count() == len(got) == 5
    two = got["two"]
    assert two["fill_AverageExecutionPrice"] == 10.75
    assert (two["fill_NumberOfFills"], two["fill_TotalSharesExecuted"]) == (2, 400.0)
    assert (two["closing_price"], two["closing_qty"]) == (10.0, 100.0)
    assert two["fill_FillStartTime"] == ts("2024-01-02 15:01:00")
    assert two["ack_AckStartTime"] == ts("2024-01-02 14:58:30")
    assert two["term_ExecutionEndTime"] == ts("2024-01-02 15:11:00")
    assert (got["zero"]["fill_AverageExecutionPrice"], got["zero"]["fill_NumberOfFills"]) == (None, 1)
    assert (got["acked"]["fill_NumberOfFills"], got["quiet"]["ack_AckStartTime"]) == (None, None)
    # Two days of one order stay one row here and two rows in the daily summary.
    assert got["days"]["fill_NumberOfFills"] == 2


def test_daily_grain_and_last_fill(spark):
    events = spark.createDataFrame([fill("days", "15:00:00", day=dt.date(2024, 1, 1)), fill("days", "16:00:00", 12.0)], EVENT)
    assert tca.fill_summary(tca.fills(events)).count() == 2
    assert tca.boundary_fill(tca.fills(events), "last").first()["closing_price"] == 12.0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("day, opening", [("2024-01-02", "14:30"), ("2024-07-01", "13:30")])
def test_session_follows_daylight_saving(spark, zone, day, opening):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        market_open, _ = tca.session_bounds(dt.date.fromisoformat(day))
        seconds = spark.range(1).select(F.unix_seconds(market_open)).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert dt.datetime.fromtimestamp(seconds, dt.timezone.utc).strftime("%Y-%m-%d %H:%M") == f"{day} {opening}"


def test_effective_window(spark):
    schema = "o string, ack_AckStartTime timestamp, fill_FillStartTime timestamp, term_ExecutionEndTime timestamp"
    at = lambda t: None if t is None else ts(f"2024-01-02 {t}")
    rows = [
        ("no ack", None, at("15:00:00"), None),
        ("early fill", at("14:00:00"), at("14:10:00"), at("15:00:00")),
        ("late ack", at("16:00:00"), at("17:00:00"), at("23:00:00")),
        ("nothing", None, None, None),
    ]
    df = tca.effective_window(spark.createDataFrame(rows, schema), DAY)
    got = {r["o"]: (f"{r['EffectiveStartTime']:%H:%M}", f"{r['EffectiveEndTime']:%H:%M}") for r in df.collect()}
    assert got == {
        "no ack": ("14:30", "21:00"),
        "early fill": ("14:10", "15:00"),
        "late ack": ("16:00", "21:00"),
        "nothing": ("14:30", "21:00"),
    }


def orders_at(spark, start, end="20:00:00"):
    row = ("o", "c", "T", ts(f"2024-01-02 {start}"), ts(f"2024-01-02 {end}"))
    return spark.createDataFrame([row], "order_id string, client_id string, ticker string, EffectiveStartTime timestamp, EffectiveEndTime timestamp")


def quotes(spark, *rows):
    data = [(i, "T", ts(f"2024-01-02 {when}"), bid, bid + 0.1) for i, when, bid in rows]
    return spark.createDataFrame(data, "quote_id long, ticker string, quote_timestamp timestamp, best_bid double, best_ask double")


@pytest.mark.parametrize(
    "rows, bid",
    [
        ([(1, "14:50:00", 5.0)], 5.0),  # exactly ten minutes old
        ([(1, "14:49:59", 5.0)], None),
        ([(1, "15:00:00", 6.0), (2, "14:59:59", 7.0)], 6.0),  # at the order's time
        ([(7, "14:59:00", 6.0), (9, "14:59:00", 8.0), (8, "14:59:00", 7.0)], 8.0),  # largest id wins
        ([(1, "15:00:01", 6.0)], None),
    ],
)
def test_quote_edges(spark, rows, bid):
    found = tca.asof_quotes(orders_at(spark, "15:00:00"), quotes(spark, *rows)).first()
    assert (None if found is None else found["start_best_bid"]) == bid


def test_trades_on_both_edges_count(spark):
    data = [("T", ts(f"2024-01-02 {w}"), p, s) for w, p, s in [("15:00:00", 1.0, 1), ("20:00:00", 3.0, 3), ("14:59:59", 9.0, 9), ("20:00:01", 9.0, 9)]]
    trades = spark.createDataFrame(data, "ticker string, trade_timestamp timestamp, trade_price double, trade_size int")
    row = tca.market_interval_vwap(orders_at(spark, "15:00:00"), trades).first()
    assert (row["market_interval_volume"], row["market_interval_vwap"]) == (4, 2.5)


def test_measures_by_side(spark):
    columns = {
        "requested_shares": 1000, "fill_AverageExecutionPrice": 10.0, "fill_TotalSharesExecuted": 400.0,
        "market_interval_vwap": 8.0, "start_best_bid": 10.0, "start_best_ask": 12.0, "end_best_bid": 10.0,
        "end_best_ask": 10.0, "end_plus1_best_bid": 11.0, "end_plus1_best_ask": 11.0, "closing_price": 9.0,
    }
    df = spark.createDataFrame([("BUY",), ("SELL",), ("CROSS",)], "side string")
    df = df.withColumns({k: F.lit(v) for k, v in columns.items()})
    for measure in (tca.with_arrival_mid, tca.with_vwap_slippage, tca.with_shortfall, tca.with_momentum, tca.with_opportunity_cost):
        df = measure(df)
    got = {r["side"]: (r["slippage_from_vwap_bps"], r["implementation_shortfall_pl"], r["post_trade_1m_momentum"], r["opportunity_cost_pl"]) for r in df.collect()}
    assert got["BUY"] == (2500.0, 400.0, 400.0, 600.0)
    assert got["SELL"] == (-2500.0, -400.0, -400.0, -600.0)
    assert got["CROSS"] == (None, None, None, None)
    flat = df.withColumn("market_interval_vwap", F.lit(0.0)).filter("side = 'BUY'")
    assert tca.with_vwap_slippage(flat).first()["slippage_from_vwap_bps"] is None


def test_horizons_are_a_list(spark):
    df = tca.horizon_bounds(orders_at(spark, "15:00:00"), TcaRules(horizon_minutes=(3,), quote_lookback_minutes=2))
    row = df.first()
    assert (row["End_plus3"], row["End_plus3_lower"]) == (ts("2024-01-02 20:03:00"), ts("2024-01-02 20:01:00"))


def test_time_joins_pair_nothing_up(spark, small):
    from checks.queries import BUILDERS, Inputs

    for name in ("asof_quotes", "market_interval_vwap"):
        plan = plan_of(BUILDERS[name](Inputs(spark, small)))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
