"""Plans as a cluster would get them: nothing small enough to broadcast by size."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from checks.queries import BUILDERS, Inputs
from tallyworks.operators import HotSplit
from tallyworks.plans import ledger
from tests.conftest import plan_of

SIZE = "spark.sql.autoBroadcastJoinThreshold"
DAY = dt.date(2024, 1, 2)


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    before = spark.conf.get(SIZE)
    spark.conf.set(SIZE, "-1")
    yield
    spark.conf.set(SIZE, before)


def shuffles(plan: str) -> list[str]:
    found = re.findall(r"Exchange hashpartitioning\((.*), \d+\), ENSURE", plan)
    return [re.sub(r"#\d+L?", "", keys) for keys in found]


@pytest.fixture
def landed(spark, small, tmp_path):
    """Transactions as a plain file, so that only the operator's own shuffles show."""
    inputs = Inputs(spark, small)
    path = str(tmp_path / "raw")
    inputs.raw_transactions.write.parquet(path)
    return spark.read.parquet(path), inputs


def test_ledger_shuffles_the_facts_once(landed):
    raw, i = landed
    plan = plan_of(ledger.enrich_ledger(raw, i.accounts, i.ledger_customers, DAY))
    assert shuffles(plan).count("source_account_id") == 2  # facts and owners
    assert "ReadSchema: struct<trx_uuid:string" in plan and "error_code" not in plan


def test_sliced_ledger_shuffles_the_facts_once(landed):
    raw, i = landed
    split = HotSplit(share=0.0001, floor=5)
    result = ledger.enrich_ledger(raw, i.accounts, i.ledger_customers, DAY, split=split)
    keys = shuffles(plan_of(result))
    # The union of facts and halo, the owners, and the halo's own tails.
    assert keys.count("source_account_id, _slice") == 3
    plain = ledger.enrich_ledger(raw, i.accounts, i.ledger_customers, DAY)
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, plain.collect()))


def test_risk_counts_distinct_in_two_steps(landed):
    raw, i = landed
    facts = ledger.enrich_ledger(raw, i.accounts, i.ledger_customers, DAY)
    keys = shuffles(plan_of(ledger.risk_daily_summary(facts, DAY)))
    assert any(k.endswith("destination_account_id") for k in keys)


def test_movements_are_one_scan_and_one_shuffle(landed):
    from tallyworks.plans import balances

    raw, _ = landed
    fact = raw.withColumn("trx_date", F.to_date("transaction_timestamp"))
    plan = plan_of(balances.daily_movements(fact, DAY, null_accounts=False))
    assert shuffles(plan) == ["account_id"] and plan.count("FileScan") == 1


def test_lifecycle_reads_the_events_once(spark, small, tmp_path):
    from tallyworks.plans import tca

    inputs = Inputs(spark, small)
    path = str(tmp_path / "events")
    inputs.order_events.write.parquet(path)
    plan = plan_of(tca.order_lifecycle(inputs.parent_orders, spark.read.parquet(path)))
    assert plan.count("protocol_version:string") == 1
    assert shuffles(plan).count("order_id, client_id") == 2


def test_scores_join_once_per_second(spark, small):
    keys = shuffles(plan_of(BUILDERS["fraud_scores"](Inputs(spark, small))))
    # The transactions: once by account and second, then to the merchants.
    assert sum(k.startswith("account_id, coalesce(unix_timestamp") for k in keys) == 1


def test_ticks_outside_the_orders_are_not_read(spark, tmp_path):
    """Ten files, one per day of ticks: only the orders' day is read."""
    from tallyworks import schemas
    from tallyworks.plans import tca
    from tallyworks.sinks import stage

    rows = spark.range(0, 100_000, 1, 10)
    moment = F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01 15:00:00").cast("timestamp")) + F.expr("id div 10000 * 86400 + id % 10000"))
    quotes = rows.select(F.col("id").alias("quote_id"), F.lit("T").alias("ticker"), moment.alias("quote_timestamp"), F.lit(1.0).alias("best_bid"), F.lit(1.5).alias("best_ask"))
    trades = rows.select(F.lit("T").alias("ticker"), moment.alias("trade_timestamp"), F.lit(2.0).alias("trade_price"), F.lit(1).alias("trade_size"))
    quotes.write.parquet(str(tmp_path / "quotes"))
    trades.write.parquet(str(tmp_path / "trades"))
    parents = spark.createDataFrame([("o", "c", "T", "BUY", 10)], schemas.PARENT_ORDERS)
    at = dt.datetime(2024, 1, 4, 15, 30)
    events = spark.createDataFrame(
        [("o", "c", at.date(), "V2", "X", "FILL", at, None, 1.0, 5.0), ("o", "c", at.date(), "V2", "EXPIRED", "END", at, None, None, None)],
        schemas.ORDER_EVENTS,
    )
    report = tca.tca_report(
        parents, events, spark.read.parquet(str(tmp_path / "quotes")), spark.read.parquet(str(tmp_path / "trades")), at.date(), stage=stage
    )
    row = report.collect()[0]
    # From the open, half an hour before the first tick of the day, to the end at 15:30.
    assert (row["start_quote_timestamp"], row["end_best_bid"], row["market_interval_volume"]) == (None, 1.0, 1801)
    scans = [n for n in _nodes(spark, report._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet")]
    assert max(n.metrics().apply("numOutputRows").value() for n in scans) == 10_000


def _nodes(spark, plan):
    """All nodes of an executed plan, through query stages."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        found.append(node)
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("name", sorted(n for n in BUILDERS if not n.startswith(("sink", "source"))))
def test_no_pairs_and_no_python(spark, small, name):
    plan = plan_of(BUILDERS[name](Inputs(spark, small)))
    for node in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas"):
        assert node not in plan
    assert "SinglePartition" not in plan


def _trading_day(spark, folder, day):
    """A quote and a trade per second of several days of one ticker, one file a day."""
    rows = spark.range(0, 100_000, 1, 10)
    first = F.unix_seconds(F.lit(f"{day - dt.timedelta(days=3)} 15:00:00").cast("timestamp"))
    moment = F.timestamp_seconds(first + F.expr("id div 10000 * 86400 + id % 10000"))
    quotes = rows.select(F.col("id").alias("quote_id"), F.lit("T").alias("ticker"), moment.alias("quote_timestamp"), F.lit(1.0).alias("best_bid"), F.lit(1.5).alias("best_ask"))
    trades = rows.select(F.lit("T").alias("ticker"), moment.alias("trade_timestamp"), F.lit(2.0).alias("trade_price"), F.lit(1).alias("trade_size"))
    quotes.write.mode("append").parquet(f"{folder}/quotes")
    trades.write.mode("append").parquet(f"{folder}/trades")


def test_an_order_from_years_ago_opens_its_own_day(spark, tmp_path):
    from tallyworks.plans import tca

    now, long_ago = dt.date(2024, 1, 4), dt.date(2019, 3, 5)
    for day in (now, long_ago, dt.date(2021, 6, 1)):
        _trading_day(spark, tmp_path, day)
    rows = [(k, "c", "T", dt.datetime.combine(day, dt.time(15, 10)), dt.datetime.combine(day, dt.time(15, 30))) for k, day in enumerate([now, now, long_ago])]
    orders = spark.createDataFrame(rows, "order_id int, client_id string, ticker string, EffectiveStartTime timestamp, EffectiveEndTime timestamp")
    quotes, trades = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("quotes", "trades"))
    assert len(tca._spans(orders, tca.TcaRules())) == 2 and len(tca._spans(orders, tca.TcaRules(most_spans=1))) == 1
    seen, _ = tca._within_reach(orders, quotes, trades, tca.TcaRules())
    found = seen.select("quote_id", "quote_timestamp").filter("quote_id >= 0")
    assert found.count() == 2 * (20 * 60 + 10 * 60 + 60 + 1)
    found.write.format("noop").mode("overwrite").save()
    plan = seen.select("quote_id")
    plan.collect()
    scans = [n for n in _nodes(spark, plan._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet")]
    assert [n.metrics().apply("numOutputRows").value() for n in scans] == [20_000]  # a file of each of two days


def test_raw_quotes_are_shuffled_once(spark, tmp_path):
    from tallyworks.plans import tca

    _trading_day(spark, tmp_path, DAY)
    at = dt.datetime.combine(DAY, dt.time(15, 10))
    rows = [(k, "c", "T", at + dt.timedelta(seconds=7 * k), at + dt.timedelta(minutes=9, seconds=k)) for k in range(50)]
    rows += [(99, "c", "T", dt.datetime.combine(DAY, dt.time(17, 50)), dt.datetime.combine(DAY, dt.time(23, 0)))]  # after the last quote
    spark.createDataFrame(rows, "order_id int, client_id string, ticker string, EffectiveStartTime timestamp, EffectiveEndTime timestamp").write.parquet(f"{tmp_path}/orders")
    found = tca.asof_quotes(spark.read.parquet(f"{tmp_path}/orders"), spark.read.parquet(f"{tmp_path}/quotes"))
    got = {r.order_id: r for r in found.collect()}
    assert len(got) == 51 and got[0].start_quote_timestamp == at
    assert got[99].start_quote_timestamp == dt.datetime.combine(DAY, dt.time(17, 46, 39)) and got[99].end_quote_timestamp is None
    nodes = _nodes(spark, found._jdf.queryExecution().executedPlan())
    assert sum("quote_timestamp" in n.toString() for n in nodes if n.nodeName().startswith("Scan parquet")) == 1


def test_orders_of_one_window_ask_the_market_once(spark, tmp_path):
    """5,000 orders in ten windows, some without an end or a ticker: what is looked up grows with the windows."""
    from tallyworks.plans import tca

    _trading_day(spark, tmp_path, DAY)
    quotes, trades = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("quotes", "trades"))
    at = dt.datetime.combine(DAY, dt.time(15, 10))
    window = lambda k: (at + dt.timedelta(seconds=7 * k), None if k == 3 else at + dt.timedelta(minutes=9, seconds=k))
    rows = [(n, "c", None if n % 10 == 4 else "T", *window(n % 10)) for n in range(5_000)]
    schema = "order_id int, client_id string, ticker string, EffectiveStartTime timestamp, EffectiveEndTime timestamp"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders")
    for look_up, ticks, missing in ((tca.asof_quotes, quotes, {4}), (tca.market_interval_vwap, trades, {3, 4})):
        found = look_up(orders, ticks)
        got = {tuple(r)[0]: tuple(r)[2:] for r in found.collect()}
        assert set(got) == {n for n in range(5_000) if n % 10 not in missing}
        assert all(got[n] == got[n % 10] for n in got)
        nodes = _nodes(spark, found._jdf.queryExecution().executedPlan())
        asked = [n.metrics().apply("numOutputRows").value() for n in nodes if n.nodeName() == "Generate"]
        assert asked and max(asked) <= 1_000
    quoted = {r.order_id: r for r in tca.asof_quotes(orders, quotes).filter("order_id < 10").collect()}
    assert quoted[3].start_quote_timestamp == window(3)[0] and quoted[3].end_quote_timestamp is None


def test_report_shuffles_its_orders_only_for_many_windows(spark, small):
    from tallyworks.plans import tca
    from tallyworks.rules import TcaRules
    from tallyworks.sinks import stage

    i = Inputs(spark, small)
    inputs = (i.parent_orders, i.order_events, i.quotes, i.trades, DAY)
    reports = []
    for rules, shuffled in ((TcaRules(), 0), (TcaRules(few_windows=0), 1)):
        report = tca.tca_report(*inputs, rules, tie_break=("seq",), stage=stage)
        reports.append(sorted(map(repr, report.collect())))
        nodes = _nodes(spark, report._jdf.queryExecution().executedPlan())
        assert sum(n.nodeName() == "Exchange" and "requested_shares" in n.output().toString() for n in nodes) == shuffled
    plain = tca.tca_report(*inputs, tie_break=("seq",))
    assert reports[0] == reports[1] == sorted(map(repr, plain.collect()))
