"""One query per operator over the shared test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tallyworks.operators import latest_per_key
from tallyworks.plans import balances, fraud, ledger, onboarding, scd2, tca
from tallyworks.rules import RiskRules
from tallyworks.session import configure, scratch_dir
from tallyworks.sinks import (
    Buckets,
    Expect,
    append_rows,
    ensure_table,
    overwrite_table_partitions,
    replace_table,
    stage,
    write_checked,
    write_partitions,
    write_run,
)
from tallyworks.sources import read_csv, read_json, read_parquet, read_table
from tallyworks.sources.driver_tables import load

LEDGER_DAY = dt.date(2024, 1, 2)
TRADE_DAY = dt.date(2024, 1, 2)
FRAUD_DAY = dt.date(2024, 1, 30)
SCD_DAY = dt.date(2024, 1, 1)
# The test tables hold few transactions per customer and day.
RISK = RiskRules(medium_count=8)
SEQ = ("seq",)

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = {"distance_from_home_km": 3}


def as_checkable(df: DataFrame) -> DataFrame:
    """Types that compare across engines: 64-bit counts, rounded doubles, text for times."""

    def convert(field: StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DecimalType, DoubleType)):
            digits = 4 if isinstance(field.dataType, DecimalType) else DIGITS.get(field.name, 6)
            # Rounded twice: a sum's last bits must not decide a value that ends in an exact half.
            # No negative zero: 0.0 is added, as a condition would compute the value twice.
            column = F.round(column.cast("decimal(38,8)"), digits).cast("double") + F.lit(0.0)
        elif isinstance(field.dataType, IntegerType):
            column = column.cast("long")
        elif isinstance(field.dataType, TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        return column.alias(field.name)

    return df.select(*[convert(f) for f in df.schema.fields])


class Inputs:
    """The test tables of one folder as the operators' inputs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)

    @property
    def day(self) -> DataFrame:
        return ledger.day_slice(self.raw_transactions, LEDGER_DAY)

    @property
    def fact(self) -> DataFrame:
        """Raw transactions as the fact table: all types, not only those the ledger keeps."""
        return self.raw_transactions.withColumn("trx_date", F.to_date("transaction_timestamp"))

    def enriched(self, day: dt.date = LEDGER_DAY) -> DataFrame:
        return ledger.enrich_ledger(self.raw_transactions, self.accounts, self.ledger_customers, day)

    @property
    def balances(self) -> DataFrame:
        movements = balances.daily_movements(self.fact, LEDGER_DAY, null_accounts=False)
        stamp = dt.datetime(2024, 1, 3)
        return balances.eod_balances(self.accounts, self.prev_balances, movements, LEDGER_DAY, stamp)

    @property
    def nested_customers(self) -> DataFrame:
        return self.onboarding_customers.withColumn("address", F.struct("country", "state")).drop("country", "state")

    @property
    def customer_dim(self) -> DataFrame:
        stamp = dt.datetime(2024, 1, 3)
        return onboarding.customer_dim(self.nested_customers, self.kyc, self.funding_accounts, stamp)

    @property
    def changes(self) -> DataFrame:
        updates = scd2.updates_of_day(self.scd_updates, SCD_DAY, tie_break=SEQ)
        return scd2.scd2_changes(self.scd_dim, updates)

    @property
    def card_day(self) -> DataFrame:
        return fraud.trx_of_day(self.cc_transactions, FRAUD_DAY)

    @property
    def fraud_features(self) -> DataFrame:
        return fraud.fraud_features(self.cc_transactions, self.accounts, self.merchants, FRAUD_DAY)

    def fraud_scores(self, day: dt.date = FRAUD_DAY) -> DataFrame:
        return fraud.fraud_scores(self.cc_transactions, self.accounts, self.merchants, day)

    @property
    def fills(self) -> DataFrame:
        return tca.fills(self.order_events)

    @property
    def lifecycle(self) -> DataFrame:
        return tca.order_lifecycle(self.parent_orders, self.order_events, tie_break=SEQ)

    @property
    def orders(self) -> DataFrame:
        return tca.effective_window(self.lifecycle, TRADE_DAY)

    @property
    def staged_orders(self) -> DataFrame:
        return stage(self.orders)

    def with_quotes(self, orders: DataFrame) -> DataFrame:
        return orders.join(tca.asof_quotes(orders, self.quotes), list(tca.ORDER_KEYS), "left")

    @property
    def report(self) -> DataFrame:
        return tca.tca_report(
            self.parent_orders, self.order_events, self.quotes, self.trades, TRADE_DAY, tie_break=SEQ, stage=stage
        )


def _rolling_amount(i: Inputs) -> DataFrame:
    rolled = ledger.with_rolling_amount(ledger.ledger_rows(i.day))
    return rolled.select("trx_uuid", "source_account_id", "amount_base_currency", "rolling_10_trx_amount")


def _overdrawn(i: Inputs) -> DataFrame:
    return i.balances.filter("is_overdrawn").select("account_id", "account_type", "ending_balance")


def _dedup_latest(i: Inputs) -> DataFrame:
    day = i.scd_updates.filter(F.to_date("update_ts") == F.lit(SCD_DAY))
    return latest_per_key(day, ["customer_id"], [F.col("update_ts").desc(), F.col("seq").desc()])


def _geo_distance(i: Inputs) -> DataFrame:
    located = i.cc_transactions.join(i.accounts, "account_id").join(i.merchants, "merchant_id", "left")
    return fraud.with_distance(located).select("trx_id", "account_id", "distance_from_home_km")


def _amount_zscore(i: Inputs) -> DataFrame:
    scored = fraud.with_amount_zscore(i.fraud_features)
    return scored.select("trx_id", "account_id", "amount", "amount_z_score")


def _risk_points(i: Inputs) -> DataFrame:
    scored = fraud.scored_transactions(i.cc_transactions, i.accounts, i.merchants, FRAUD_DAY)
    return scored.select("trx_id", "distance_risk_score", "amount_risk_score", "velocity_risk_score")


def _session_bounds(i: Inputs) -> DataFrame:
    days = load(i.spark, i.sf_dir, "orders").select(F.to_date("o_orderdate").alias("trade_date")).distinct()
    market_open, market_close = tca.session_bounds(F.col("trade_date"))
    return days.select("trade_date", market_open.alias("open_utc"), market_close.alias("close_utc"))


def _horizon_bounds(i: Inputs) -> DataFrame:
    bounds = ["Start_lower", "End_lower", "End_plus1", "End_plus1_lower", "End_plus5", "End_plus5_lower"]
    return tca.horizon_bounds(i.orders).select(*tca.ORDER_KEYS, *bounds)


def _slippage(i: Inputs) -> DataFrame:
    orders = i.staged_orders
    priced = orders.join(tca.market_interval_vwap(orders, i.trades), list(tca.ORDER_KEYS), "left")
    return tca.with_vwap_slippage(priced).select(*tca.ORDER_KEYS, "side", "slippage_from_vwap_bps")


def _quote_measure(measure: Callable[[DataFrame], DataFrame], column: str) -> Callable[[Inputs], DataFrame]:
    def query(i: Inputs) -> DataFrame:
        quoted = tca.with_arrival_mid(i.with_quotes(i.staged_orders))
        return measure(quoted).select(*tca.ORDER_KEYS, "side", column)

    return query


def _source_json(i: Inputs) -> DataFrame:
    path = scratch_dir(i.spark, "customers-json")
    i.nested_customers.write.json(path)
    schema = StructType(
        [
            StructField("customer_id", LongType()),
            StructField("first_name", StringType()),
            StructField("last_name", StringType()),
            StructField("ssn_hash", StringType()),
            StructField("dob", DateType()),
            StructField("address", StructType().add("country", "string").add("state", "string")),
        ]
    )
    customers = read_json(i.spark, path, schema)
    return customers.select(
        "customer_id", "ssn_hash", "dob", F.col("address.country").alias("country_code"), F.col("address.state").alias("state_code")
    )


def _source_csv(i: Inputs) -> DataFrame:
    path = scratch_dir(i.spark, "accounts-csv")
    i.funding_accounts.write.csv(path, header=True)
    return onboarding.funding_totals(read_csv(i.spark, path, i.funding_accounts.schema))


def _sink_dynamic_overwrite(i: Inputs) -> DataFrame:
    """Two days, the second one written twice: a rerun replaces its own partitions only."""
    columns = ["trx_uuid", "normalized_usd_amount", "rolling_10_trx_amount", "trx_date", "region_id"]
    parts = ["trx_date", "region_id"]
    days = [i.enriched(day).select(*columns) for day in (SCD_DAY, LEDGER_DAY)]
    location = scratch_dir(i.spark, "ledger")
    table = f"ledger_{location.rsplit('-', 1)[1]}"
    ensure_table(i.spark, table, days[0].schema, parts, "parquet", location)
    for facts in (*days, days[1]):
        overwrite_table_partitions(facts, table, parts)
    return read_table(i.spark, table)


def _sink_append(i: Inputs) -> DataFrame:
    """Two days of scores; the columns of the second arrive in another order."""
    days = [i.fraud_scores(FRAUD_DAY - dt.timedelta(days=1)), i.fraud_scores()]
    location = scratch_dir(i.spark, "scores")
    table = f"scores_{location.rsplit('-', 1)[1]}"
    ensure_table(i.spark, table, days[0].schema, ["scoring_date"], "orc", location)
    append_rows(days[0], table, ["scoring_date"])
    append_rows(days[1].select(*reversed(days[1].columns)), table, ["scoring_date"])
    return read_table(i.spark, table)


def _sink_orc(i: Inputs) -> DataFrame:
    location = scratch_dir(i.spark, "customers")
    table = f"customers_{location.rsplit('-', 1)[1]}"
    replace_table(i.customer_dim, table, ["onboarding_year", "onboarding_month", "country_code"], "orc", location)
    return read_table(i.spark, table)


def _sink_run_date(i: Inputs) -> DataFrame:
    """Two runs of one day and one of another below the same folder."""
    path = scratch_dir(i.spark, "orders")
    for day in (TRADE_DAY, TRADE_DAY + dt.timedelta(days=1), TRADE_DAY):
        windows = tca.effective_window(i.lifecycle, day)
        write_run(windows.select(*tca.ORDER_KEYS, "EffectiveStartTime", "EffectiveEndTime"), path, day)
    return read_parquet(i.spark, path)


LATE_DAYS = [LEDGER_DAY + dt.timedelta(days=k) for k in range(3)]
SNAPSHOT_STAMP = dt.datetime(2024, 1, 5)


def _balances_restated(i: Inputs) -> DataFrame:
    """Three days of snapshots without the transactions of one channel, which come in afterwards."""
    comes_late = F.col("channel") == "5-LOW"
    early, late = i.fact.filter(~comes_late), i.fact.filter(comes_late)
    snapshots = i.prev_balances
    days = []
    for day in LATE_DAYS:
        movements = balances.daily_movements(early, day, null_accounts=False)
        days.append(stage(balances.eod_balances(i.accounts, snapshots, movements, day, SNAPSHOT_STAMP), "balances"))
        snapshots = days[-1]
    snapshots = reduce(DataFrame.unionByName, days)
    moved = stage(balances.late_movements(late.filter(F.col("trx_date").isin(LATE_DAYS))), "late")
    table, parts = scratch_dir(i.spark, "snapshots"), ["balance_date", "region_code"]
    write_partitions(snapshots, table, parts)
    written = i.spark.read.schema(snapshots.schema).parquet(table)
    restated = stage(balances.restated_balances(written, moved, SNAPSHOT_STAMP, accounts=i.accounts), "restated")
    write_partitions(stage(balances.replaced_partitions(written, restated), "replaced"), table, parts)
    return i.spark.read.schema(snapshots.schema).parquet(table)


def _unposted(i: Inputs) -> DataFrame:
    movements = balances.daily_movements(i.fact, LEDGER_DAY)
    known = i.accounts.filter(F.col("account_type") != "LOAN")  # loans are kept elsewhere
    return balances.unposted_movements(known, movements)


def _scd2_backdated(i: Inputs) -> DataFrame:
    """The last day first, then all nine days."""
    known = stage(scd2.scd2_apply(i.scd_dim, i.changes, SCD_DAY), "history")
    return scd2.scd2_backdated(known, scd2.updates_by_day(i.scd_updates, tie_break=SEQ))


def _scd2_changes_bucketed(i: Inputs) -> DataFrame:
    """The comparison against a history that lies in files by customer."""
    location = scratch_dir(i.spark, "history")
    table = f"history_{location.rsplit('-', 1)[1]}"
    replace_table(i.scd_dim, table, [], "parquet", location, Buckets("customer_id", 8))
    updates = scd2.updates_of_day(i.scd_updates, SCD_DAY, tie_break=SEQ)
    return scd2.scd2_changes(read_table(i.spark, table), updates)


def _profile_incremental(i: Inputs) -> DataFrame:
    moments = stage(fraud.daily_moments(i.cc_transactions), "moments")
    return fraud.profile_from_moments(moments, FRAUD_DAY)


def _scores_with_context(i: Inputs) -> DataFrame:
    context = fraud.hour_before(i.cc_transactions, FRAUD_DAY)
    moments = stage(fraud.daily_moments(i.cc_transactions), "moments")
    return fraud.fraud_scores(i.cc_transactions, i.accounts, i.merchants, FRAUD_DAY, context=context, moments=moments)


def _distinct_sketch(i: Inputs) -> DataFrame:
    """Destinations per account over all days from daily sketches, next to the exact number."""
    keys = ["source_account_id"]
    sketches = stage(ledger.destination_sketches(i.fact, keys), "sketches")
    found = ledger.distinct_destinations(sketches, SCD_DAY, SCD_DAY + dt.timedelta(days=6), keys)
    exact = i.fact.groupBy(*keys).agg(F.count_distinct("destination_account_id").alias("exact_destinations"))
    near = F.abs(F.col("distinct_destinations") - F.col("exact_destinations")) <= 0.02 * F.col("exact_destinations")
    return exact.join(found, keys).select(*keys, "exact_destinations", near.alias("within_two_percent"))


def _checked_write(i: Inputs) -> DataFrame:
    """What a checked write observes: rows, updates that name no known customer, repeated customers, rows by day."""
    updates = i.scd_updates.withColumn("day", F.to_date("update_ts")).join(
        i.ledger_customers.select("customer_id", F.lit(True).alias("known")), "customer_id", "left"
    )
    where = scratch_dir(i.spark, "updates")
    report = write_checked(
        updates,
        lambda staged: write_partitions(staged, where, ["day"]),
        Expect(not_null=("customer_id", "update_ts"), unique=("customer_id", "seq"), most={"known IS NULL": 10**12, "email_address IS NULL": 10**12}),
        ["day"],
    )
    seen = [("rows", report["rows"]), ("written", report["written"]), ("read_back", read_parquet(i.spark, where).count())]
    seen += [("unknown_customers", report["kinds"]["known IS NULL"]), ("without_email", report["kinds"]["email_address IS NULL"])]
    seen += [("repeated_keys", report["repeated_keys"]), *((f"day {day.isoformat()}", n) for (day,), n in report["partitions"].items())]
    return i.spark.createDataFrame(seen, "observed string, number long")


BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {
    # ledger
    "day_slice": lambda i: i.day,
    "normalized_amount": lambda i: ledger.with_normalized_amount(i.day).select(
        "trx_uuid", "amount_base_currency", "exchange_rate", "normalized_usd_amount"
    ),
    "rolling_amount": _rolling_amount,
    "ledger_enrich": lambda i: i.enriched(),
    "ledger_enrich_as_of": lambda i: ledger.enrich_ledger_as_of(
        i.raw_transactions, i.accounts, i.ledger_customer_history, LEDGER_DAY
    ),
    "distinct_destinations_sketch": _distinct_sketch,
    "risk_daily_summary": lambda i: ledger.risk_daily_summary(i.enriched(), LEDGER_DAY, RISK),
    "daily_credits": lambda i: balances.daily_credits(i.fact, LEDGER_DAY),
    "daily_debits": lambda i: balances.daily_debits(i.fact, LEDGER_DAY),
    "daily_movements": lambda i: balances.daily_movements(i.fact, LEDGER_DAY),
    "eod_balances": lambda i: i.balances,
    "interest_accrual": lambda i: i.balances.select("account_id", "account_type", "ending_balance", "interest_accrued"),
    "overdrawn_flag": _overdrawn,
    "balances_restated": _balances_restated,
    "unposted_movements": _unposted,
    # customers
    "latest_kyc": lambda i: onboarding.latest_kyc(i.kyc),
    "funding_totals": lambda i: onboarding.funding_totals(i.funding_accounts),
    "customer_dim": lambda i: i.customer_dim,
    "customer_segments": lambda i: i.customer_dim.select(
        "customer_id", "kyc_status", "total_initial_deposit", "customer_segment"
    ),
    "dedup_latest": _dedup_latest,
    "scd2_changes": lambda i: i.changes,
    "scd2_retired_rows": lambda i: scd2.scd2_retired(i.changes, SCD_DAY),
    "scd2_new_rows": lambda i: scd2.scd2_new(i.changes, SCD_DAY),
    "scd2_append_log": lambda i: scd2.scd2_append(i.scd_dim, i.changes, SCD_DAY),
    "scd2_snapshot": lambda i: scd2.scd2_apply(i.scd_dim, i.changes, SCD_DAY),
    "scd2_backdated": _scd2_backdated,
    "scd2_changes_bucketed": _scd2_changes_bucketed,
    # card fraud
    "geo_distance": _geo_distance,
    "account_profile_90d": lambda i: fraud.account_profile(i.cc_transactions, FRAUD_DAY),
    "fraud_features": lambda i: i.fraud_features,
    "velocity_1h": lambda i: fraud.with_velocity(i.card_day).select("trx_id", "account_id", "trx_last_hour_cnt"),
    "amount_zscore": _amount_zscore,
    "risk_points": _risk_points,
    "fraud_scores": lambda i: i.fraud_scores(),
    "account_profile_incremental": _profile_incremental,
    "fraud_scores_with_context": _scores_with_context,
    # transaction costs
    "classify_fills": lambda i: i.fills,
    "first_fill": lambda i: tca.boundary_fill(i.fills, tie_break=SEQ),
    "fill_summary": lambda i: tca.fill_summary(i.fills),
    "ack_start": lambda i: tca.ack_start(i.order_events),
    "termination_end": lambda i: tca.termination_end(i.order_events),
    "order_lifecycle": lambda i: i.lifecycle,
    "session_bounds": _session_bounds,
    "effective_window": lambda i: i.orders.select(*tca.ORDER_KEYS, "EffectiveStartTime", "EffectiveEndTime"),
    "horizon_bounds": _horizon_bounds,
    "asof_quotes": lambda i: tca.asof_quotes(i.staged_orders, i.quotes),
    "market_interval_vwap": lambda i: tca.market_interval_vwap(i.staged_orders, i.trades),
    "arrival_mid": _quote_measure(lambda df: df, "arrival_mid_price"),
    "slippage_vwap_bps": _slippage,
    "implementation_shortfall": _quote_measure(tca.with_shortfall, "implementation_shortfall_pl"),
    "post_trade_momentum": _quote_measure(tca.with_momentum, "post_trade_1m_momentum"),
    "opportunity_cost": lambda i: tca.with_opportunity_cost(i.lifecycle).select(
        *tca.ORDER_KEYS, "side", "opportunity_cost_pl"
    ),
    "tca_report": lambda i: i.report,
    # sources and sinks
    "source_json_nested": _source_json,
    "source_csv_typed": _source_csv,
    "sink_dynamic_overwrite": _sink_dynamic_overwrite,
    "sink_append": _sink_append,
    "sink_orc_partitioned": _sink_orc,
    "sink_run_date": _sink_run_date,
    "sink_checked": _checked_write,
}


def queries() -> dict[str, Query]:
    def bind(build: Callable[[Inputs], DataFrame]) -> Query:
        return lambda spark, sf_dir: as_checkable(build(Inputs(spark, sf_dir)))

    return {name: bind(build) for name, build in BUILDERS.items()}
