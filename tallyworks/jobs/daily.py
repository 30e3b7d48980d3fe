"""One function per job. Table names and paths are arguments; the defaults are fixed names."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.functions import SessionHours
from tallyworks.plans import balances, fraud, ledger, onboarding, scd2, tca
from tallyworks.rules import BalanceRules, FraudRules, LedgerRules, MovementRules, RiskRules, SegmentRules, TcaRules
from tallyworks.session import configure
from tallyworks.sinks import (
    Buckets,
    Expect,
    append_rows,
    ensure_table,
    overwrite_table_partitions,
    replace_day,
    replace_table,
    stage,
    write_checked,
    write_run,
)
from tallyworks.sources import read_csv, read_json, read_parquet, read_table

RAW_TRANSACTIONS = "fin_landing.raw_transactions"
FACT_TRANSACTIONS = "fin_core.fact_transactions"
DIM_ACCOUNTS = "fin_core.dim_accounts"
DIM_CUSTOMERS = "fin_core.dim_customers"
DAILY_BALANCES = "fin_core.fact_daily_balances"
CC_TRANSACTIONS = "fin_core.cc_transactions"
DIM_MERCHANTS = "fin_core.dim_merchants"
CUSTOMER_UPDATES = "fin_landing.customer_updates"
CUSTOMER_SCD2 = "fin_core.dim_customers_scd2"
RISK_SUMMARY = "fin_mart.risk_daily_summary"
FRAUD_SCORES = "fin_mart.fraud_scores_daily"
LATE_TRANSACTIONS = "fin_landing.late_transactions"
ACCOUNT_MOMENTS = "fin_core.account_daily_moments"


def run_ledger(
    spark: SparkSession,
    run_date: dt.date,
    *,
    raw: str = RAW_TRANSACTIONS,
    accounts: str = DIM_ACCOUNTS,
    customers: str = DIM_CUSTOMERS,
    facts: str = FACT_TRANSACTIONS,
    summary: str = RISK_SUMMARY,
    rules: LedgerRules = LedgerRules(),
    risk: RiskRules = RiskRules(),
) -> dict[str, int]:
    """Enrich the day's transactions, then summarise the partition just written."""
    configure(spark)
    ensure_table(spark, facts, schemas.FACT_TRANSACTIONS, ["trx_date", "region_id"])
    ensure_table(spark, summary, schemas.RISK_DAILY_SUMMARY, ["summary_date"])
    enriched = ledger.enrich_ledger(
        read_table(spark, raw, schemas.RAW_TRANSACTIONS),
        read_table(spark, accounts),
        read_table(spark, customers),
        run_date,
        rules,
    )
    written = replace_day(enriched, facts, ["trx_date", "region_id"], run_date)
    day = ledger.risk_daily_summary(read_table(spark, facts), run_date, risk)
    return {facts: written, summary: replace_day(day, summary, ["summary_date"], run_date)}


def run_daily_balances(
    spark: SparkSession,
    run_date: dt.date,
    *,
    facts: str = FACT_TRANSACTIONS,
    accounts: str = DIM_ACCOUNTS,
    target: str = DAILY_BALANCES,
    as_of_ts: dt.datetime | None = None,
    rules: BalanceRules = BalanceRules(),
    movement_rules: MovementRules = MovementRules(),
) -> int:
    """Write the day's balances next to the earlier days they build on."""
    configure(spark)
    ensure_table(spark, target, schemas.FACT_DAILY_BALANCES, ["balance_date", "region_code"])
    movements = balances.daily_movements(read_table(spark, facts), run_date, movement_rules, null_accounts=False)
    snapshot = balances.eod_balances(
        read_table(spark, accounts), read_table(spark, target), movements, run_date, as_of_ts, rules
    )
    # Staged, as it reads earlier days of the table that it goes to.
    return replace_day(stage(snapshot, "balances"), target, ["balance_date", "region_code"], run_date)


def run_balance_restatement(
    spark: SparkSession,
    *,
    late: str = LATE_TRANSACTIONS,
    accounts: str = DIM_ACCOUNTS,
    target: str = DAILY_BALANCES,
    as_of_ts: dt.datetime | None = None,
    rules: BalanceRules = BalanceRules(),
    movement_rules: MovementRules = MovementRules(),
) -> int:
    """Carry facts that came after the snapshots of their days through all later snapshots; returns the rows written.

    Only the (day, region) partitions that hold a changed row are written anew. ``late`` holds facts that no snapshot has taken
    up yet: they are facts of their own afterwards, and a second run with the same ones would count them twice.
    """
    configure(spark)
    snapshots = read_table(spark, target)
    moved = stage(balances.late_movements(read_table(spark, late), movement_rules), "late")
    restated = stage(balances.restated_balances(snapshots, moved, as_of_ts, rules, read_table(spark, accounts)), "restated")
    replaced = stage(balances.replaced_partitions(snapshots, restated), "replaced")
    return overwrite_table_partitions(replaced, target, ["balance_date", "region_code"])


def run_onboarding(
    spark: SparkSession,
    customers_path: str,
    kyc_path: str,
    accounts_path: str,
    *,
    target: str = DIM_CUSTOMERS,
    as_of_ts: dt.datetime | None = None,
    rules: SegmentRules = SegmentRules(),
    ties: str = "one",
) -> int:
    """Rebuild the customer dimension from the landed files; the whole table is replaced."""
    configure(spark)
    dim = onboarding.customer_dim(
        read_json(spark, customers_path, schemas.RAW_CUSTOMERS),
        read_parquet(spark, kyc_path, schemas.KYC_STATUS),
        read_csv(spark, accounts_path, schemas.FUNDING_ACCOUNTS),
        as_of_ts,
        rules,
        ties,
    )
    if "." in target:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {target.rsplit('.', 1)[0]}")
    return replace_table(dim, target, ["onboarding_year", "onboarding_month", "country_code"])


def run_customer_history(
    spark: SparkSession,
    run_date: dt.date,
    *,
    updates: str = CUSTOMER_UPDATES,
    history: str = CUSTOMER_SCD2,
    target: str | None = None,
    log: bool = False,
    tie_break: Sequence[str] = (),
    buckets: int | None = None,
) -> int:
    """Bring the day's customer updates into the history.

    The next full version, with one active row per customer, goes to ``target`` or, without one, replaces
    ``history`` once it is complete in a staged table. With ``log`` the new and the retired rows are appended
    to ``history`` instead, where the rows they supersede remain active; of those only the newest takes part
    in the comparison. A day that is run again changes nothing.

    With ``buckets`` the history is kept in so many files by customer, and only the updates are shuffled when both meet; the
    number is fixed by the first run that creates the table.
    """
    configure(spark)
    if target is not None and (log or target == history):
        raise ValueError("a target takes a full version and is another table than the history")
    dealt = Buckets("customer_id", buckets) if buckets else None
    ensure_table(spark, history, schemas.CUSTOMER_SCD2, buckets=dealt)
    dim = read_table(spark, history, schemas.CUSTOMER_SCD2)
    day = scd2.updates_of_day(read_table(spark, updates), run_date, "timestamp", tie_break)
    if log:
        changes = scd2.scd2_changes(scd2.newest_active(dim), day)
        return append_rows(scd2.scd2_day_rows(changes, run_date), history)
    version = scd2.scd2_apply(dim, scd2.scd2_changes(dim, day), run_date)
    if target is None:
        return overwrite_table_partitions(stage(version, "history"), history, [], dealt)
    return replace_table(version, target, [], buckets=dealt)


def run_customer_backfill(
    spark: SparkSession,
    first: dt.date,
    *,
    updates: str = CUSTOMER_UPDATES,
    history: str = CUSTOMER_SCD2,
    tie_break: Sequence[str] = (),
) -> dict[str, int]:
    """Bring updates that arrived late into the history, whatever days they and the history are of.

    ``first`` is the earliest late day; from it on all updates are read again, and the history is replaced
    once its next version is staged. A result with two versions of one customer that begin together is refused. Returns the rows written and the updates left out for want of a customer.
    """
    configure(spark)
    landed = read_table(spark, updates)
    rejected = Observation()
    since = landed.filter(F.col("timestamp") >= F.lit(first).cast("timestamp"))
    since = since.observe(rejected, F.count_if(F.col("customer_id").isNull()).alias("rejected"))
    daily = scd2.updates_by_day(since, ts="timestamp", tie_break=tie_break)
    version = scd2.scd2_backdated(read_table(spark, history, schemas.CUSTOMER_SCD2), daily)
    report = write_checked(
        version,
        lambda staged: overwrite_table_partitions(staged, history, []),
        Expect(not_null=("customer_id", "effective_start_date"), unique=("customer_id", "effective_start_date")),
    )
    return {"written": report["written"], "rejected": rejected.get["rejected"]}


def run_account_moments(
    spark: SparkSession, run_date: dt.date, *, trx: str = CC_TRANSACTIONS, target: str = ACCOUNT_MOMENTS
) -> int:
    """Store the day's moments per account, from which ``run_fraud_scores`` merges its profiles; a rerun replaces the day."""
    configure(spark)
    ensure_table(spark, target, schemas.ACCOUNT_MOMENTS, ["trx_date"])
    day = fraud.trx_of_day(read_table(spark, trx, schemas.CC_TRANSACTIONS), run_date)
    return replace_day(fraud.daily_moments(day), target, ["trx_date"], run_date)


def run_fraud_scores(
    spark: SparkSession,
    run_date: dt.date,
    *,
    trx: str = CC_TRANSACTIONS,
    accounts: str = DIM_ACCOUNTS,
    merchants: str = DIM_MERCHANTS,
    target: str = FRAUD_SCORES,
    rules: FraudRules = FraudRules(),
    moments: str | None = None,
    across_midnight: bool = False,
) -> int:
    """Score the day's card transactions; a rerun replaces the day.

    With a table of ``moments`` the 90 days before are not read again; with ``across_midnight`` the first hour's velocity counts the
    last hour of the day before.
    """
    configure(spark)
    ensure_table(spark, target, schemas.FRAUD_SCORES, ["scoring_date"])
    facts = read_table(spark, trx, schemas.CC_TRANSACTIONS)
    scores = fraud.fraud_scores(
        facts,
        read_table(spark, accounts),
        read_table(spark, merchants, schemas.DIM_MERCHANTS),
        run_date,
        rules,
        fraud.hour_before(facts, run_date, rules) if across_midnight else None,
        read_table(spark, moments) if moments else None,
    )
    return replace_day(scores, target, ["scoring_date"], run_date)


def run_trading_costs(
    spark: SparkSession,
    run_date: dt.date,
    *,
    parents_path: str,
    events_path: str,
    quotes_path: str,
    trades_path: str,
    out_path: str,
    rules: TcaRules = TcaRules(),
    hours: SessionHours = SessionHours(),
    tie_break: Sequence[str] = (),
) -> int:
    """Write the cost report of a run date below ``out_path``; a rerun replaces that date."""
    configure(spark)

    quotes = read_parquet(spark, quotes_path)
    schemas.require_columns(quotes, schemas.LEVEL1_QUOTES, "quotes")
    settled = [c for c in (rules.quote_tie_break,) if c in quotes.columns]
    events = read_parquet(spark, events_path)
    schemas.require_columns(events, schemas.ORDER_EVENTS, "order events")
    report = tca.tca_report(
        read_parquet(spark, parents_path),
        events.select(*schemas.ORDER_EVENTS.names, *tie_break),
        quotes.select(*schemas.LEVEL1_QUOTES.names, *settled),
        schemas.require_columns(read_parquet(spark, trades_path), schemas.MARKET_TRADES, "trades"),
        run_date,
        rules,
        hours,
        tie_break,
        stage,
    )
    return write_run(report, out_path, run_date)
