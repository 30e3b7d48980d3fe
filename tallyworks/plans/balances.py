"""Daily account movements and the end-of-day balance snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions import instant
from tallyworks.rules import BalanceRules, MovementRules

_MONEY = "decimal(18,4)"


def _credited(rules: MovementRules) -> Column:
    return ~F.col("transaction_type").isin(*rules.not_credited)


def _debited(rules: MovementRules) -> Column:
    return ~F.col("transaction_type").isin(*rules.not_debited)


def _of_day(fact: DataFrame, run_date: dt.date) -> DataFrame:
    return fact.filter(F.col("trx_date") == F.lit(run_date))


def daily_credits(fact: DataFrame, run_date: dt.date, rules: MovementRules = MovementRules()) -> DataFrame:
    """Incoming amount per destination account; a transaction without a type counts nowhere."""
    return (
        _of_day(fact, run_date)
        .filter(_credited(rules))
        .groupBy(F.col("destination_account_id").alias("account_id"))
        .agg(F.sum("amount_base_currency").alias("total_credits"))
    )


def daily_debits(fact: DataFrame, run_date: dt.date, rules: MovementRules = MovementRules()) -> DataFrame:
    """Outgoing amount per source account; a transaction without a type counts nowhere."""
    return (
        _of_day(fact, run_date)
        .filter(_debited(rules))
        .groupBy(F.col("source_account_id").alias("account_id"))
        .agg(F.sum("amount_base_currency").alias("total_debits"))
    )


def daily_movements(
    fact: DataFrame,
    run_date: dt.date,
    rules: MovementRules = MovementRules(),
    null_accounts: bool = True,
) -> DataFrame:
    """Credits and debits per account, zero where a side is missing.

    Each transaction is turned into its two legs and summed once: one scan, and sums are combined
    before the only shuffle. Legs without an account stay apart by side, as an outer join would
    leave them; ``null_accounts=False`` drops them and keeps the result partitioned by account.
    """
    amount = F.col("amount_base_currency")
    nothing = F.lit(None).cast(fact.schema["amount_base_currency"].dataType)
    credit = F.struct(
        F.col("destination_account_id").alias("account_id"),
        amount.alias("credit"),
        nothing.alias("debit"),
        F.coalesce(_credited(rules), F.lit(False)).alias("moves"),
    )
    debit = F.struct(
        F.col("source_account_id").alias("account_id"),
        nothing.alias("credit"),
        amount.alias("debit"),
        F.coalesce(_debited(rules), F.lit(False)).alias("moves"),
    )
    legs = _of_day(fact, run_date).select(F.posexplode(F.array(credit, debit)).alias("side", "leg"))
    legs = legs.select("side", "leg.*").filter("moves")
    if null_accounts:
        keys = ["account_id", F.when(F.col("account_id").isNull(), F.col("side")).alias("_side")]
    else:
        legs, keys = legs.filter(F.col("account_id").isNotNull()), ["account_id"]
    return (
        legs.groupBy(*keys)
        .agg(F.sum("credit").alias("credits"), F.sum("debit").alias("debits"))
        .select(
            "account_id",
            F.coalesce("credits", F.lit(0)).alias("total_credits"),
            F.coalesce("debits", F.lit(0)).alias("total_debits"),
        )
    )


def with_interest(df: DataFrame, rules: BalanceRules = BalanceRules()) -> DataFrame:
    """One day's interest on positive savings balances: multiplied first, divided last, 4 digits."""
    earned = F.round(F.col("ending_balance") * F.lit(rules.yearly_rate) / F.lit(rules.days_in_year), 4)
    earns = (F.col("account_type") == rules.interest_type) & (F.col("ending_balance") > 0)
    return df.withColumn("interest_accrued", F.when(earns, earned).otherwise(F.lit(0)).cast(_MONEY))


def eod_balances(
    accounts: DataFrame,
    prev: DataFrame,
    movements: DataFrame,
    run_date: dt.date,
    as_of_ts: dt.datetime | None = None,
    rules: BalanceRules = BalanceRules(),
) -> DataFrame:
    """Balance snapshot of one day: yesterday's ending balance plus credits minus debits.

    ``prev`` holds earlier snapshots and is an explicit input, as the result usually overwrites a
    partition of the same table. Without ``as_of_ts`` the current time is stamped.
    """
    yesterday = prev.filter(F.col("balance_date") == F.lit(run_date - dt.timedelta(days=1)))
    zero = F.lit(0).cast(_MONEY)
    begin = F.coalesce("previous_ending", zero).cast(_MONEY)
    credits = F.coalesce("total_credits", zero).cast(_MONEY)
    debits = F.coalesce("total_debits", zero).cast(_MONEY)
    balances = (
        accounts.filter(F.col("status").isin(*rules.kept_status))
        .join(yesterday.select("account_id", F.col("ending_balance").alias("previous_ending")), "account_id", "left")
        .join(movements, "account_id", "left")
        .withColumns({"beginning_balance": begin, "total_credits": credits, "total_debits": debits})
        .withColumn(
            "ending_balance",
            (F.col("beginning_balance") + F.col("total_credits") - F.col("total_debits")).cast(_MONEY),
        )
    )
    return with_interest(balances, rules).select(
        "account_id",
        "customer_id",
        "account_type",
        "open_date",
        "currency_code",
        "beginning_balance",
        "total_credits",
        "total_debits",
        "ending_balance",
        "interest_accrued",
        (F.col("ending_balance") < 0).alias("is_overdrawn"),
        instant(as_of_ts).alias("etl_timestamp"),
        F.lit(run_date).alias("balance_date"),
        F.coalesce("region_code", F.lit(rules.unknown_region)).alias("region_code"),
    )


def late_movements(late: DataFrame, rules: MovementRules = MovementRules()) -> DataFrame:
    """Credits and debits per account and day of facts that came after the snapshots of their days."""
    amount = F.col("amount_base_currency")
    nothing = F.lit(None).cast(late.schema["amount_base_currency"].dataType)
    account = lambda name: F.col(name).alias("account_id")
    credit = F.struct(account("destination_account_id"), amount.alias("credit"), nothing.alias("debit"), _credited(rules).alias("moves"))
    debit = F.struct(account("source_account_id"), nothing.alias("credit"), amount.alias("debit"), _debited(rules).alias("moves"))
    legs = late.select(F.col("trx_date").alias("balance_date"), F.inline(F.array(credit, debit))).filter("moves AND account_id IS NOT NULL")
    return legs.groupBy("account_id", "balance_date").agg(
        F.coalesce(F.sum("credit"), F.lit(0)).cast(_MONEY).alias("late_credits"),
        F.coalesce(F.sum("debit"), F.lit(0)).cast(_MONEY).alias("late_debits"),
    )


def restated_balances(
    snapshots: DataFrame,
    late: DataFrame,
    as_of_ts: dt.datetime | None = None,
    rules: BalanceRules = BalanceRules(),
    accounts: DataFrame | None = None,
) -> DataFrame:
    """The snapshot rows that late movements change, as a run of all days anew would give them.

    ``late`` comes from ``late_movements``. What an account's late movements of a day add up to is carried through its
    later snapshots as one running sum: ending balances move by the sum up to their day, beginning balances by the sum before
    it. A day on which the account has no snapshot ends the run, as the next one begins at zero; late movements of
    such a day, or of a day before the first snapshot, change nothing.

    Only days from the first late one on are read and, with ``accounts``, only the regions of accounts with late
    movements; both are partitions of the table. Only those accounts' rows are shuffled. The rows are whole;
    ``replaced_partitions`` puts them in place of the old ones.
    """
    after = snapshots.filter(F.col("balance_date") >= F.lit(_first_day(late)))
    moved = late.select("account_id").distinct()
    if accounts is not None:
        code = F.coalesce("region_code", F.lit(rules.unknown_region))
        regions = accounts.join(moved, "account_id", "left_semi").select(code).distinct().collect()  # the table's partitions
        after = after.filter(F.col("region_code").isin(sorted(r[0] for r in regions)))
    touched = after.join(moved, "account_id", "left_semi").join(late, ["account_id", "balance_date"], "left")
    by_account = Window.partitionBy("account_id").orderBy("balance_date")
    # Days in a row have a day number that grows with the row number.
    run = F.date_diff("balance_date", F.lit(dt.date(1970, 1, 1))) - F.row_number().over(by_account)
    zero = F.lit(0).cast(_MONEY)
    change = F.coalesce("late_credits", zero) - F.coalesce("late_debits", zero)
    so_far = Window.partitionBy("account_id", "_run").orderBy("balance_date").rowsBetween(Window.unboundedPreceding, 0)
    carried = touched.withColumns({"_run": run, "_change": change}).withColumn("_sum", F.sum("_change").over(so_far))
    moved_rows = carried.filter("_sum <> 0 OR _sum <> _change OR late_credits IS NOT NULL").withColumns(
        {
            "beginning_balance": (F.col("beginning_balance") + F.col("_sum") - F.col("_change")).cast(_MONEY),
            "total_credits": (F.col("total_credits") + F.coalesce("late_credits", zero)).cast(_MONEY),
            "total_debits": (F.col("total_debits") + F.coalesce("late_debits", zero)).cast(_MONEY),
            "ending_balance": (F.col("ending_balance") + F.col("_sum")).cast(_MONEY),
        }
    )
    return (
        with_interest(moved_rows, rules)
        .withColumns({"is_overdrawn": F.col("ending_balance") < 0, "etl_timestamp": instant(as_of_ts)})
        .select(*snapshots.columns)
    )


def _first_day(late: DataFrame) -> dt.date:
    """One row comes back: a date literal is what lets partitions be skipped."""
    return late.agg(F.min("balance_date")).first()[0] or dt.date.max


def replaced_partitions(snapshots: DataFrame, restated: DataFrame) -> DataFrame:
    """All rows of the (day, region) partitions that hold a restated row, with that one in place of the old one.

    Partitions without a restated row are not read: the regions and days are few and reach the scan by their values.
    """
    place = ["balance_date", "region_code"]
    touched = [tuple(r) for r in restated.select(*place).distinct().collect()]  # partitions of the table, not rows
    days, regions = {d for d, _ in touched}, {r for _, r in touched}
    same = F.struct(*place).isin([F.struct(F.lit(d), F.lit(r)) for d, r in sorted(touched)]) if touched else F.lit(False)
    rows = snapshots.filter(F.col("balance_date").isin(sorted(days)) & F.col("region_code").isin(sorted(regions)) & same)
    kept = rows.join(restated.select("account_id", "balance_date"), ["account_id", "balance_date"], "left_anti")
    return kept.select(*snapshots.columns).unionByName(restated)


def unposted_movements(accounts: DataFrame, movements: DataFrame, rules: BalanceRules = BalanceRules()) -> DataFrame:
    """Movements that no balance takes up, with the reason: UNKNOWN without such an account, else its status.

    ``movements`` with its null accounts; the inner join of the snapshot leaves all of these out without a word.
    """
    known = accounts.select("account_id", F.coalesce("status", F.lit("NONE")).alias("_status"))
    reason = F.when(F.col("_status").isNull(), "UNKNOWN").when(~F.col("_status").isin(*rules.kept_status), F.col("_status"))
    return movements.join(known, "account_id", "left").withColumn("reason", reason).filter("reason IS NOT NULL").drop("_status")
