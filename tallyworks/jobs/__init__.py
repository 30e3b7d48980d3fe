"""Daily jobs: read tables or files, apply a plan, write the result. All can be run again."""

from tallyworks.jobs.daily import (
    run_account_moments,
    run_balance_restatement,
    run_customer_backfill,
    run_customer_history,
    run_daily_balances,
    run_fraud_scores,
    run_ledger,
    run_onboarding,
    run_trading_costs,
)

__all__ = [
    "run_account_moments",
    "run_balance_restatement",
    "run_customer_backfill",
    "run_customer_history",
    "run_daily_balances",
    "run_fraud_scores",
    "run_ledger",
    "run_onboarding",
    "run_trading_costs",
]
