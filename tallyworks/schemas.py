"""Column contracts of the inputs and outputs.

Readers pass these schemas to Spark, so nothing is inferred; sinks select their columns by name.
Key columns are text here; the operators accept any type that compares.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructType


def _schema(**columns: str | DataType) -> StructType:
    schema = StructType()
    for name, data_type in columns.items():
        schema = schema.add(name, data_type)
    return schema


RAW_TRANSACTIONS = _schema(
    trx_uuid="string",
    source_account_id="string",
    destination_account_id="string",
    transaction_type="string",
    amount_base_currency="decimal(18,4)",
    currency_code="string",
    exchange_rate="decimal(18,6)",
    transaction_timestamp="timestamp",
    merchant_category_code="string",
    channel="string",
    status="string",
    error_code="string",
)
FACT_TRANSACTIONS = _schema(
    trx_uuid="string",
    source_account_id="string",
    destination_account_id="string",
    transaction_type="string",
    amount_base_currency="decimal(18,4)",
    normalized_usd_amount="decimal(18,4)",
    currency_code="string",
    transaction_timestamp="timestamp",
    merchant_category_code="string",
    channel="string",
    customer_id="string",
    customer_segment="string",
    kyc_status="string",
    rolling_10_trx_amount="decimal(28,4)",
    status="string",
    trx_date="date",
    region_id="string",
)
RISK_DAILY_SUMMARY = _schema(
    customer_id="string",
    customer_segment="string",
    region_id="string",
    total_daily_transactions="long",
    total_daily_volume_usd="decimal(28,4)",
    max_single_transaction_usd="decimal(18,4)",
    high_risk_mcc_count="long",
    unique_destinations_count="long",
    daily_risk_flag="string",
    summary_date="string",
)
DIM_ACCOUNTS = _schema(
    account_id="string",
    customer_id="string",
    account_type="string",
    open_date="date",
    currency_code="string",
    status="string",
    region_id="string",
    region_code="string",
    home_lat="double",
    home_lon="double",
)
FACT_DAILY_BALANCES = _schema(
    account_id="string",
    customer_id="string",
    account_type="string",
    open_date="date",
    currency_code="string",
    beginning_balance="decimal(18,4)",
    total_credits="decimal(18,4)",
    total_debits="decimal(18,4)",
    ending_balance="decimal(18,4)",
    interest_accrued="decimal(18,4)",
    is_overdrawn="boolean",
    etl_timestamp="timestamp",
    balance_date="date",
    region_code="string",
)
RAW_CUSTOMERS = _schema(
    customer_id="string",
    first_name="string",
    last_name="string",
    ssn_hash="string",
    dob="date",
    address=StructType().add("country", "string").add("state", "string"),
)
KYC_STATUS = _schema(
    customer_id="string",
    verification_date="date",
    status="string",
    risk_rating="string",
)
FUNDING_ACCOUNTS = _schema(
    customer_id="string",
    account_status="string",
    initial_deposit="double",
    open_date="date",
)
DIM_CUSTOMERS = _schema(
    customer_id="string",
    first_name="string",
    last_name="string",
    national_id_hash="string",
    date_of_birth="date",
    state_code="string",
    kyc_status="string",
    risk_rating="string",
    total_initial_deposit="double",
    last_account_open_date="date",
    etl_insert_ts="timestamp",
    customer_segment="string",
    onboarding_year="integer",
    onboarding_month="integer",
    country_code="string",
)
CUSTOMER_UPDATES = _schema(
    customer_id="string",
    first_name="string",
    last_name="string",
    email_address="string",
    phone_number="string",
    residential_address="string",
    marital_status="string",
    timestamp="timestamp",
)
CUSTOMER_SCD2 = _schema(
    customer_surrogate_key="string",
    customer_id="string",
    first_name="string",
    last_name="string",
    email_address="string",
    phone_number="string",
    residential_address="string",
    marital_status="string",
    effective_start_date="timestamp",
    effective_end_date="timestamp",
    is_active="boolean",
)
CC_TRANSACTIONS = _schema(
    trx_id="string",
    account_id="string",
    merchant_id="string",
    amount="double",
    trx_timestamp="timestamp",
    trx_date="date",
)
DIM_MERCHANTS = _schema(
    merchant_id="string",
    merchant_lat="double",
    merchant_lon="double",
)
ACCOUNT_MOMENTS = _schema(
    account_id="string",
    trx_date="date",
    n_trx="long",
    n_amounts="long",
    whole_sum="double",
    rest_sum="double",
    squared_deviations="double",
)
FRAUD_SCORES = _schema(
    trx_id="string",
    account_id="string",
    amount="double",
    distance_from_home_km="double",
    amount_z_score="double",
    trx_last_hour_cnt="long",
    fraud_score="integer",
    is_fraud_alert="boolean",
    scoring_date="string",
)
ORDER_EVENTS = _schema(
    order_id="string",
    client_id="string",
    trade_date="date",
    protocol_version="string",
    status="string",
    event_type="string",
    event_timestamp="timestamp",
    routing_timestamp="timestamp",
    last_exec_price="double",
    last_exec_qty="double",
)
PARENT_ORDERS = _schema(
    order_id="string",
    client_id="string",
    ticker="string",
    side="string",
    requested_shares="long",
)
# An identifier that settles quotes of one instant may be added (``TcaRules.quote_tie_break``).
LEVEL1_QUOTES = _schema(
    ticker="string",
    quote_timestamp="timestamp",
    best_bid="double",
    best_ask="double",
)
MARKET_TRADES = _schema(
    ticker="string",
    trade_timestamp="timestamp",
    trade_price="double",
    trade_size="long",
)


def require_columns(df: DataFrame, schema: StructType, name: str) -> DataFrame:
    """The columns of the contract, in its order; an error names the ones that are missing."""
    missing = [c for c in schema.names if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    return df.select(*schema.names)
