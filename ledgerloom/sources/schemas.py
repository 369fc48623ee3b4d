"""Column names and types of the raw tables, in file order."""

from __future__ import annotations

DIM_BRAND = (
    "brand_id BIGINT, brand_external_id STRING, brand_name STRING, industry STRING, tier STRING, created_at TIMESTAMP"
)
DIM_CREATOR = (
    "creator_id BIGINT, creator_external_id STRING, creator_name STRING, follower_tier STRING, "
    "category STRING, created_at TIMESTAMP"
)
RAW_SUBSCRIPTION_EVENTS = (
    "event_id BIGINT, raw_event_id STRING, brand_external_id STRING, event_type STRING, plan_name STRING, "
    "billing_period STRING, amount_cents INT, event_at TIMESTAMP, _tz_coerced BOOLEAN"
)
RAW_CAMPAIGNS = (
    "campaign_id BIGINT, brand_id BIGINT, creator_id BIGINT, agreed_budget_cents BIGINT, status STRING, "
    "created_at TIMESTAMP, completed_at TIMESTAMP"
)
RAW_PAYMENTS = (
    "payment_id BIGINT, campaign_id BIGINT, brand_external_id STRING, creator_external_id STRING, "
    "amount_gross_cents BIGINT, platform_fee_cents BIGINT, stripe_fee_cents BIGINT, "
    "amount_refunded_cents BIGINT, status STRING, paid_at TIMESTAMP"
)
RAW_PAYOUTS = (
    "payout_id BIGINT, payment_id BIGINT, creator_external_id STRING, expected_payout_cents BIGINT, "
    "amount_paid_cents BIGINT, status STRING, payout_at TIMESTAMP"
)
STG_SUBSCRIPTIONS = (
    "subscription_id STRING, brand_id BIGINT, plan_name STRING, billing_period STRING, start_date DATE, "
    "end_date DATE, mrr_cents BIGINT"
)
STG_PAYMENTS = (
    "payment_id BIGINT, campaign_id BIGINT, brand_id BIGINT, creator_id BIGINT, amount_gross_cents BIGINT, "
    "platform_fee_cents BIGINT, stripe_fee_cents BIGINT, amount_refunded_cents BIGINT, status STRING, "
    "paid_at TIMESTAMP, is_test_transaction BOOLEAN"
)
STG_PAYOUTS = (
    "payout_id BIGINT, payment_id BIGINT, brand_id BIGINT, creator_id BIGINT, amount_paid_cents BIGINT, "
    "expected_payout_cents BIGINT, has_payout_discrepancy BOOLEAN, discrepancy_cents BIGINT, status STRING, "
    "payout_at TIMESTAMP"
)
LEDGER_ENTRIES = "payment_id BIGINT, entry_type STRING, amount_cents BIGINT, entry_date DATE"
DAILY_FINANCIALS = (
    "entry_date DATE, gmv_cents BIGINT, net_gmv_cents BIGINT, platform_revenue_cents BIGINT, "
    "stripe_fees_cents BIGINT, creator_payouts_cents BIGINT, gross_margin_cents BIGINT, "
    "take_rate_gross DECIMAL(10,6), take_rate_net DECIMAL(10,6)"
)
MONTHLY_SUBSCRIPTIONS = (
    "brand_id BIGINT, month_start_date DATE, mrr_start_cents BIGINT, mrr_new_cents BIGINT, "
    "mrr_expansion_cents BIGINT, mrr_contraction_cents BIGINT, mrr_churned_cents BIGINT, mrr_end_cents BIGINT"
)

RAW_TABLES = {
    "dim_brand": DIM_BRAND,
    "dim_creator": DIM_CREATOR,
    "raw_subscription_events": RAW_SUBSCRIPTION_EVENTS,
    "raw_campaigns": RAW_CAMPAIGNS,
    "raw_payments": RAW_PAYMENTS,
    "raw_payouts": RAW_PAYOUTS,
}

# The folder of source tables, as far as it is read.
SOURCE_TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": "l_orderkey BIGINT, l_suppkey BIGINT",
}

# Exports name other rows by external ids and references; keys are given when they are loaded.
EXPORTS = {
    "brands": DIM_BRAND.removeprefix("brand_id BIGINT, "),
    "creators": DIM_CREATOR.removeprefix("creator_id BIGINT, "),
    "events": RAW_SUBSCRIPTION_EVENTS.removeprefix("event_id BIGINT, "),
    "campaigns": (
        "campaign_ref STRING, brand_external_id STRING, creator_external_id STRING, agreed_budget_cents BIGINT, "
        "status STRING, created_at TIMESTAMP, completed_at TIMESTAMP"
    ),
    "payments": RAW_PAYMENTS.replace("payment_id BIGINT, campaign_id BIGINT", "payment_ref STRING, campaign_ref STRING"),
    "payouts": RAW_PAYOUTS.replace("payout_id BIGINT, payment_id BIGINT", "payout_ref STRING, payment_ref STRING"),
}
