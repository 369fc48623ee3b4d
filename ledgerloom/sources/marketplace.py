"""The marketplace tables as projections of a TPC-H-like folder.

Orders play payments, payouts, campaigns and subscription events, customers
play brands and suppliers creators. Faults of every kind (ghost brands, missing
ids, copies, case drift, underpaid payouts) follow from the order key, so the
same tables can be rebuilt anywhere.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.money import cents, share
from ledgerloom.operators.calendar import dim_date, dim_date_around
from ledgerloom.params import DEFAULTS, Params
from ledgerloom.sources.files import read_table
from ledgerloom.sources.schemas import SOURCE_TABLES


def _external_id(prefix: str, number: str, width: int) -> str:
    """SQL for a prefix and a number padded with zeros to at least ``width`` digits."""
    return f"'{prefix}' || lpad({number}, greatest(length({number}), {width}), '0')"


_BRAND = f"CASE WHEN o_orderkey % 100 = 11 THEN 'BRD-GHOST' ELSE {_external_id('BRD-', 'o_custkey', 6)} END"


class Marketplace:
    """Lazy raw tables over one folder; nothing is read until an action runs."""

    def __init__(self, spark: SparkSession, folder: str, params: Params = DEFAULTS):
        self.spark = spark
        self.folder = folder
        self.params = params
        self._opened = "timestamp_ntz'1994-07-01' AS created_at"

    def _source(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name, SOURCE_TABLES[name])

    @cached_property
    def customers(self) -> DataFrame:
        return self._source("customer")

    @cached_property
    def suppliers(self) -> DataFrame:
        return self._source("supplier")

    @cached_property
    def orders(self) -> DataFrame:
        return self._source("orders").withColumn("gross", cents(F.col("o_totalprice")))

    @cached_property
    def line_items(self) -> DataFrame:
        return self._source("lineitem")

    @cached_property
    def dim_date(self) -> DataFrame:
        p = self.params
        if p.calendar_start and p.calendar_end:
            return dim_date(self.spark, p.calendar_start, p.calendar_end)
        return dim_date_around(self.orders, "o_orderdate", p.months_before, p.months_after)

    @cached_property
    def dim_brand(self) -> DataFrame:
        return self.customers.selectExpr(
            "c_custkey AS brand_id",
            f"{_external_id('BRD-', 'c_custkey', 6)} AS brand_external_id",
            "c_name AS brand_name",
            "lower(c_mktsegment) AS industry",
            """CASE WHEN c_mktsegment = 'BUILDING' THEN 'Enterprise'
                WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Mid-Market' ELSE 'SMB' END AS tier""",
            self._opened,
        )

    @cached_property
    def dim_creator(self) -> DataFrame:
        return self.suppliers.selectExpr(
            "s_suppkey AS creator_id",
            f"{_external_id('CRT-', 's_suppkey', 8)} AS creator_external_id",
            "s_name AS creator_name",
            "element_at(array('nano', 'micro', 'macro', 'mega'), s_nationkey % 4 + 1) AS follower_tier",
            "'category-' || s_nationkey AS category",
            self._opened,
        )

    @cached_property
    def _orders_with_creator(self) -> DataFrame:
        """Orders with their lowest supplier as creator, NULL without line items."""
        first_supplier = self.line_items.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.min("l_suppkey").alias("_suppkey")
        )
        return self.orders.join(first_supplier, "o_orderkey", "left").selectExpr(
            "*", f"{_external_id('CRT-', '_suppkey', 8)} AS creator_external_id"
        )

    def _with_money(self, orders: DataFrame) -> DataFrame:
        """Regular fees, refund and expected payout of each order."""
        fees, gross = self.params.fees, F.col("gross")
        split = orders.withColumns(
            {
                "_platform": share(gross, fees.platform_rate),
                "_processor": share(gross, fees.processor_rate) + fees.processor_fixed_cents,
                "_refund": F.expr("CASE WHEN o_orderkey % 20 = 5 THEN gross div 5 ELSE 0L END"),
            }
        )
        return split.withColumn("_expected", F.expr("gross - _platform - _processor"))

    @cached_property
    def raw_payments(self) -> DataFrame:
        return self._with_money(self._orders_with_creator).selectExpr(
            "o_orderkey AS payment_id",
            "CASE WHEN o_orderkey % 50 <> 3 THEN o_orderkey END AS campaign_id",
            f"{_BRAND} AS brand_external_id",
            "creator_external_id",
            "gross AS amount_gross_cents",
            # One cent too much on some rows, for the fee audit to find.
            "_platform + CASE WHEN o_orderkey % 200 = 9 THEN 1 ELSE 0 END AS platform_fee_cents",
            "_processor AS stripe_fee_cents",
            "_refund AS amount_refunded_cents",
            """CASE WHEN o_orderkey % 10 = 7 THEN 'Succeeded' WHEN o_orderkey % 25 = 9 THEN 'failed'
                WHEN o_orderkey % 100 = 45 THEN 'refunded' ELSE ' succeeded ' END AS status""",
            "o_orderdate AS paid_at",
        )

    def _payouts_from(self, orders: DataFrame, *extra: str) -> DataFrame:
        return self._with_money(orders).selectExpr(
            "o_orderkey AS payout_id",
            "o_orderkey AS payment_id",
            *extra,
            "_expected AS expected_payout_cents",
            "greatest(_expected - CASE WHEN o_orderkey % 100 <> 5 THEN _refund ELSE 0 END, 0) AS amount_paid_cents",
            """CASE WHEN o_orderkey % 100 < 3 THEN 'failed' WHEN o_orderkey % 100 < 8 THEN 'pending'
                ELSE 'paid' END AS status""",
            "o_orderdate + make_dt_interval(int(o_orderkey % 45 + 1)) AS payout_at",
        )

    @cached_property
    def raw_payouts(self) -> DataFrame:
        return self._payouts_from(self._orders_with_creator, "creator_external_id")

    @cached_property
    def raw_payout_amounts(self) -> DataFrame:
        """Payouts without the creator column, which needs no line items."""
        return self._payouts_from(self.orders)

    @cached_property
    def campaign_requests(self) -> DataFrame:
        """Campaigns as submitted, with external ids still to be resolved."""
        return self._orders_with_creator.selectExpr(
            f"{_external_id('CMP-', 'o_orderkey', 9)} AS campaign_ref",
            "o_orderkey AS campaign_id",
            f"{_BRAND} AS brand_external_id",
            "creator_external_id",
            "gross AS agreed_budget_cents",
            """CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active'
                ELSE 'cancelled' END AS status""",
            "o_orderdate AS created_at",
            """CASE WHEN o_orderstatus = 'F' THEN o_orderdate + make_dt_interval(int(o_orderkey % 30 + 1)) END
                AS completed_at""",
        )

    @cached_property
    def payment_requests(self) -> DataFrame:
        """Payments naming their campaign by reference; test payments name none."""
        return self.orders.selectExpr(
            f"{_external_id('PAY-', 'o_orderkey', 9)} AS payment_ref",
            "o_orderkey AS payment_id",
            f"CASE WHEN o_orderkey % 50 <> 3 THEN {_external_id('CMP-', 'o_orderkey', 9)} END AS campaign_ref",
            "gross AS amount_gross_cents",
        )

    @cached_property
    def payout_requests(self) -> DataFrame:
        """Payouts naming their payment by reference; some name one that does not exist."""
        ref = f"CASE WHEN payment_id % 500 = 13 THEN 'PAY-UNKNOWN' ELSE {_external_id('PAY-', 'payment_id', 9)} END"
        return self.raw_payout_amounts.selectExpr(
            "payout_id", f"{ref} AS payment_ref", "expected_payout_cents", "amount_paid_cents", "status"
        )

    @cached_property
    def raw_subscription_events(self) -> DataFrame:
        """Events of all orders; some come twice, with the same raw id and a new event id."""
        copies = self.orders.selectExpr(
            "*", "explode(CASE WHEN o_orderkey % 50 = 7 THEN array(0L, 1L) ELSE array(0L) END) AS _copy"
        )
        return copies.selectExpr(
            "o_orderkey * 2 + _copy AS event_id",
            "'evt-' || o_orderkey AS raw_event_id",
            f"CASE WHEN o_orderkey % 33 <> 2 THEN {_BRAND} END AS brand_external_id",
            """CASE o_orderstatus WHEN 'O' THEN 'subscription_created' WHEN 'F' THEN 'cancellation'
                ELSE 'renewal' END AS event_type""",
            "lower(split_part(o_orderpriority, '-', 2)) AS plan_name",
            "CASE WHEN o_orderkey % 4 = 0 THEN 'annual' ELSE 'monthly' END AS billing_period",
            "int(gross) AS amount_cents",
            "o_orderdate AS event_at",
            "o_orderkey % 20 = 11 AS _tz_coerced",
        )
