"""Constraint, anomaly and fee audits.

Parquet enforces no constraint, so the rules of the tables are audited. Every
audit reads a table once, or groups it by the audited key before anything
else, so a hot key is a count by the time it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_of
from ledgerloom.functions.money import rate, share
from ledgerloom.params import (
    BILLING_PERIODS,
    BRAND_TIERS,
    CAMPAIGN_STATUSES,
    ENTRY_TYPES,
    EVENT_TYPES,
    EXTERNAL_ID_LENGTHS,
    FOLLOWER_TIERS,
    PAYOUT_STATUSES,
    Fees,
)

Tables = Mapping[str, DataFrame]


def _one_of(column: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"{column} IN ({listed})"


# --- Fixed values: the constraints of the data model. -------------------------
NOT_NULL: dict[str, tuple[str, ...]] = {
    "dim_date": (
        "date_day",
        "year",
        "quarter",
        "month",
        "week",
        "day_of_week",
        "is_weekend",
        "month_start",
        "month_end",
    ),
    "dim_brand": ("brand_id", "brand_external_id", "brand_name", "industry", "tier", "created_at"),
    "dim_creator": (
        "creator_id",
        "creator_external_id",
        "creator_name",
        "follower_tier",
        "category",
        "created_at",
    ),
    "raw_subscription_events": (
        "event_id",
        "raw_event_id",
        "event_type",
        "plan_name",
        "billing_period",
        "amount_cents",
        "_tz_coerced",
    ),
    "raw_campaigns": ("campaign_id", "brand_id", "creator_id", "agreed_budget_cents", "status", "created_at"),
    "raw_payments": (
        "payment_id",
        "amount_gross_cents",
        "platform_fee_cents",
        "stripe_fee_cents",
        "amount_refunded_cents",
        "status",
        "paid_at",
    ),
    "raw_payouts": (
        "payout_id",
        "payment_id",
        "expected_payout_cents",
        "amount_paid_cents",
        "status",
        "payout_at",
    ),
    "stg_subscriptions": (
        "subscription_id",
        "brand_id",
        "plan_name",
        "billing_period",
        "start_date",
        "mrr_cents",
    ),
    "stg_subscription_source_arrays": ("subscription_id", "part_no", "event_ids"),
    "stg_unmatched_events": ("unmatched_id", "source_table", "source_row_id", "reason", "raw_payload"),
    "stg_ledger_entries": ("ledger_id", "payment_id", "entry_type", "amount_cents", "entry_date"),
    "mart_daily_financials": (
        "entry_date",
        "gmv_cents",
        "net_gmv_cents",
        "platform_revenue_cents",
        "stripe_fees_cents",
        "creator_payouts_cents",
        "gross_margin_cents",
    ),
    "mart_monthly_subscriptions": (
        "brand_id",
        "month_start_date",
        "mrr_start_cents",
        "mrr_new_cents",
        "mrr_expansion_cents",
        "mrr_contraction_cents",
        "mrr_churned_cents",
        "mrr_end_cents",
    ),
}

DOMAINS: dict[str, dict[str, str]] = {
    "dim_brand": {"tier": _one_of("tier", BRAND_TIERS)},
    "dim_creator": {"follower_tier": _one_of("follower_tier", FOLLOWER_TIERS)},
    "raw_subscription_events": {
        "event_type": _one_of("event_type", EVENT_TYPES),
        "billing_period": _one_of("billing_period", BILLING_PERIODS),
        "amount_cents": "amount_cents >= 0",
    },
    "raw_campaigns": {
        "agreed_budget_cents": "agreed_budget_cents > 0",
        "status": _one_of("status", CAMPAIGN_STATUSES),
    },
    "raw_payments": {
        "amount_gross_cents": "amount_gross_cents > 0",
        "platform_fee_cents": "platform_fee_cents >= 0",
        "stripe_fee_cents": "stripe_fee_cents >= 0",
        "amount_refunded_cents": "amount_refunded_cents >= 0",
    },
    "raw_payouts": {
        "amount_paid_cents": "amount_paid_cents >= 0",
        "status": _one_of("status", PAYOUT_STATUSES),
    },
    "stg_subscriptions": {"mrr_cents": "mrr_cents > 0"},
    "stg_ledger_entries": {"entry_type": _one_of("entry_type", ENTRY_TYPES)},
}

UNIQUE: dict[str, tuple[tuple[str, ...], ...]] = {
    "dim_date": (("date_day",),),
    "dim_brand": (("brand_id",), ("brand_external_id",)),
    "dim_creator": (("creator_id",), ("creator_external_id",)),
    "raw_subscription_events": (("event_id",),),
    "raw_campaigns": (("campaign_id",),),
    "raw_payments": (("payment_id",),),
    "raw_payouts": (("payout_id",),),
    "stg_subscriptions": (("subscription_id",),),
    "stg_subscription_source_arrays": (("subscription_id", "part_no"),),
    "stg_unmatched_events": (("unmatched_id",),),
    "stg_ledger_entries": (("ledger_id",),),
    "mart_daily_financials": (("entry_date",),),
    "mart_monthly_subscriptions": (("brand_id", "month_start_date"),),
}

# Keys that number rows without wide gaps.
NUMBERED = ("brand_id", "creator_id", "event_id", "campaign_id", "payment_id", "payout_id")

LENGTHS: dict[str, str] = {"dim_brand": "brand_external_id", "dim_creator": "creator_external_id"}

FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("raw_campaigns", "brand_id", "dim_brand", "brand_id"),
    ("raw_campaigns", "creator_id", "dim_creator", "creator_id"),
    ("raw_payments", "campaign_id", "raw_campaigns", "campaign_id"),
    ("raw_payouts", "payment_id", "raw_payments", "payment_id"),
    ("stg_subscriptions", "brand_id", "dim_brand", "brand_id"),
    ("stg_ledger_entries", "payment_id", "raw_payments", "payment_id"),
    ("mart_monthly_subscriptions", "brand_id", "dim_brand", "brand_id"),
)
# ------------------------------------------------------------------------------

# Bitmaps that hold a number twice are told apart first by so many hash values.
BLOCK_SLOTS = 4096


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _counted(table: str, df: DataFrame, counts: Mapping[str, Column], label: str) -> DataFrame:
    """Count several conditions in one pass and return one row for each."""
    names = list(counts)
    one_row = df.agg(
        F.count(F.lit(1)).alias("total_rows"), *(F.count_if(counts[n]).alias(f"_{i}") for i, n in enumerate(names))
    )
    pairs = F.array(
        *(F.struct(F.lit(n).alias(label), F.col(f"_{i}").alias("violations")) for i, n in enumerate(names))
    )
    return one_row.select(F.lit(table).alias("table_name"), "total_rows", F.inline(pairs)).select(
        "table_name", label, "total_rows", "violations"
    )


def audit_not_null(tables: Tables) -> DataFrame:
    """NULLs in the columns that must not hold any."""
    return _stacked(
        [
            _counted(name, tables[name], {c: F.col(c).isNull() for c in columns}, "column_name")
            for name, columns in NOT_NULL.items()
            if name in tables
        ]
    )


def audit_domain(tables: Tables) -> DataFrame:
    """Values outside their list or bound; a NULL is not a violation."""
    return _stacked(
        [
            _counted(name, tables[name], {c: ~F.expr(rule) for c, rule in rules.items()}, "column_name")
            for name, rules in DOMAINS.items()
            if name in tables
        ]
    )


def audit_length(tables: Tables) -> DataFrame:
    """External ids longer than their column allows."""
    return _stacked(
        [
            _counted(name, tables[name], {c: F.length(c) > EXTERNAL_ID_LENGTHS[c]}, "column_name")
            for name, c in LENGTHS.items()
            if name in tables
        ]
    )


def rule_counts(name: str) -> dict[str, Column]:
    """Aggregates that count the rows of a table and what breaks its NOT NULL, domain and length rules.

    Made to be observed while the table is written, so that no scan follows.
    """
    found = {"rows": F.count(F.lit(1))}
    found |= {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in NOT_NULL.get(name, ())}
    found |= {f"domain:{c}": F.count_if(~F.expr(rule)) for c, rule in DOMAINS.get(name, {}).items()}
    if name in LENGTHS:
        found[f"length:{LENGTHS[name]}"] = F.count_if(F.length(LENGTHS[name]) > EXTERNAL_ID_LENGTHS[LENGTHS[name]])
    return found


def audit_observed(spark: SparkSession, figures: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The counts of :func:`rule_counts` of several tables, a row for each rule."""
    rows = [
        (table, *key.split(":"), counts["rows"], value)
        for table, counts in sorted(figures.items())
        for key, value in counts.items()
        if ":" in key
    ]
    return spark.createDataFrame(rows, "table_name string, rule string, column_name string, total_rows long, violations long")


def _repeats(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows, keys that occur more than once and rows too many, by counting every key; NULL is a key."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    again = F.col("n") > 1
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count_if(again).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(again, F.col("n") - 1)), F.lit(0)).alias("surplus_rows"),
    )


def _in_slots(blocks: DataFrame, block: Column) -> Column:
    """True for every block among ``blocks`` and few others, by a set of fixed size that keeps rows out of a shuffle."""
    slot = F.pmod(F.xxhash64(block), F.lit(BLOCK_SLOTS)).cast("int")
    taken = blocks.agg(F.collect_set(F.pmod(F.xxhash64("block"), F.lit(BLOCK_SLOTS)).cast("int")).alias("taken"))
    flags = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_SLOTS - 1)), lambda i: F.array_contains("taken", i))
    return F.get(taken.select(flags).scalar(), slot)


def number_repeats(df: DataFrame, column: str) -> DataFrame:
    """The figures of a unique audit for an integer key that numbers rows densely.

    The map tasks set a bit for each number in bitmaps of 32 768 numbers, and only bitmaps and row counts are
    shuffled. A bitmap with fewer bits than rows holds a number twice; the rows of such bitmaps alone are counted
    by key, in a second read. Exact for any integers; sparse ones need about a bitmap a row, so they are better
    counted by key.
    """
    numbers = df.select(F.col(column).cast("long").alias("number"))
    block = F.bitmap_bucket_number("number")
    blocks = numbers.groupBy(block.alias("block")).agg(
        F.count(F.lit(1)).alias("n"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("number"))).alias("distinct"),
    )
    # Rows without a number are one key and need no bit.
    no_number = F.col("block").isNull()
    surplus = F.col("n") - F.when(no_number, 1).otherwise(F.col("distinct"))
    sums = blocks.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(surplus), F.lit(0)).alias("surplus_rows"),
        F.count_if(no_number & (F.col("n") > 1)).alias("null_keys"),
    )
    twice = blocks.where(~no_number & (surplus > 0)).select("block")
    candidates = numbers.withColumn("block", block).where(_in_slots(twice, F.col("block")))
    again = candidates.join(twice, "block", "left_semi").groupBy("number").count().where("count > 1")
    repeated = again.agg(F.count(F.lit(1)).alias("keys")).scalar()
    return sums.select("total_rows", (F.col("null_keys") + repeated).alias("duplicate_keys"), "surplus_rows")


def audit_unique(tables: Tables, numbered: tuple[str, ...] = ()) -> DataFrame:
    """Keys that occur more than once and the rows too many.

    Keys among ``numbered``, say :data:`NUMBERED`, are counted in bitmaps (:func:`number_repeats`). That reads a
    table twice, so it is meant for stored ones; a table that is derived anew on each read is better counted by key.
    """

    def duplicates(name: str, key: tuple[str, ...]) -> DataFrame:
        by_bitmaps = len(key) == 1 and key[0] in numbered
        figures = number_repeats(tables[name], key[0]) if by_bitmaps else _repeats(tables[name], key)
        return figures.select(F.lit(name).alias("table_name"), F.lit("+".join(key)).alias("key_columns"), "*")

    return _stacked([duplicates(name, key) for name, keys in UNIQUE.items() if name in tables for key in keys])


def _orphans(named: DataFrame, known: DataFrame) -> DataFrame:
    """Keys of ``named`` that are not in ``known``, and their rows; both have the column ``key``, and NULL names nothing."""
    per_key = named.where(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    lost = per_key.join(known, "key", "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))


def number_orphans(named: DataFrame, known: DataFrame) -> DataFrame:
    """The figures of a foreign key audit for integer keys that number rows densely.

    A bitmap of the numbers on either side has more bits than that of the known ones just where keys are missing.
    Only bitmaps are shuffled, and the numbers that share a bitmap with a missing one, to count their rows.
    """
    named, known = (df.select(F.col("key").cast("long").alias("key")).where("key IS NOT NULL") for df in (named, known))
    block, bit = F.bitmap_bucket_number("key"), F.bitmap_bit_position("key")
    sides = named.withColumn("is_known", F.lit(False)).unionByName(known.withColumn("is_known", F.lit(True)))
    blocks = sides.groupBy(block.alias("block")).agg(
        (
            F.bitmap_count(F.bitmap_construct_agg(bit)) - F.bitmap_count(F.bitmap_construct_agg(F.when(F.col("is_known"), bit)))
        ).alias("missing")
    )
    wanted = _in_slots(blocks.where("missing > 0"), block)
    rows = _orphans(named.where(wanted), known.where(wanted)).select("orphan_rows")
    return blocks.agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("orphan_keys")).withColumn("orphan_rows", rows.scalar())


def audit_foreign_keys(tables: Tables, numbered: tuple[str, ...] = ()) -> DataFrame:
    """Child rows that name a parent which does not exist.

    Children are counted per key first; the join then sees every key once. Parents' keys among ``numbered`` are
    compared in bitmaps (:func:`number_orphans`), which reads both tables twice.
    """

    def orphans(child: str, column: str, parent: str, key: str) -> DataFrame:
        named, known = tables[child].select(F.col(column).alias("key")), tables[parent].select(F.col(key).alias("key"))
        figures = number_orphans(named, known) if key in numbered else _orphans(named, known)
        return figures.select(F.lit(f"{child}.{column}").alias("foreign_key"), F.lit(f"{parent}.{key}").alias("references"), "*")

    return _stacked([orphans(*fk) for fk in FOREIGN_KEYS if fk[0] in tables and fk[2] in tables])


def _ghost_rows(df: DataFrame, column: str, known: DataFrame) -> DataFrame:
    per_id = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_id.join(known.select(column), column, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def anomaly_profile(events: DataFrame, payments: DataFrame, payouts: DataFrame, brands: DataFrame) -> DataFrame:
    """How many rows show each known fault, of how many, and the rate."""
    status = F.col("status")
    event_counts = events.agg(
        F.count(F.lit(1)).alias("base"),
        F.count_if(F.col("brand_external_id").isNull()).alias("missing_brand_external_id"),
        (F.count(F.lit(1)) - F.count_distinct("raw_event_id")).alias("duplicate_event_id"),
        F.count_if("_tz_coerced").alias("timezone_drift"),
    )
    payment_counts = payments.agg(
        F.count(F.lit(1)).alias("base"),
        F.count_if(F.col("campaign_id").isNull()).alias("null_campaign_id"),
        F.count_if(F.col("amount_refunded_cents") > 0).alias("partial_refund"),
        F.count_if(status != F.lower(F.trim(status))).alias("status_case_drift"),
    ).withColumn("unresolvable_entity", _ghost_rows(payments, "brand_external_id", brands).scalar())
    payout_counts = payouts.agg(
        F.count(F.lit(1)).alias("base"),
        F.count_if(F.col("amount_paid_cents") != F.col("expected_payout_cents")).alias("payout_mismatch"),
    )

    def unpivoted(counts: DataFrame, table: str) -> DataFrame:
        faults = [c for c in counts.columns if c != "base"]
        pairs = F.array(*(F.struct(F.lit(c).alias("anomaly"), F.col(c).alias("affected_rows")) for c in faults))
        return counts.select(F.lit(table).alias("table_name"), F.col("base").alias("base_rows"), F.inline(pairs))

    stacked = _stacked(
        [
            unpivoted(event_counts, "raw_subscription_events"),
            unpivoted(payment_counts, "raw_payments"),
            unpivoted(payout_counts, "raw_payouts"),
        ]
    )
    return stacked.select(
        "anomaly",
        "table_name",
        "affected_rows",
        "base_rows",
        rate(F.col("affected_rows"), F.col("base_rows"), 4).cast("double").alias("rate"),
    )


def fee_audit(payments: DataFrame, payouts: DataFrame, fees: Fees) -> DataFrame:
    """Stored fees and payouts against the fee schedule, by month of payment."""
    gross = F.col("amount_gross_cents")
    due = payments.select(
        "payment_id",
        month_of(F.col("paid_at")).alias("month"),
        gross,
        "platform_fee_cents",
        "stripe_fee_cents",
        share(gross, fees.platform_rate).alias("_platform"),
        (share(gross, fees.processor_rate) + fees.processor_fixed_cents).alias("_processor"),
    )
    expected = gross - F.col("_platform") - F.col("_processor")
    months = due.groupBy("month").agg(
        F.count(F.lit(1)).alias("payments"),
        F.sum(gross).alias("gross_cents"),
        F.sum("platform_fee_cents").alias("stored_platform_fee_cents"),
        F.sum("_platform").alias("due_platform_fee_cents"),
        F.sum("stripe_fee_cents").alias("stored_processor_fee_cents"),
        F.sum("_processor").alias("due_processor_fee_cents"),
        F.sum(expected).alias("due_payout_cents"),
        F.count_if(F.col("platform_fee_cents") != F.col("_platform")).alias("platform_fee_differs"),
        F.count_if(F.col("stripe_fee_cents") != F.col("_processor")).alias("processor_fee_differs"),
    )
    # Payouts are compared apart, so that a payment with two payouts counts once above.
    wrong_payouts = (
        payouts.select("payment_id", "expected_payout_cents")
        .join(due.select("payment_id", "month", expected.alias("_due")), "payment_id")
        .groupBy("month")
        .agg(F.count_if(F.col("expected_payout_cents") != F.col("_due")).alias("_wrong"))
    )
    charged = F.col("stored_platform_fee_cents") + F.col("stored_processor_fee_cents")
    return (
        months.join(wrong_payouts, "month", "left")
        .withColumn("expected_payout_differs", F.coalesce("_wrong", F.lit(0)))
        .withColumn("effective_fee_rate", rate(charged, F.col("gross_cents"), 6).cast("double"))
        .drop("_wrong")
    )
