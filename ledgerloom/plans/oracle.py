"""Every query as DuckDB SQL, written from the rules and not from the Spark plans.

``_VIEWS`` holds the shared tables, each with the tables it reads; a statement
gets the WITH list of what it names.
"""

from __future__ import annotations

from ledgerloom.operators.audits import DOMAINS, FOREIGN_KEYS, LENGTHS, NOT_NULL, UNIQUE
from ledgerloom.operators.checks import descriptions
from ledgerloom.operators.subscriptions import PART_EVENTS
from ledgerloom.params import DEFAULTS, EXTERNAL_ID_LENGTHS


def _ext(prefix: str, number: str, width: int) -> str:
    digits = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({digits}, CAST(greatest(length({digits}), {width}) AS INTEGER), '0')"


def _share(cents: str, rate: str) -> str:
    return f"CAST(round_even(CAST({cents} AS DOUBLE) * CAST({rate} AS DOUBLE), 0) AS BIGINT)"


def _text(at: str) -> str:
    return f"strftime({at}, '%Y-%m-%d %H:%M:%S')"


_LIVE = "lower(trim(status)) IN ('succeeded', 'refunded')"
_BRAND = f"CASE WHEN o_orderkey % 100 = 11 THEN 'BRD-GHOST' ELSE {_ext('BRD-', 'o_custkey', 6)} END"
_CENTS = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)"

_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "dim_brand": (
        (),
        f"""SELECT c_custkey AS brand_id, {_ext("BRD-", "c_custkey", 6)} AS brand_external_id, c_name AS brand_name,
        lower(c_mktsegment) AS industry,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'Enterprise' WHEN 'AUTOMOBILE' THEN 'Mid-Market'
            WHEN 'MACHINERY' THEN 'Mid-Market' ELSE 'SMB' END AS tier,
        TIMESTAMP '1994-07-01' AS created_at
        FROM customer""",
    ),
    "dim_creator": (
        (),
        f"""SELECT s_suppkey AS creator_id, {_ext("CRT-", "s_suppkey", 8)} AS creator_external_id,
        s_name AS creator_name,
        CASE s_nationkey % 4 WHEN 0 THEN 'nano' WHEN 1 THEN 'micro' WHEN 2 THEN 'macro' ELSE 'mega' END AS follower_tier,
        'category-' || s_nationkey AS category, TIMESTAMP '1994-07-01' AS created_at
        FROM supplier""",
    ),
    "dim_date": (
        (),
        """SELECT d AS date_day, year(d)::INT AS year, quarter(d)::INT AS quarter, month(d)::INT AS month,
        weekofyear(d)::INT AS week, dayofweek(d)::INT AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
        date_trunc('month', d)::DATE AS month_start, last_day(d) AS month_end
        FROM (SELECT unnest(generate_series(DATE '1994-07-01', DATE '2002-12-31', INTERVAL 1 DAY))::DATE AS d)""",
    ),
    "order_money": (
        (),
        f"""SELECT *, gross - platform - processor AS expected FROM (
            SELECT *, {_share("gross", "0.1")} AS platform, {_share("gross", "0.029")} + 30 AS processor,
            CASE WHEN o_orderkey % 20 = 5 THEN gross // 5 ELSE 0 END AS refund
            FROM (SELECT *, {_CENTS} AS gross FROM orders))""",
    ),
    "order_creator": (
        (),
        f"""SELECT o_orderkey, {_ext("CRT-", "suppkey", 8)} AS creator_external_id
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS suppkey FROM lineitem GROUP BY l_orderkey)
        ON l_orderkey = o_orderkey""",
    ),
    "raw_payments": (
        ("order_money", "order_creator"),
        f"""SELECT o_orderkey AS payment_id, CASE WHEN o_orderkey % 50 <> 3 THEN o_orderkey END AS campaign_id,
        {_BRAND} AS brand_external_id, creator_external_id, gross AS amount_gross_cents,
        platform + CASE WHEN o_orderkey % 200 = 9 THEN 1 ELSE 0 END AS platform_fee_cents,
        processor AS stripe_fee_cents, refund AS amount_refunded_cents,
        CASE WHEN o_orderkey % 10 = 7 THEN 'Succeeded' WHEN o_orderkey % 25 = 9 THEN 'failed'
            WHEN o_orderkey % 100 = 45 THEN 'refunded' ELSE ' succeeded ' END AS status,
        o_orderdate AS paid_at
        FROM order_money JOIN order_creator USING (o_orderkey)""",
    ),
    "raw_payouts": (
        ("order_money", "order_creator"),
        """SELECT o_orderkey AS payout_id, o_orderkey AS payment_id, creator_external_id,
        expected AS expected_payout_cents,
        greatest(expected - CASE WHEN refund > 0 AND o_orderkey % 100 <> 5 THEN refund ELSE 0 END, 0)
            AS amount_paid_cents,
        CASE WHEN o_orderkey % 100 < 3 THEN 'failed' WHEN o_orderkey % 100 < 8 THEN 'pending' ELSE 'paid' END AS status,
        o_orderdate + to_days(CAST(1 + o_orderkey % 45 AS INTEGER)) AS payout_at
        FROM order_money JOIN order_creator USING (o_orderkey)""",
    ),
    "campaign_requests": (
        ("order_creator",),
        f"""SELECT {_ext("CMP-", "o_orderkey", 9)} AS campaign_ref, o_orderkey AS campaign_id,
        {_BRAND} AS brand_external_id, creator_external_id, {_CENTS} AS agreed_budget_cents,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active' ELSE 'cancelled' END AS status,
        o_orderdate AS created_at,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(1 + o_orderkey % 30 AS INTEGER)) END
            AS completed_at
        FROM orders JOIN order_creator USING (o_orderkey)""",
    ),
    "raw_campaigns": (
        ("campaign_requests", "dim_brand", "dim_creator"),
        """SELECT campaign_ref, campaign_id, brand_id, creator_id, agreed_budget_cents, status,
        r.created_at, completed_at
        FROM campaign_requests r JOIN dim_brand b USING (brand_external_id)
        JOIN dim_creator c USING (creator_external_id)""",
    ),
    "payout_requests": (
        ("raw_payouts",),
        f"""SELECT payout_id, expected_payout_cents, amount_paid_cents, status,
        CASE WHEN payout_id % 500 = 13 THEN NULL ELSE payment_id END AS payment_id FROM raw_payouts""",
    ),
    "raw_events": (
        (),
        f"""SELECT o_orderkey * 2 + copy AS event_id, 'evt-' || o_orderkey AS raw_event_id,
        CASE WHEN o_orderkey % 33 <> 2 THEN {_BRAND} END AS brand_external_id,
        CASE o_orderstatus WHEN 'O' THEN 'subscription_created' WHEN 'F' THEN 'cancellation' ELSE 'renewal' END
            AS event_type,
        lower(split_part(o_orderpriority, '-', 2)) AS plan_name,
        CASE WHEN o_orderkey % 4 = 0 THEN 'annual' ELSE 'monthly' END AS billing_period,
        CAST({_CENTS} AS INTEGER) AS amount_cents, o_orderdate AS event_at, o_orderkey % 20 = 11 AS _tz_coerced
        FROM orders JOIN (VALUES (0), (1)) AS copies(copy) ON copy = 0 OR o_orderkey % 50 = 7""",
    ),
    "deduped": (
        ("raw_events",),
        """SELECT * FROM raw_events WHERE brand_external_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY raw_event_id ORDER BY event_at DESC NULLS LAST, event_id) = 1""",
    ),
    "resolved": (
        ("deduped", "dim_brand"),
        """SELECT d.*, brand_id,
        CASE WHEN _tz_coerced THEN coalesce(event_at, TIMESTAMP '2002-12-31') ELSE event_at END::DATE AS event_date
        FROM deduped d JOIN dim_brand USING (brand_external_id)""",
    ),
    "spans": (
        ("resolved",),
        """SELECT brand_id, plan_name, billing_period, amount_cents, event_date AS start_date,
        list(event_id ORDER BY event_id) AS sources
        FROM resolved WHERE event_type = 'subscription_created' GROUP BY ALL""",
    ),
    "cancelled": (
        ("resolved",),
        """SELECT brand_id, plan_name, min(event_date) AS end_date
        FROM resolved WHERE event_type = 'cancellation' GROUP BY ALL""",
    ),
    "subscriptions": (
        ("spans", "cancelled"),
        """SELECT sha256(brand_id || '|' || plan_name || '|' || start_date) AS subscription_id, s.*, end_date,
        CAST(CASE billing_period WHEN 'annual' THEN amount_cents // 12 ELSE amount_cents END AS BIGINT) AS mrr_cents
        FROM spans s LEFT JOIN cancelled USING (brand_id, plan_name)
        QUALIFY row_number() OVER (PARTITION BY subscription_id ORDER BY billing_period, amount_cents) = 1""",
    ),
    "source_parts": (
        ("subscriptions",),
        f"""SELECT subscription_id, (n - 1) // {PART_EVENTS} AS part_no, list(event_id ORDER BY event_id) AS event_ids
        FROM (SELECT *, row_number() OVER (PARTITION BY subscription_id ORDER BY event_id) AS n
            FROM (SELECT subscription_id, unnest(sources) AS event_id FROM subscriptions)) GROUP BY ALL""",
    ),
    "payments": (
        ("raw_payments", "dim_brand", "dim_creator"),
        """SELECT payment_id, campaign_id, brand_id, creator_id, amount_gross_cents, platform_fee_cents,
        stripe_fee_cents, amount_refunded_cents, lower(trim(status)) AS status, paid_at,
        campaign_id IS NULL AS is_test_transaction
        FROM raw_payments LEFT JOIN dim_brand USING (brand_external_id)
        LEFT JOIN dim_creator USING (creator_external_id)
        WHERE campaign_id IS NULL OR (brand_id IS NOT NULL AND creator_id IS NOT NULL)""",
    ),
    "payouts": (
        ("raw_payouts", "payments", "dim_creator"),
        """SELECT payout_id, r.payment_id, p.brand_id, c.creator_id, amount_paid_cents, expected_payout_cents,
        amount_paid_cents <> expected_payout_cents AS has_payout_discrepancy,
        amount_paid_cents - expected_payout_cents AS discrepancy_cents, r.status, payout_at
        FROM raw_payouts r JOIN payments p ON p.payment_id = r.payment_id
        LEFT JOIN dim_creator c ON c.creator_external_id = r.creator_external_id""",
    ),
    "bad_events": (
        ("raw_events", "dim_brand"),
        f"""SELECT 'raw_subscription_events' AS source_table, event_id AS source_row_id,
        CASE WHEN e.brand_external_id IS NULL THEN 'missing_brand_external_id'
            ELSE 'unresolvable_brand_external_id' END AS reason,
        CAST(to_json({{'event_id': event_id, 'raw_event_id': raw_event_id, 'brand_external_id': e.brand_external_id,
            'event_type': event_type, 'plan_name': plan_name, 'billing_period': billing_period,
            'amount_cents': amount_cents, 'event_at': {_text("event_at")} || '+00:00', '_tz_coerced': _tz_coerced}})
            AS VARCHAR) AS raw_payload
        FROM raw_events e WHERE e.brand_external_id IS NULL
            OR e.brand_external_id NOT IN (SELECT brand_external_id FROM dim_brand)""",
    ),
    "bad_payments": (
        ("raw_payments", "dim_brand", "dim_creator"),
        f"""SELECT 'raw_payments' AS source_table, payment_id AS source_row_id,
        'unresolvable_brand_external_id' AS reason,
        CAST(to_json({{'payment_id': payment_id, 'campaign_id': campaign_id, 'brand_external_id': brand_external_id,
            'creator_external_id': creator_external_id, 'amount_gross_cents': amount_gross_cents, 'status': status,
            'paid_at': {_text("paid_at")} || '+00:00'}}) AS VARCHAR) AS raw_payload
        FROM raw_payments p WHERE campaign_id IS NOT NULL AND NOT (
            EXISTS (SELECT 1 FROM dim_brand b WHERE b.brand_external_id = p.brand_external_id)
            AND EXISTS (SELECT 1 FROM dim_creator c WHERE c.creator_external_id = p.creator_external_id))""",
    ),
    "unmatched": (
        ("bad_events", "bad_payments"),
        "SELECT * FROM bad_events UNION ALL SELECT * FROM bad_payments",
    ),
    "ledger": (
        ("payments", "raw_payouts"),
        """SELECT payment_id, kind.name AS entry_type, CASE kind.name
            WHEN 'brand_charge' THEN amount_gross_cents WHEN 'platform_fee_revenue' THEN platform_fee_cents
            WHEN 'stripe_processing_fee' THEN -stripe_fee_cents ELSE -amount_refunded_cents END AS amount_cents,
        paid_at::DATE AS entry_date
        FROM payments, (VALUES ('brand_charge'), ('platform_fee_revenue'), ('stripe_processing_fee'),
            ('refund_adjustment')) AS kind(name)
        WHERE NOT is_test_transaction AND status IN ('succeeded', 'refunded')
            AND (kind.name <> 'refund_adjustment' OR amount_refunded_cents > 0)
        UNION ALL
        SELECT o.payment_id, 'creator_payout', -o.amount_paid_cents, o.payout_at::DATE
        FROM raw_payouts o SEMI JOIN (SELECT payment_id FROM payments
            WHERE NOT is_test_transaction AND status IN ('succeeded', 'refunded')) USING (payment_id)
        WHERE o.status = 'paid'""",
    ),
    "daily": (
        ("ledger",),
        """SELECT entry_date, gmv AS gmv_cents, gmv + refunds AS net_gmv_cents, revenue AS platform_revenue_cents,
        -fees AS stripe_fees_cents, -paid AS creator_payouts_cents, revenue + fees + paid AS gross_margin_cents,
        round(revenue::DOUBLE / nullif(gmv, 0), 6) AS take_rate_gross,
        round(revenue::DOUBLE / nullif(gmv + refunds, 0), 6) AS take_rate_net
        FROM (SELECT entry_date,
            coalesce(sum(amount_cents) FILTER (entry_type = 'brand_charge'), 0)::BIGINT AS gmv,
            coalesce(sum(amount_cents) FILTER (entry_type = 'refund_adjustment'), 0)::BIGINT AS refunds,
            coalesce(sum(amount_cents) FILTER (entry_type = 'platform_fee_revenue'), 0)::BIGINT AS revenue,
            coalesce(sum(amount_cents) FILTER (entry_type = 'stripe_processing_fee'), 0)::BIGINT AS fees,
            coalesce(sum(amount_cents) FILTER (entry_type = 'creator_payout'), 0)::BIGINT AS paid
            FROM ledger GROUP BY entry_date)""",
    ),
    "spine": (
        ("subscriptions", "dim_date"),
        """SELECT brand_id, month_start_date FROM (SELECT DISTINCT brand_id FROM subscriptions),
        (SELECT DISTINCT month_start AS month_start_date FROM dim_date, (
            SELECT min(start_date) AS lo,
            date_trunc('month', coalesce(max(end_date), max(start_date))) + INTERVAL 1 MONTH AS hi FROM subscriptions)
        WHERE date_day BETWEEN lo AND hi)""",
    ),
    "levels": (
        ("spine", "subscriptions"),
        """SELECT p.brand_id, month_start_date, coalesce(sum(mrr_cents), 0)::BIGINT AS mrr_cents
        FROM spine p LEFT JOIN subscriptions s ON s.brand_id = p.brand_id
            AND s.start_date <= last_day(month_start_date)
            AND coalesce(s.end_date, DATE '9999-12-31') >= month_start_date
        GROUP BY ALL""",
    ),
    "waterfall": (
        ("levels",),
        """SELECT brand_id, month_start_date, coalesce(before, 0) AS mrr_start_cents,
        CASE WHEN before IS NULL AND now > 0 THEN now ELSE 0 END AS mrr_new_cents,
        CASE WHEN before > 0 AND now > before THEN now - before ELSE 0 END AS mrr_expansion_cents,
        CASE WHEN now > 0 AND now < before THEN before - now ELSE 0 END AS mrr_contraction_cents,
        CASE WHEN before > 0 AND now = 0 THEN before ELSE 0 END AS mrr_churned_cents, now AS mrr_end_cents
        FROM (SELECT brand_id, month_start_date, mrr_cents AS now,
            lag(mrr_cents) OVER (PARTITION BY brand_id ORDER BY month_start_date) AS before FROM levels)""",
    ),
    "breaks": (
        ("waterfall",),
        """SELECT * FROM (SELECT *, lead(mrr_start_cents) OVER (PARTITION BY brand_id ORDER BY month_start_date)
            AS next_start FROM waterfall) WHERE next_start <> mrr_end_cents""",
    ),
    "early_spans": (
        ("resolved",),
        """SELECT brand_id, plan_name, billing_period, amount_cents, event_date AS start_date
        FROM resolved WHERE event_type = 'subscription_created' AND event_date < DATE '1996-03-15' GROUP BY ALL""",
    ),
    "early_subscriptions": (
        ("early_spans", "resolved"),
        """SELECT sha256(brand_id || '|' || plan_name || '|' || start_date) AS subscription_id, s.*, end_date,
        CAST(CASE billing_period WHEN 'annual' THEN amount_cents // 12 ELSE amount_cents END AS BIGINT) AS mrr_cents
        FROM early_spans s LEFT JOIN (SELECT brand_id, plan_name, min(event_date) AS end_date FROM resolved
            WHERE event_type = 'cancellation' AND event_date < DATE '1996-03-15' GROUP BY ALL) USING (brand_id, plan_name)
        QUALIFY row_number() OVER (PARTITION BY subscription_id ORDER BY billing_period, amount_cents) = 1""",
    ),
    "days_of_orders": (
        (),
        """SELECT d AS date_day, year(d)::INT AS year, quarter(d)::INT AS quarter, month(d)::INT AS month,
        weekofyear(d)::INT AS week, dayofweek(d)::INT AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
        date_trunc('month', d)::DATE AS month_start, last_day(d) AS month_end, load_no
        FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d, load_no FROM (
            SELECT date_trunc('month', min(o_orderdate)) - INTERVAL 6 MONTH AS lo,
            date_trunc('month', max(o_orderdate)) + INTERVAL 17 MONTH - INTERVAL 1 DAY AS hi, 2 AS load_no FROM orders
            UNION ALL SELECT date_trunc('month', min(o_orderdate)) - INTERVAL 2 MONTH,
            date_trunc('month', max(o_orderdate)) + INTERVAL 1 MONTH - INTERVAL 1 DAY, 1 FROM orders
            WHERE o_orderdate < DATE '1996-03-15'))""",
    ),
    "months": (
        ("daily",),
        """SELECT date_trunc('month', entry_date)::DATE AS month, sum(gmv_cents)::BIGINT AS gmv_cents,
        sum(net_gmv_cents)::BIGINT AS net_gmv_cents, sum(platform_revenue_cents)::BIGINT AS platform_revenue_cents,
        sum(stripe_fees_cents)::BIGINT AS stripe_fees_cents,
        sum(creator_payouts_cents)::BIGINT AS creator_payouts_cents,
        sum(gross_margin_cents)::BIGINT AS gross_margin_cents,
        round(sum(platform_revenue_cents)::DOUBLE / nullif(sum(gmv_cents), 0), 4) AS take_rate_gross,
        sum(gmv_cents)::DOUBLE / 100000 AS gmv_k, sum(platform_revenue_cents)::DOUBLE / 100000 AS platform_revenue_k,
        sum(gross_margin_cents)::DOUBLE / 100000 AS gross_margin_k
        FROM daily GROUP BY 1""",
    ),
    "movements": (
        ("waterfall",),
        """SELECT *, new_cents::DOUBLE / 100000 AS new_k, expansion_cents::DOUBLE / 100000 AS expansion_k,
        contraction_cents::DOUBLE / 100000 AS contraction_k, churned_cents::DOUBLE / 100000 AS churned_k,
        mrr_end_cents::DOUBLE / 100000 AS mrr_end_k
        FROM (SELECT month_start_date AS month, sum(mrr_new_cents)::BIGINT AS new_cents,
            sum(mrr_expansion_cents)::BIGINT AS expansion_cents, -sum(mrr_contraction_cents)::BIGINT AS contraction_cents,
            -sum(mrr_churned_cents)::BIGINT AS churned_cents, sum(mrr_end_cents)::BIGINT AS mrr_end_cents
            FROM waterfall GROUP BY 1)""",
    ),
    "retention": (
        ("waterfall",),
        """SELECT cohort_month, month_index, retained, cohort_size,
        round(retained::DOUBLE / cohort_size * 100, 1) AS retention_pct
        FROM (SELECT cohort_month, datediff('month', cohort_month, month_start_date)::INT AS month_index,
            count(*) FILTER (mrr_end_cents > 0) AS retained, count(DISTINCT brand_id) AS cohort_size
            FROM waterfall JOIN (SELECT brand_id, min(month_start_date) AS cohort_month FROM waterfall
                WHERE mrr_end_cents > 0 GROUP BY brand_id) USING (brand_id)
            GROUP BY ALL)
        WHERE month_index <= 11""",
    ),
    "v1": (
        ("raw_payments", "dim_brand", "dim_creator", "daily"),
        f"""SELECT *, mart_gmv_cents - raw_payments_gmv_cents AS delta_cents,
        if(mart_gmv_cents = raw_payments_gmv_cents, 'pass', 'fail') AS status FROM (SELECT
        (SELECT coalesce(sum(amount_gross_cents), 0)::BIGINT FROM raw_payments
            SEMI JOIN dim_brand USING (brand_external_id) SEMI JOIN dim_creator USING (creator_external_id)
            WHERE campaign_id IS NOT NULL AND {_LIVE}) AS raw_payments_gmv_cents,
        (SELECT coalesce(sum(gmv_cents), 0)::BIGINT FROM daily) AS mart_gmv_cents)""",
    ),
    "v2": (
        ("ledger", "daily"),
        """SELECT *, mart_gross_margin_sum_cents - ledger_margin_sum_cents AS delta_cents,
        if(mart_gross_margin_sum_cents = ledger_margin_sum_cents, 'pass', 'fail') AS status FROM (SELECT
        (SELECT coalesce(sum(amount_cents), 0)::BIGINT FROM ledger
            WHERE entry_type NOT IN ('brand_charge', 'refund_adjustment')) AS ledger_margin_sum_cents,
        (SELECT coalesce(sum(gross_margin_cents), 0)::BIGINT FROM daily) AS mart_gross_margin_sum_cents)""",
    ),
    "v3": (
        ("breaks", "waterfall"),
        """SELECT *, if(violation_count = 0, 'pass', 'fail') AS status FROM (SELECT
        (SELECT count(*) FROM breaks) AS violation_count, (SELECT count(*) FROM waterfall) AS total_waterfall_rows)""",
    ),
    "v4": (
        ("payouts",),
        """SELECT mismatch_rows, total_rows, round_even(share, 4) AS rate, 0.03::DOUBLE AS expected_min,
        0.07::DOUBLE AS expected_max, if(share BETWEEN 0.03 AND 0.07, 'pass', 'fail') AS status
        FROM (SELECT count(*) FILTER (has_payout_discrepancy) AS mismatch_rows, count(*) AS total_rows,
            coalesce(mismatch_rows::DOUBLE / nullif(total_rows, 0), 0) AS share FROM payouts)""",
    ),
    "v5": (
        ("unmatched",),
        """SELECT count(*) AS unmatched_row_count, if(count(*) > 0, 'pass', 'fail') AS status FROM unmatched""",
    ),
    "v6": (
        ("raw_payments", "ledger", "payments"),
        f"""SELECT *, if(test_transaction_raw_gmv_cents = 0 OR test_transaction_ledger_gmv_cents = 0, 'pass', 'fail')
        AS status FROM (SELECT
        (SELECT coalesce(sum(amount_gross_cents), 0)::BIGINT FROM raw_payments WHERE campaign_id IS NULL AND {_LIVE})
            AS test_transaction_raw_gmv_cents,
        (SELECT coalesce(sum(amount_cents), 0)::BIGINT FROM ledger l JOIN payments p ON p.payment_id = l.payment_id
            WHERE entry_type = 'brand_charge' AND is_test_transaction) AS test_transaction_ledger_gmv_cents)""",
    ),
    "v7": (
        ("daily",),
        """SELECT min(take_rate_gross) AS min_take_rate_gross, max(take_rate_gross) AS max_take_rate_gross,
        count(take_rate_gross) AS non_null_rows, 0.05::DOUBLE AS expected_min, 0.2::DOUBLE AS expected_max,
        if(min(take_rate_gross) >= 0.05 AND max(take_rate_gross) <= 0.2, 'pass', 'fail') AS status FROM daily""",
    ),
}



def _row_key(view: str, columns: str, name: str) -> str:
    """``view`` with the key of its rows: lengths and values, joined by bars, and the number among equal rows."""
    values = [f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in columns.split(", ")]
    text = ", ".join(part for v in values for part in (f"length({v})", v))
    return f"""SELECT {columns}, substr(sha256(concat_ws('|', {text},
        row_number() OVER (PARTITION BY {columns}))), 1, 32) AS {name} FROM {view}"""


_VIEWS["keyed_ledger"] = (("ledger",), _row_key("ledger", "payment_id, entry_type, amount_cents, entry_date", "ledger_id"))
_VIEWS["keyed_unmatched"] = (
    ("unmatched",),
    _row_key("unmatched", "source_table, source_row_id, reason, raw_payload", "unmatched_id"),
)

_AUDITED = {
    "raw_subscription_events": "raw_events",
    "stg_subscriptions": "subscriptions",
    "stg_subscription_source_arrays": "source_parts",
    "stg_unmatched_events": "keyed_unmatched",
    "stg_ledger_entries": "keyed_ledger",
    "mart_daily_financials": "daily",
    "mart_monthly_subscriptions": "waterfall",
}


def _statement(reads: tuple[str, ...], select: str) -> str:
    """``select`` behind the WITH list of the tables it reads, in order of need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in _VIEWS[name][0]:
                add(needed)
            ordered.append(name)

    for name in reads:
        add(name)
    ctes = ",\n".join(f"{name} AS ({_VIEWS[name][1]})" for name in ordered)
    return f"WITH {ctes}\n{select}" if ctes else select


def _columns(names: str, view: str) -> str:
    return _statement((view,), f"SELECT {names} FROM {view}")


def _audit_view(table: str) -> str:
    return _AUDITED.get(table, table)


def _counted(rules: dict[str, dict[str, str]]) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS total_rows, "
        f"count(*) FILTER ({broken}) AS violations FROM {_audit_view(table)}"
        for table, columns in rules.items()
        for column, broken in columns.items()
    ]
    return _statement(tuple(_audit_view(t) for t in rules), "\nUNION ALL ".join(parts))


def _audits() -> dict[str, str]:
    unique = [
        f"SELECT '{table}' AS table_name, '{'+'.join(key)}' AS key_columns, coalesce(sum(n), 0)::BIGINT AS total_rows, "
        f"count(*) FILTER (n > 1) AS duplicate_keys, "
        f"coalesce(sum(n - 1) FILTER (n > 1), 0)::BIGINT AS surplus_rows "
        f"FROM (SELECT count(*) AS n FROM {_audit_view(table)} GROUP BY {', '.join(key)})"
        for table, keys in UNIQUE.items()
        for key in keys
    ]
    orphans = [
        f"SELECT '{child}.{column}' AS foreign_key, '{parent}.{key}' AS \"references\", "
        f"count(DISTINCT {column}) AS orphan_keys, count(*) AS orphan_rows FROM {_audit_view(child)} "
        f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {_audit_view(parent)})"
        for child, column, parent, key in FOREIGN_KEYS
    ]
    linked = tuple(_audit_view(t) for fk in FOREIGN_KEYS for t in (fk[0], fk[2]))
    return {
        "audit_not_null": _counted({t: {c: f"{c} IS NULL" for c in columns} for t, columns in NOT_NULL.items()}),
        "audit_domain": _counted({t: {c: f"NOT ({rule})" for c, rule in rules.items()} for t, rules in DOMAINS.items()}),
        "audit_length": _counted({t: {c: f"length({c}) > {EXTERNAL_ID_LENGTHS[c]}"} for t, c in LENGTHS.items()}),
        "audit_observed": _statement(
            tuple(_audit_view(t) for t in NOT_NULL),
            "\nUNION ALL ".join(
                f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, count(*) AS total_rows, "
                f"count(*) FILTER ({broken}) AS violations FROM {_audit_view(table)}"
                for table, rule, column, broken in [
                    *((t, "not_null", c, f"{c} IS NULL") for t, columns in NOT_NULL.items() for c in columns),
                    *((t, "domain", c, f"NOT ({text})") for t, rules in DOMAINS.items() for c, text in rules.items()),
                    *((t, "length", c, f"length({c}) > {EXTERNAL_ID_LENGTHS[c]}") for t, c in LENGTHS.items()),
                ]
                if table != "raw_campaigns"
            ),
        ),
        "audit_unique": _statement(tuple(_audit_view(t) for t in UNIQUE), "\nUNION ALL ".join(unique)),
        "audit_unique_bitmaps": _statement(
            ("raw_payments", "raw_payouts"),
            "\nUNION ALL ".join(
                f"SELECT 'raw_{t}s' AS table_name, '{t}_id' AS key_columns, coalesce(sum(n), 0)::BIGINT AS total_rows, "
                "count(*) FILTER (n > 1) AS duplicate_keys, coalesce(sum(n - 1) FILTER (n > 1), 0)::BIGINT AS surplus_rows "
                f"FROM (SELECT count(*) AS n FROM raw_{t}s GROUP BY {t}_id)"
                for t in ("payment", "payout")
            ),
        ),
        "audit_foreign_keys_bitmaps": _statement(
            ("raw_payments", "raw_payouts"),
            "SELECT 'raw_payouts.payment_id' AS foreign_key, 'raw_payments.payment_id' AS \"references\", "
            "count(DISTINCT payment_id) AS orphan_keys, count(*) AS orphan_rows FROM raw_payouts "
            "WHERE payment_id IS NOT NULL AND payment_id NOT IN (SELECT payment_id FROM raw_payments)",
        ),
        "audit_foreign_keys": _statement(linked, "\nUNION ALL ".join(orphans)),
    }


def _row_counts(names: dict[str, str]) -> str:
    parts = [f"SELECT '{table}' AS table_name, count(*) AS row_count FROM {view}" for table, view in names.items()]
    return _statement(tuple(names.values()), "\nUNION ALL ".join(parts))


def _numbered(name: str, entity: str) -> str:
    return f"""SELECT '{entity}' AS entity, {entity}_external_id AS external_id,
        row_number() OVER (ORDER BY substr(md5({entity}_external_id), 1, 3), {entity}_external_id) AS surrogate_key
        FROM {name}"""


_EVENT_IDS = """SELECT event_id, owner, event_seq,
    substr(sha256(owner || ':' || event_type || ':' || strftime(event_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' || ':'
        || event_seq), 1, 32) AS derived_event_id
    FROM (SELECT *, coalesce(brand_external_id, '') AS owner,
        row_number() OVER (PARTITION BY coalesce(brand_external_id, '') ORDER BY event_id) AS event_seq
        FROM raw_events)"""


def _collisions(source: str, ids: str) -> str:
    return f"""SELECT '{source}' AS id_source, sum(n)::BIGINT AS total_events, count(*) AS distinct_ids,
        count(*) FILTER (n > 1) AS colliding_ids, coalesce(sum(n - 1) FILTER (n > 1), 0)::BIGINT AS surplus_events
        FROM (SELECT count(*) AS n FROM ({ids}) GROUP BY id)"""


def _report() -> str:
    figures = {
        "v1": ("raw_payments_gmv_cents", "mart_gmv_cents", "delta_cents"),
        "v2": ("ledger_margin_sum_cents", "mart_gross_margin_sum_cents", "delta_cents"),
        "v3": ("violation_count", "total_waterfall_rows"),
        "v4": ("mismatch_rows", "total_rows", "rate", "expected_min", "expected_max"),
        "v5": ("unmatched_row_count",),
        "v6": ("test_transaction_raw_gmv_cents", "test_transaction_ledger_gmv_cents"),
        "v7": ("min_take_rate_gross", "max_take_rate_gross", "non_null_rows", "expected_min", "expected_max"),
    }
    texts, parts = descriptions(DEFAULTS.payout_discrepancy, DEFAULTS.take_rate), []
    for view, names in figures.items():
        values = {"description": f"'{texts[view.upper()]}'", **{n: f"CAST({n} AS VARCHAR)" for n in names}}
        pairs = ", ".join(f"'{n}': {values[n]}" for n in sorted(values))
        parts.append(
            f"SELECT '{view.upper()}' AS name, status, CAST(to_json({{{pairs}}}) AS VARCHAR) AS detail FROM {view}"
        )
    rows = "\nUNION ALL ".join(parts)
    return _statement(
        tuple(figures),
        f"""SELECT *, count(*) OVER () AS total, count(*) FILTER (status = 'pass') OVER () AS passed,
        count(*) FILTER (status <> 'pass') OVER () AS failed FROM ({rows})""",
    )


def statements() -> dict[str, str]:
    """DuckDB SQL by query name."""
    latest = "QUALIFY row_number() OVER (ORDER BY month DESC) = 1"
    matrix = ", ".join(f"max(retention_pct) FILTER (month_index = {k}) AS \"M+{k}\"" for k in range(12))
    return {
        "load_raw": _columns(f"* REPLACE ({_text('paid_at')} AS paid_at)", "raw_payments"),
        "load_raw_multiline": _columns(
            f"* REPLACE ({_text('paid_at')} AS paid_at, CASE WHEN payment_id % 7 = 3 THEN status || chr(10) || "
            "'\"see\", no. ' || payment_id || chr(10) ELSE status END AS status)",
            "raw_payments",
        ),
        "load_row_counts": _statement(
            ("dim_brand", "dim_creator", "raw_campaigns", "raw_payments", "payout_requests", "raw_events"),
            """SELECT *, expected_rows = loaded_rows AS is_complete FROM (
            SELECT 'dim_brand' AS table_name, (SELECT count(*) FROM customer) AS expected_rows,
                (SELECT count(*) FROM dim_brand) AS loaded_rows
            UNION ALL SELECT 'dim_creator', (SELECT count(*) FROM supplier), (SELECT count(*) FROM dim_creator)
            UNION ALL SELECT 'raw_campaigns', (SELECT count(*) FROM orders), (SELECT count(*) FROM raw_campaigns)
            UNION ALL SELECT 'raw_payments', (SELECT count(*) FROM orders), (SELECT count(*) FROM raw_payments)
            UNION ALL SELECT 'raw_payouts', (SELECT count(*) FROM orders), (SELECT count(payment_id) FROM payout_requests)
            UNION ALL SELECT 'raw_subscription_events',
                (SELECT count(*) + count(*) FILTER (o_orderkey % 50 = 7) FROM orders), (SELECT count(*) FROM raw_events))
            """,
        ),
        "assign_surrogate_keys": _statement(
            ("dim_brand", "dim_creator"),
            f"{_numbered('dim_brand', 'brand')} UNION ALL {_numbered('dim_creator', 'creator')}",
        ),
        "resolve_campaign_fks": _columns(
            "* EXCLUDE (campaign_ref) "
            f"REPLACE ({_text('created_at')} AS created_at, {_text('completed_at')} AS completed_at)",
            "raw_campaigns",
        ),
        "campaign_load_summary": _statement(
            ("campaign_requests", "raw_campaigns"),
            """SELECT total_campaigns, loaded_campaigns, total_campaigns - loaded_campaigns AS skipped_campaigns
            FROM (SELECT (SELECT count(*) FROM campaign_requests) AS total_campaigns,
                (SELECT count(*) FROM raw_campaigns) AS loaded_campaigns)""",
        ),
        "resolve_payment_fks": _statement(
            ("raw_payments", "raw_campaigns"),
            """SELECT payment_id, c.campaign_id, amount_gross_cents
            FROM raw_payments p LEFT JOIN raw_campaigns c ON c.campaign_id = p.campaign_id""",
        ),
        "resolve_payout_fks": _statement(
            ("payout_requests",), "SELECT * FROM payout_requests WHERE payment_id IS NOT NULL"
        ),
        "dim_date": """SELECT d AS date_day, year(d)::INT AS year, quarter(d)::INT AS quarter, month(d)::INT AS month,
            weekofyear(d)::INT AS week, dayofweek(d)::INT AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
            date_trunc('month', d)::DATE AS month_start, last_day(d) AS month_end
            FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d FROM (
                SELECT date_trunc('month', min(o_orderdate)) - INTERVAL 6 MONTH AS lo,
                date_trunc('month', max(o_orderdate)) + INTERVAL 17 MONTH - INTERVAL 1 DAY AS hi FROM orders))""",
        "raw_event_ids": _statement(("raw_events",), _EVENT_IDS),
        "raw_event_id_collisions": _statement(
            ("raw_events",),
            f"{_collisions('loaded', 'SELECT raw_event_id AS id FROM raw_events')} UNION ALL "
            f"{_collisions('derived', f'SELECT derived_event_id AS id FROM ({_EVENT_IDS})')}",
        ),
        "dedup_events": _columns(f"* REPLACE ({_text('event_at')} AS event_at)", "deduped"),
        "coerce_event_time": _statement(
            ("raw_events",),
            f"""SELECT event_id, _tz_coerced, {_text("kept_at")} AS event_at,
            {_text("CASE WHEN _tz_coerced THEN coalesce(kept_at, TIMESTAMP '2002-12-31') ELSE kept_at END")} AS event_at_utc
            FROM (SELECT *, CASE WHEN event_id // 2 % 100 <> 31 THEN event_at END AS kept_at FROM raw_events)""",
        ),
        "resolve_brands": _columns("event_id, brand_id, event_type, plan_name, event_date", "resolved"),
        "created_spans": _columns(
            "* EXCLUDE (sources), len(sources) AS source_event_count, list_min(sources) AS first_source_event_id, "
            "list_max(sources) AS last_source_event_id",
            "spans",
        ),
        "created_span_events": _columns("* EXCLUDE (sources), unnest(sources) AS source_event_id", "spans"),
        "cancel_dates": _columns("*", "cancelled"),
        "stg_subscriptions": _columns("* EXCLUDE (sources, amount_cents)", "subscriptions"),
        "subscription_sources": _columns("subscription_id, unnest(sources) AS event_id", "subscriptions"),
        "subscription_source_arrays": _columns(
            "subscription_id, part_no, array_to_string(event_ids, ',') AS event_ids",
            "source_parts",
        ),
        "stg_payments": _columns(f"* REPLACE ({_text('paid_at')} AS paid_at)", "payments"),
        "stg_payouts": _columns(f"* REPLACE ({_text('payout_at')} AS payout_at)", "payouts"),
        "colocated_payouts": _columns(f"* REPLACE ({_text('payout_at')} AS payout_at)", "payouts"),
        "quarantine_missing_brand": _statement(
            ("bad_events",), "SELECT * FROM bad_events WHERE reason = 'missing_brand_external_id'"
        ),
        "quarantine_ghost_brand": _statement(
            ("bad_events",), "SELECT * FROM bad_events WHERE reason = 'unresolvable_brand_external_id'"
        ),
        "quarantine_payments": _columns("*", "bad_payments"),
        "stg_unmatched_events": _columns("*", "unmatched"),
        "assert_lowercase_status": _columns("count(*) FILTER (status <> lower(status)) AS violations", "payments"),
        "assert_no_null_brand": _columns("count(*) FILTER (brand_id IS NULL) AS violations", "subscriptions"),
        "stage_row_counts": _row_counts(
            {
                "stg_subscriptions": "subscriptions",
                "stg_payments": "payments",
                "stg_payouts": "payouts",
                "stg_ledger_entries": "ledger",
                "stg_unmatched_events": "unmatched",
            }
        ),
        "ledger_entries": _columns("*", "ledger"),
        "ledger_entry_ids": _columns("*", "keyed_ledger"),
        "unmatched_row_ids": _columns("*", "keyed_unmatched"),
        "mart_daily_financials": _columns("*", "daily"),
        "assert_take_rate_band": _columns(
            "min(take_rate_gross) AS min_take_rate, max(take_rate_gross) AS max_take_rate, "
            "CAST(coalesce(min(take_rate_gross) < 0.05 OR max(take_rate_gross) > 0.2, false) AS INTEGER) AS violations",
            "daily",
        ),
        "brand_month_spine": _columns("*", "spine"),
        "brand_month_mrr": _columns("*", "levels"),
        "mrr_waterfall": _columns("*", "waterfall"),
        "mrr_continuity_violations": _columns("count(*) AS violations", "breaks"),
        "check_gmv_completeness": _columns("*", "v1"),
        "check_ledger_balance": _columns("*", "v2"),
        "check_mrr_invariant": _columns("*", "v3"),
        "check_payout_discrepancy_rate": _columns("*", "v4"),
        "check_unmatched_exist": _columns("*", "v5"),
        "check_no_test_in_mart": _columns("*", "v6"),
        "check_take_rate_range": _columns("*", "v7"),
        "validation_report": _report(),
        "insert_absent_subscriptions": _statement(
            ("early_subscriptions", "subscriptions"),
            """SELECT * EXCLUDE (amount_cents), 1 AS load_no FROM early_subscriptions
            UNION ALL SELECT * EXCLUDE (sources, amount_cents), 2 FROM subscriptions
            WHERE subscription_id NOT IN (SELECT subscription_id FROM early_subscriptions)""",
        ),
        "streamed_subscriptions": _columns("* EXCLUDE (sources, amount_cents)", "subscriptions"),
        "insert_absent_days": _statement(
            ("days_of_orders",),
            "SELECT * FROM days_of_orders QUALIFY row_number() OVER (PARTITION BY date_day ORDER BY load_no) = 1",
        ),
        "refresh_daily_financials": _columns(
            "*, entry_date IN (SELECT entry_date FROM ledger WHERE payment_id % 997 = 5) AS rebuilt", "daily"
        ),
        "refresh_mrr_waterfall": _columns(
            "*, brand_id % 64 IN (SELECT brand_id % 64 FROM subscriptions WHERE brand_id % 50 = 7) AS rebuilt", "waterfall"
        ),
        "monthly_financials": _columns("*", "months"),
        "monthly_mrr_waterfall": _columns("*", "movements"),
        "net_revenue_retention": _statement(
            ("waterfall",),
            """SELECT month_start_date AS month, count(*) FILTER (mrr_end_cents > 0) AS active_brands,
            round((sum(mrr_start_cents) + sum(mrr_expansion_cents) - sum(mrr_contraction_cents)
                - sum(mrr_churned_cents))::DOUBLE / nullif(sum(mrr_start_cents), 0) * 100, 2) AS nrr_pct
            FROM waterfall GROUP BY 1""",
        ),
        "cohort_retention": _columns("*", "retention"),
        "cohort_matrix": _statement(
            ("retention",),
            f"SELECT strftime(cohort_month, '%Y-%m') AS cohort, {matrix} FROM retention GROUP BY cohort_month",
        ),
        "quarantine_breakdown": _statement(
            ("unmatched",), "SELECT reason, count(*) AS count FROM unmatched GROUP BY reason"
        ),
        "gmv_kpis": _statement(
            ("months",),
            f"""SELECT month, gmv_k,
            round((gmv_cents - g)::DOUBLE / greatest(g, 1) * 100, 1) AS gmv_mom_pct, platform_revenue_k,
            round((platform_revenue_cents - r)::DOUBLE / greatest(r, 1) * 100, 1) AS platform_revenue_mom_pct,
            gross_margin_k
            FROM (SELECT *, coalesce(lag(gmv_cents) OVER (ORDER BY month), gmv_cents) AS g,
                coalesce(lag(platform_revenue_cents) OVER (ORDER BY month), platform_revenue_cents) AS r FROM months)
            {latest}""",
        ),
        "mrr_kpis": _statement(
            ("movements",),
            f"""SELECT month, mrr_end_k, round((mrr_end_cents - m)::DOUBLE / greatest(m, 1) * 100, 1) AS mrr_mom_pct,
            (new_cents + expansion_cents + contraction_cents + churned_cents)::DOUBLE / 100000 AS net_new_mrr_k
            FROM (SELECT *, coalesce(lag(mrr_end_cents) OVER (ORDER BY month), mrr_end_cents) AS m FROM movements)
            {latest}""",
        ),
        **_audits(),
        "anomaly_profile": _statement(
            ("raw_events", "raw_payments", "raw_payouts", "dim_brand"),
            """SELECT *, round(affected_rows::DOUBLE / base_rows, 4) AS rate FROM (
            SELECT 'missing_brand_external_id' AS anomaly, 'raw_subscription_events' AS table_name,
                count(*) FILTER (brand_external_id IS NULL) AS affected_rows, count(*) AS base_rows FROM raw_events
            UNION ALL SELECT 'duplicate_event_id', 'raw_subscription_events',
                count(*) - count(DISTINCT raw_event_id), count(*) FROM raw_events
            UNION ALL SELECT 'timezone_drift', 'raw_subscription_events', count(*) FILTER (_tz_coerced), count(*)
                FROM raw_events
            UNION ALL SELECT 'null_campaign_id', 'raw_payments', count(*) FILTER (campaign_id IS NULL), count(*)
                FROM raw_payments
            UNION ALL SELECT 'partial_refund', 'raw_payments', count(*) FILTER (amount_refunded_cents > 0), count(*)
                FROM raw_payments
            UNION ALL SELECT 'status_case_drift', 'raw_payments',
                count(*) FILTER (status <> lower(trim(status))), count(*) FROM raw_payments
            UNION ALL SELECT 'unresolvable_entity', 'raw_payments', count(*) FILTER (brand_external_id NOT IN
                (SELECT brand_external_id FROM dim_brand)), count(*) FROM raw_payments
            UNION ALL SELECT 'payout_mismatch', 'raw_payouts',
                count(*) FILTER (amount_paid_cents <> expected_payout_cents), count(*) FROM raw_payouts)""",
        ),
        "fee_audit": _statement(
            ("raw_payments", "raw_payouts"),
            f"""SELECT *, round((stored_platform_fee_cents + stored_processor_fee_cents)::DOUBLE / gross_cents, 6)
                AS effective_fee_rate
            FROM (SELECT date_trunc('month', paid_at)::DATE AS month, count(*) AS payments,
                sum(gross)::BIGINT AS gross_cents, sum(platform_fee_cents)::BIGINT AS stored_platform_fee_cents,
                sum(platform)::BIGINT AS due_platform_fee_cents, sum(stripe_fee_cents)::BIGINT AS stored_processor_fee_cents,
                sum(processor)::BIGINT AS due_processor_fee_cents,
                sum(gross - platform - processor)::BIGINT AS due_payout_cents,
                count(*) FILTER (platform_fee_cents <> platform) AS platform_fee_differs,
                count(*) FILTER (stripe_fee_cents <> processor) AS processor_fee_differs,
                count(*) FILTER (expected_payout_cents <> gross - platform - processor) AS expected_payout_differs
                FROM (SELECT p.*, expected_payout_cents, amount_gross_cents AS gross,
                    {_share("amount_gross_cents", "0.1")} AS platform,
                    {_share("amount_gross_cents", "0.029")} + 30 AS processor
                    FROM raw_payments p JOIN raw_payouts o ON o.payment_id = p.payment_id)
                GROUP BY 1)""",
        ),
    }
