"""The registered queries as standard SQL over the same tables, for checking results."""

from workload.events import DELIVERIES_CASE, FIELDS, FIRST_MS, PAYMENT_TEXT

_BLANK = r"'^\s*$'"
_NUMBER = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"
_NONFINITE = r"'^\s*[+-]?(inf|infinity|s?nan[0-9]*)\s*$'"


def _blank(column: str) -> str:
    return f"regexp_matches(coalesce({column}, ''), {_BLANK})"


_IS_NUMBER = f"regexp_matches(coalesce(payment_value, ''), {_NUMBER})"
_IS_NEGATIVE = f"({_IS_NUMBER} AND try_cast(trim(payment_value) AS DOUBLE) < 0)"
_IS_NONFINITE = f"regexp_matches(lower(coalesce(payment_value, '')), {_NONFINITE})"
_IS_UNREADABLE = f"(NOT {_IS_NUMBER} AND NOT {_IS_NONFINITE})"
_BAD_ID = f"({_blank('order_id')} OR {_blank('customer_id')})"
_NO_KEY = "(coalesce(order_id, '') = '' OR coalesce(customer_id, '') = '' OR created_date IS NULL)"


def _latest(name: str, keys: str, newest: str) -> str:
    return (
        f"(SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY {newest}) AS rk FROM {name}) WHERE rk = 1)"
    )


def _daily(source: str) -> str:
    """Average in integer units, rounded half up to six and then to two digits."""
    return f"""(
        SELECT revenue_date, total_orders, CAST(total AS DECIMAL(28,2)) AS gross_revenue,
               CAST(CAST(sign(total) * ((six + 5000) // 10000) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))
                    AS DECIMAL(18,2)) AS average_order_value
        FROM (SELECT *, CAST(abs(total) * 100 AS HUGEINT) * 20000 AS scaled, (scaled + n) // (2 * n) AS six
              FROM (SELECT created_date AS revenue_date, count(DISTINCT order_id) AS total_orders,
                           sum(parsed_payment_value) AS total,
                           CAST(nullif(count(parsed_payment_value), 0) AS HUGEINT) AS n
                    FROM {source}
                    WHERE created_date IS NOT NULL AND order_id IS NOT NULL AND trim(order_id) <> ''
                    GROUP BY created_date))
    )"""


def _activity(source: str) -> str:
    return f"""(
        SELECT customer_id, min(created_date) AS first_purchase_date, max(created_date) AS last_purchase_date,
               count(order_id) AS total_orders, CAST(sum(parsed_payment_value) AS DECIMAL(28,2)) AS total_spent,
               coalesce(string_agg(DISTINCT shown, ', ' ORDER BY shown), '') AS order_statuses
        FROM (SELECT *, CASE WHEN order_status = 'UNKNOWN' AND _is_remediated
                             THEN 'Thiếu thông tin trạng thái' ELSE order_status END AS shown FROM {source})
        WHERE customer_id IS NOT NULL AND order_id IS NOT NULL AND created_date IS NOT NULL
        GROUP BY customer_id
    )"""


def _repaired(source: str) -> str:
    return f"""(
        SELECT ingest_id, order_id, customer_id,
               CASE WHEN coalesce(order_status, '') = '' THEN 'UNKNOWN' ELSE order_status END AS order_status,
               order_purchase_timestamp, payment_value, parsed_payment_value, created_date, validation_status,
               coalesce(order_status, '') = '' AS _is_remediated,
               CASE WHEN coalesce(order_status, '') = '' THEN 'FIX_EMPTY_STATUS' END AS _remediation_rule
        FROM {source}
    )"""


_EVENTS = ", ".join(FIELDS)
_FIRST = "CAST(ingest_id AS BIGINT) < 2000000000000"
_NO_KEY_OF_A = "(coalesce(a.order_id, '') = '' OR coalesce(a.customer_id, '') = '' OR a.created_date IS NULL)"
_SAME_DELIVERY = "a.order_id IS NOT DISTINCT FROM b.order_id AND a.ingest_id IS NOT DISTINCT FROM b.ingest_id"

# Every step by name; a statement lists only those it needs.
_STEPS = {
    "delivered": (
        f"SELECT *, CAST(n AS BIGINT) AS delivery FROM (SELECT *, unnest("
        f"{DELIVERIES_CASE.format(two='[1, 2]', one='[1]')}) AS n FROM orders)"
    ),
    "raw": "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in FIELDS.items()) + " FROM delivered",
    "labelled": f"""
        SELECT *, try_cast(payment_value AS DECIMAL(18,2)) AS parsed_payment_value,
               try_cast(order_purchase_timestamp AS DATE) AS created_date,
               CASE WHEN {_blank('order_status')} THEN 'EMPTY_STATUS' WHEN {_IS_NEGATIVE} THEN 'NEGATIVE_VALUE'
                    WHEN {_BAD_ID} OR {_IS_NONFINITE} THEN 'INVALID' ELSE 'VALID' END AS validation_status
        FROM raw""",
    "classified": f"""
        SELECT *, CASE WHEN validation_status IN ('NEGATIVE_VALUE', 'INVALID') OR {_NO_KEY}
                       THEN 'quarantine' ELSE 'clean' END AS route FROM labelled""",
    "clean": "SELECT * EXCLUDE (route) FROM classified WHERE route = 'clean'",
    "repaired": f"SELECT * FROM {_repaired('clean')}",
    "legacy": f"SELECT * FROM {_repaired('classified')}",
    "silver": f"SELECT * FROM {_latest('repaired', 'order_id', 'ingest_id DESC')}",
    "repaired_1": f"SELECT * FROM repaired WHERE {_FIRST}",
    "silver_1": f"SELECT * FROM {_latest('repaired_1', 'order_id', 'ingest_id DESC')}",
    "pending": "SELECT * EXCLUDE (route), 'PENDING' AS _status FROM classified WHERE route = 'quarantine'",
    "daily": f"SELECT * FROM {_daily('silver')}",
    "daily_1": f"SELECT * FROM {_daily('silver_1')}",
    "daily_old": f"SELECT * FROM {_daily('silver_1')} WHERE revenue_date < DATE '2000-01-01'",
    "activity": f"SELECT * FROM {_activity('silver')}",
    "activity_1": f"SELECT * FROM {_activity('silver_1')}",
    "numbered": "SELECT *, CAST(ingest_id AS BIGINT) AS num FROM raw",
    "decisions": """
        SELECT order_id, ingest_id, (['Y', ' n ', 'S', 'approved', 'maybe'])[num % 5 + 1] AS decision,
               CASE WHEN num % 4 = 0 THEN 'oops' ELSE concat(num % 1000, '.50') END AS corrected_value,
               'second auditor' AS reviewed_by, '2024-05-02T10:00:00' AS reviewed_at FROM numbered
        UNION ALL
        SELECT order_id, ingest_id, 'N',
               CASE WHEN num % 4 = 0 THEN 'oops' ELSE concat(num % 1000, '.50') END,
               'first auditor', '2024-05-01T10:00:00' FROM numbered WHERE num % 2 = 0""",
    "judged": """
        SELECT *, CASE WHEN verdict IS NULL THEN 'UNKNOWN_DECISION'
                       WHEN verdict = 'APPROVED' AND amount IS NULL THEN 'INVALID_AMOUNT' END AS reason
        FROM (SELECT *, CASE WHEN upper(trim(decision)) IN ('Y', 'APPROVED') THEN 'APPROVED'
                             WHEN upper(trim(decision)) IN ('N', 'REJECTED') THEN 'REJECTED'
                             WHEN upper(trim(decision)) IN ('S', 'SKIP') THEN 'SKIP' END AS verdict,
                     try_cast(corrected_value AS DECIMAL(18,2)) AS amount FROM decisions)""",
    "located": f"""
        SELECT b.* REPLACE (CASE WHEN a.ingest_id IS NULL THEN 'NOT_PENDING'
                                 WHEN b.verdict = 'APPROVED' AND {_NO_KEY_OF_A} THEN 'BREAKS_KEY_CONTRACT' END AS reason)
        FROM judged b LEFT JOIN pending a ON {_SAME_DELIVERY} WHERE b.reason IS NULL AND b.verdict <> 'SKIP'""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY order_id, ingest_id ORDER BY reviewed_at DESC) AS place
        FROM located WHERE reason IS NULL""",
    "final": "SELECT * FROM ranked WHERE place = 1",
    "decided": f"""
        SELECT a.*, b.verdict, b.amount, b.reviewed_by, b.reviewed_at
        FROM pending a JOIN final b ON {_SAME_DELIVERY}""",
    "approved": """
        SELECT ingest_id, order_id, customer_id, order_status, order_purchase_timestamp,
               CAST(amount AS VARCHAR) AS payment_value, amount AS parsed_payment_value, created_date,
               'VALID' AS validation_status, true AS _is_remediated, 'HUMAN_OVERRIDE' AS _remediation_rule
        FROM decided WHERE verdict = 'APPROVED'""",
    "updates": f"SELECT * FROM {_latest('approved', 'order_id', 'ingest_id DESC')}",
    "reviewed": f"""
        SELECT a.* REPLACE (coalesce(b.verdict, a._status) AS _status)
        FROM pending a LEFT JOIN final b ON {_SAME_DELIVERY}""",
    "audit": """
        SELECT order_id, coalesce(payment_value, 'None') AS old_value,
               CASE WHEN verdict = 'APPROVED' THEN CAST(amount AS VARCHAR) ELSE 'N/A' END AS new_value,
               'payment_value' AS field_changed,
               CASE WHEN verdict = 'APPROVED' THEN 'APPROVE_AND_FIX' ELSE 'REJECT' END AS action,
               reviewed_by, reviewed_at FROM decided""",
    "reviewed_silver": (
        "SELECT * FROM updates UNION ALL SELECT * FROM silver WHERE order_id NOT IN (SELECT order_id FROM updates)"
    ),
    "silver_2": f"SELECT * FROM {_latest('(SELECT * FROM repaired WHERE NOT ' + _FIRST + ')', 'order_id', 'ingest_id DESC')}",
    "same_ids": f"""
        SELECT DISTINCT CASE WHEN order_id <> '' THEN concat('c', coalesce(try_cast(customer_id AS BIGINT), 0) % 10)
                             ELSE order_id END AS order_id,
               customer_id, order_status, order_purchase_timestamp, payment_value, created_date,
               length(concat_ws('|', order_purchase_timestamp, payment_value, customer_id)) % 3 AS verdict
        FROM classified WHERE route = 'quarantine'""",
    "legacy_daily": f"SELECT * FROM {_daily('legacy')}",
    "legacy_activity": f"SELECT * FROM {_activity('legacy')}",
}
_ORDER = list(_STEPS)


def _needs(text: str) -> set[str]:
    import re

    direct = {s for s in _STEPS if re.search(rf"(?<![\w.']){s}(?![\w'])", text)}
    found = set(direct)
    for step in direct:
        if _STEPS[step] != text:
            found |= _needs(_STEPS[step]) - {step}
    return found


def _sql(select: str) -> str:
    needed = _needs(select)
    steps = ", ".join(f"{s} AS ({_STEPS[s]})" for s in _ORDER if s in needed)
    return f"WITH {steps} {select}" if steps else select


def _incremental(days_back: int) -> str:
    cutoff = f"(SELECT max(revenue_date) - INTERVAL '{days_back}' DAY FROM daily_old)"
    return f"""
        SELECT * FROM daily WHERE revenue_date >= {cutoff}
        UNION ALL
        SELECT * FROM daily_old WHERE revenue_date < {cutoff}
                                   OR revenue_date NOT IN (SELECT revenue_date FROM daily)"""


def _contract(table: str, source: str, key: str, filled: list[str]) -> str:
    rows = [
        f"SELECT '{table}' AS \"table\", '{key}' AS \"column\", 'unique' AS test, count(*) AS failures FROM "
        f"(SELECT {key} FROM {source} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
    ]
    rows += [f"SELECT '{table}', '{c}', 'not_null', count(*) FROM {source} WHERE {c} IS NULL" for c in filled]
    return " UNION ALL ".join(rows)


_CONTRACTS = " UNION ALL ".join(
    [
        _contract("silver_transactions", "legacy", "order_id", ["order_id", "validation_status"]),
        _contract(
            "daily_revenue",
            "legacy_daily",
            "revenue_date",
            ["revenue_date", "total_orders", "gross_revenue", "average_order_value"],
        ),
        _contract(
            "customer_activity",
            "legacy_activity",
            "customer_id",
            ["customer_id", "first_purchase_date", "last_purchase_date", "total_spent"],
        ),
    ]
)

_EXPECTATIONS = """
    SELECT 'not_null' AS "check", 'order_id' AS "column", count(*) FILTER (order_id IS NULL) AS failed,
           count(*) AS total, count(*) FILTER (order_id IS NULL) = 0 AS success FROM legacy
    UNION ALL
    SELECT 'at_least_0', 'parsed_payment_value', count(*) FILTER (parsed_payment_value < 0), count(*),
           count(*) FILTER (parsed_payment_value < 0) = 0 FROM legacy"""


def _report(layer: str, source: str, breakdown: str | None = None) -> str:
    parts = [f"SELECT '{layer}' AS layer, 'rows' AS metric, 'all' AS key, count(*) AS value FROM {source}"]
    if breakdown:
        parts.append(f"SELECT '{layer}', 'breakdown', {breakdown}, count(*) FROM {source} GROUP BY {breakdown}")
    return " UNION ALL ".join(parts)


_REPORT = " UNION ALL ".join(
    [
        _report("bronze_transactions", "raw"),
        _report(
            "silver_transactions",
            "silver",
            "concat('validation_status=', validation_status, '|_is_remediated=', _is_remediated)",
        ),
        _report("silver_pending_review", "reviewed", "concat('_status=', _status)"),
        _report("audit_log", "audit"),
        _report("daily_revenue", "daily"),
        "SELECT 'customer_activity', 'missing', 'all', NULL",
    ]
)

_VIOLATIONS = ", ".join(
    f"CASE WHEN {test} THEN '{name}' END"
    for name, test in [
        ("EMPTY_STATUS", _blank("order_status")),
        ("NEGATIVE_VALUE", _IS_NEGATIVE),
        ("INVALID_ID", _BAD_ID),
        ("NON_FINITE_VALUE", _IS_NONFINITE),
        ("UNREADABLE_VALUE", _IS_UNREADABLE),
        ("MISSING_DATE", "try_cast(order_purchase_timestamp AS DATE) IS NULL"),
    ]
)

_STRICT = f"""
    SELECT ingest_id, label AS validation_status,
           CASE WHEN label NOT IN ('VALID', 'EMPTY_STATUS') OR {_BAD_ID} OR created_date IS NULL OR {_IS_NEGATIVE}
                     OR {_IS_NONFINITE} OR {_IS_UNREADABLE} THEN 'quarantine' ELSE 'clean' END AS route
    FROM (SELECT *, CASE WHEN {_blank('order_status')} THEN 'EMPTY_STATUS' WHEN {_IS_NEGATIVE} THEN 'NEGATIVE_VALUE'
                         WHEN {_BAD_ID} OR {_IS_NONFINITE} OR {_IS_UNREADABLE} THEN 'INVALID' ELSE 'VALID'
                    END AS label FROM labelled)"""

_ENVELOPE = """
    SELECT concat(substr(stamp, 1, 8), '-', substr(stamp, 9, 4), '-7', substr(digest, 1, 3), '-',
                  substr('89ab', ascii(substr(digest, 4, 1)) % 4 + 1, 1), substr(digest, 5, 3), '-',
                  substr(digest, 8, 12)) AS ingest_id,
           coalesce(order_id, '') AS order_id, coalesce(customer_id, '') AS customer_id,
           coalesce(order_status, '') AS order_status, order_purchase_timestamp, '0.00' AS payment_value
    FROM (SELECT *, lpad(format('{:x}', coalesce(epoch_ms(try_cast(order_purchase_timestamp AS TIMESTAMP)), 0)),
                         12, '0') AS stamp,
                 sha256(concat(coalesce(order_id, ''), chr(31), coalesce(customer_id, ''), chr(31),
                               coalesce(order_purchase_timestamp, ''))) AS digest FROM raw)"""

_FAULTS = """
    SELECT ingest_id, CASE WHEN NOT draw < 0.10 THEN order_id END AS order_id, customer_id,
           CASE WHEN draw >= 0.10 AND draw < 0.30 AND coin THEN '' ELSE order_status END AS order_status,
           order_purchase_timestamp,
           CASE WHEN draw >= 0.10 AND draw < 0.30 AND NOT coin THEN '-150.75' ELSE payment_value END AS payment_value
    FROM (SELECT *, CAST(CAST(concat('0x', substr(digest, 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296 AS draw,
                 substr(digest, 9, 1) < '8' AS coin
          FROM (SELECT *, md5(concat(ingest_id, '|42')) AS digest FROM raw))"""

_PAYMENTS = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           o_orderstatus AS order_status, CAST(o_orderdate AS VARCHAR) AS order_purchase_timestamp,
           CASE WHEN nans > 0 THEN 'nan' WHEN huge > 0 THEN '-inf'
                ELSE CAST(CAST(coalesce(paid, 0.00) AS DECIMAL(38,2)) AS VARCHAR) END AS payment_value
    FROM orders LEFT JOIN (
        SELECT l_orderkey, sum(coalesce(CASE WHEN amount NOT IN ('n/a', 'NaN', '-1e40') THEN
                               CAST(replace(amount, '_', '') AS DECIMAL(30,2)) END, 0.00)) AS paid,
               count(*) FILTER (amount = 'NaN') AS nans, count(*) FILTER (amount = '-1e40') AS huge
        FROM (SELECT l_orderkey, {PAYMENT_TEXT} AS amount FROM lineitem) GROUP BY l_orderkey
    ) ON l_orderkey = o_orderkey"""

_PUBLISHED = f"""
    SELECT concat(substr(stamp, 1, 8), '-', substr(stamp, 9, 4), '-7', substr(digest, 1, 3), '-',
                  substr('89ab', ascii(substr(digest, 4, 1)) % 4 + 1, 1), substr(digest, 5, 3), '-',
                  substr(digest, 8, 12)) AS ingest_id,
           order_id, customer_id, order_status, order_purchase_timestamp, payment_value
    FROM (SELECT *, lpad(format('{{:x}}', {FIRST_MS}), 12, '0') AS stamp,
                 sha256(concat_ws(chr(31), order_id, customer_id, order_status, order_purchase_timestamp,
                                  payment_value)) AS digest FROM ({_PAYMENTS}))"""

def _republished(status: str) -> str:
    return f"""
        SELECT order_id, {status} AS order_status, payment_value FROM ({_PAYMENTS})
        WHERE payment_value NOT IN ('nan', '-inf')"""


_MAX_DAILY = (
    "SELECT revenue_date, max(total_orders) AS total_orders, max(gross_revenue) AS gross_revenue, "
    "max(average_order_value) AS average_order_value "
    "FROM (SELECT * FROM daily UNION ALL SELECT * FROM daily_1) GROUP BY revenue_date"
)
_MAX_ACTIVITY = (
    "SELECT customer_id, max(first_purchase_date) AS first_purchase_date, "
    "max(last_purchase_date) AS last_purchase_date, max(total_orders) AS total_orders, "
    "max(total_spent) AS total_spent, max(order_statuses) AS order_statuses "
    "FROM (SELECT * FROM activity UNION ALL SELECT * FROM activity_1) GROUP BY customer_id"
)
_BLANK_DAYS = """
    SELECT customer_id, day AS revenue_date, count(*) AS total_orders
    FROM (SELECT *, CASE WHEN created_date IS NOT NULL THEN CAST(created_date AS VARCHAR)
                         WHEN validation_status = 'VALID' THEN '  ' END AS day FROM labelled)
    WHERE day IS NOT NULL AND trim(day) <> '' GROUP BY customer_id, day"""

_BAD_DECISIONS = f"""
    SELECT order_id, ingest_id, decision, corrected_value, reviewed_by, reviewed_at, reason
    FROM judged WHERE reason IS NOT NULL
    UNION ALL
    SELECT order_id, ingest_id, decision, corrected_value, reviewed_by, reviewed_at, 'SUPERSEDED'
    FROM ranked WHERE place > 1
    UNION ALL
    SELECT order_id, ingest_id, decision, corrected_value, reviewed_by, reviewed_at, reason
    FROM located WHERE reason IS NOT NULL"""

_SILVER = "SELECT * FROM silver"
_PENDING = "SELECT * FROM pending"
_WITH_BATCH = f"SELECT *, CASE WHEN {_FIRST} THEN CAST(0 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS batch_id FROM raw"
_BRONZE_SAMPLE = "ingest_id,order_id,order_status,payment_value,ingested_at"
_SILVER_SAMPLE = "order_id,parsed_payment_value,validation_status,_is_remediated,_remediation_rule"
_MISSING = ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in FIELDS)
_ANY_NULL = " OR ".join(f"{f} IS NULL" for f in FIELDS)

# The length of an event as JSON text without spaces, NULLs written out.
_AS_JSON = "concat('{', " + ", ',', ".join(
    f"'\"{f}\":', coalesce('\"' || {f} || '\"', 'null')" for f in FIELDS
) + ", '}')"

ORACLES = {
    name: _sql(select)
    for name, select in {
        "csv_roundtrip_scan": "SELECT " + ", ".join(f"coalesce({f}, '') AS {f}" for f in FIELDS) + " FROM raw",
        "decode_events_json": "SELECT * FROM raw",
        "structural_split_sound": f"SELECT * FROM raw WHERE NOT ({_ANY_NULL})",
        "structural_dlq_split": (
            f"SELECT *, concat('required field is null: ', concat_ws(',', {_MISSING})) AS error "
            f"FROM raw WHERE {_ANY_NULL}"
        ),
        "orders_payments_join": _PAYMENTS,
        "chronological_events": (
            "SELECT * EXCLUDE (moment), rank() OVER (ORDER BY moment NULLS FIRST, order_id NULLS FIRST) AS place "
            "FROM (SELECT *, try_cast(order_purchase_timestamp AS TIMESTAMP) AS moment FROM raw)"
        ),
        "redelivery_newest_wins": _republished("order_status"),
        "upsert_last_batch_wins": _republished("'processing'"),
        "event_envelope": _ENVELOPE,
        "published_events": _PUBLISHED,
        "fault_injection": _FAULTS,
        "validation_labels": "SELECT * FROM labelled",
        "validation_violations": f"SELECT ingest_id, concat_ws(',', {_VIOLATIONS}) AS violations FROM raw",
        "route_clean": "SELECT * FROM clean",
        "route_quarantine": _PENDING,
        "route_strict": _STRICT,
        "remediate_status": "SELECT * FROM repaired",
        "dedupe_latest": f"SELECT * FROM {_latest('raw', 'order_id', 'ingest_id DESC')}",
        "upsert_silver": _SILVER,
        "upsert_silver_newest": _SILVER,
        "upsert_silver_protected": (
            "SELECT * FROM silver_1 WHERE _is_remediated UNION ALL SELECT * FROM silver WHERE order_id NOT IN "
            "(SELECT order_id FROM silver_1 WHERE _is_remediated)"
        ),
        "upsert_pending": _PENDING,
        "upsert_pending_closed": (
            f"SELECT * REPLACE (CASE WHEN {_FIRST} THEN 'REJECTED' ELSE _status END AS _status) FROM pending"
        ),
        "quarantine_same_ids": (
            "SELECT DISTINCT '9' AS ingest_id, '' AS order_id, customer_id, order_status, order_purchase_timestamp, "
            "payment_value FROM raw"
        ),
        "daily_revenue_model": "SELECT * FROM daily",
        "daily_revenue_all_deliveries": f"SELECT * FROM {_daily('clean')}",
        "daily_revenue_incremental": _incremental(0),
        "daily_revenue_lookback": _incremental(365),
        "customer_activity_model": "SELECT * FROM activity",
        "dedup_view_daily_revenue": _MAX_DAILY,
        "dedup_view_customer_activity": _MAX_ACTIVITY,
        "gold_delete_blank_dates": _BLANK_DAYS,
        "pending_queue_open": "SELECT * FROM reviewed WHERE _status = 'PENDING'",
        "review_silver_updates": "SELECT * FROM updates",
        "review_pending_status": "SELECT * FROM reviewed",
        "review_audit_log": "SELECT * FROM audit",
        "review_bad_decisions": _BAD_DECISIONS,
        "purge_kept": f"SELECT * FROM legacy WHERE NOT {_NO_KEY}",
        "purge_moved": (
            f"SELECT * EXCLUDE (_is_remediated, _remediation_rule), 'PENDING' AS _status FROM legacy WHERE {_NO_KEY}"
        ),
        "contract_failures_per_test": _CONTRACTS,
        "expectation_checks": _EXPECTATIONS,
        "expectation_alerts": (
            "SELECT concat('quality check ', \"check\", '(', \"column\", ') failed for ', failed, ' of ', total, "
            f"' rows') AS message FROM ({_EXPECTATIONS}) WHERE NOT success"
        ),
        "inspect_report": _REPORT,
        "inspect_breakdown": "SELECT validation_status, _is_remediated, count(*) AS count FROM silver GROUP BY ALL",
        "top_days": "SELECT * FROM daily ORDER BY revenue_date DESC LIMIT 3",
        "top_customers": "SELECT * FROM activity ORDER BY total_spent DESC NULLS LAST, customer_id LIMIT 3",
        "bronze_append": _WITH_BATCH,
        "table_upsert_silver": _SILVER,
        "table_review_silver": (
            "SELECT * FROM updates UNION ALL SELECT * FROM silver WHERE order_id NOT IN "
            "(SELECT order_id FROM updates WHERE order_id IS NOT NULL)"
        ),
        "table_review_twice": (
            "SELECT * FROM updates UNION ALL SELECT * FROM silver WHERE order_id NOT IN "
            "(SELECT order_id FROM updates WHERE order_id IS NOT NULL)"
        ),
        "table_review_audit": "SELECT * FROM audit",
        "table_review_pending": "SELECT * FROM reviewed",
        "table_purge_pending": (
            f"SELECT * EXCLUDE (_is_remediated, _remediation_rule), 'PENDING' AS _status FROM legacy WHERE {_NO_KEY}"
        ),
        "table_activity_refresh": "SELECT * FROM activity",
        "table_full_refresh": "SELECT * FROM daily",
        "stored_views": "SELECT * FROM daily WHERE revenue_date IS NOT NULL",
        "contracts_on_tables": _CONTRACTS.replace("legacy_daily", "daily").replace("legacy_activity", "activity").replace("legacy", "silver"),
        "csv_orders_payments_join": _PAYMENTS,
        "table_purge_silver": f"SELECT * FROM legacy WHERE NOT {_NO_KEY}",
        "table_gold_refresh": _incremental(0),
        "stream_silver": _SILVER,
        "stream_quarantine": _PENDING,
        "stream_bronze": "SELECT *, CAST(0 AS BIGINT) AS batch_id FROM raw",
        "stream_rate_limited": f"SELECT ingest_id, count(*) OVER (PARTITION BY {_FIRST}) AS in_batch FROM raw",
        "stream_expectations": " UNION ALL ".join(
            f"SELECT {batch} AS batch, * FROM ({_EXPECTATIONS.replace('legacy', source)})"
            for batch, source in enumerate(("silver_1", "silver_2"))
        ),
        "stream_structural_split": (
            f"SELECT *, NULL AS error, CAST(NULL AS BIGINT) AS alert FROM raw WHERE NOT ({_ANY_NULL}) UNION ALL "
            f"SELECT *, concat('required field is null: ', concat_ws(',', {_MISSING})) AS error, "
            f"count(*) OVER (PARTITION BY {_FIRST}) AS alert FROM raw WHERE {_ANY_NULL}"
        ),
        "stream_watermark_dedup": " UNION ALL ".join(
            f"SELECT order_id, {status} AS order_status, payment_value FROM ({_PAYMENTS})"
            for status in ("'processing'", "order_status")
        ),
        "gold_touched_days": f"SELECT * FROM {_daily('reviewed_silver')}",
        "table_review_same_ids": f"""
            SELECT 'row' AS what, order_id, customer_id, payment_value,
                   CASE verdict WHEN 1 THEN 'REJECTED' WHEN 2 THEN 'PENDING'
                                ELSE CASE WHEN {_NO_KEY} THEN 'PENDING' ELSE 'APPROVED' END END AS _status FROM same_ids
            UNION ALL
            SELECT 'silver', order_id, NULL, '12.50', NULL FROM same_ids WHERE verdict = 0 AND NOT {_NO_KEY} GROUP BY order_id
            UNION ALL
            SELECT 'bad', order_id, NULL, NULL, 'BREAKS_KEY_CONTRACT' FROM same_ids WHERE verdict = 0 AND {_NO_KEY}
            UNION ALL
            SELECT CASE kind WHEN 1 THEN 'payload' ELSE 'bad' END, CASE kind WHEN 1 THEN order_id END,
                   CASE kind WHEN 1 THEN customer_id END, CASE kind WHEN 1 THEN payment_value END,
                   CASE WHEN kind = 2 THEN 'BREAKS_KEY_CONTRACT' WHEN verdict = 1 THEN 'REJECTED' ELSE 'PENDING' END
            FROM (SELECT *, (7 + length({_AS_JSON})) % 3 AS verdict FROM raw WHERE NOT {_FIRST}), (VALUES (1), (2)) AS k(kind)
            WHERE kind = 1 OR verdict = 0""",
        "review_found": "SELECT * FROM pending WHERE order_id <> '' ORDER BY order_id, ingest_id LIMIT 1",
        "temporary_views": (
            "SELECT customer_id, last_purchase_date, total_spent, gross_revenue FROM activity "
            "LEFT JOIN daily ON last_purchase_date = revenue_date WHERE customer_id IS NOT NULL"
        ),
        "first_refresh": "SELECT *, 'after' AS read FROM daily",
        "layer_samples": " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, least(3, count(*)) AS n, least(3, count(*)) AS n_held, '{columns}' AS columns FROM {source}"
            for layer, source, columns in (
                ("bronze_transactions", "raw", _BRONZE_SAMPLE),
                ("silver_transactions", "silver", _SILVER_SAMPLE),
            )
        ),
        "stream_interval": f"SELECT ingest_id, count(*) OVER (PARTITION BY {_FIRST}) AS in_batch FROM raw",
        "stream_corrupt_quarantine": " UNION ALL ".join(
            f"SELECT *, '{layer}' AS layer FROM raw WHERE CAST(ingest_id AS BIGINT) % 3 = 0 "
            f"UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, '{layer}' FROM range(4)"
            for layer in ("bronze", "quarantine")
        ),
    }.items()
}
