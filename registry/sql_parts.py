"""Named SQL parts of the checks, and the assembly of a check from the parts it names."""

from __future__ import annotations

import re

from registry.inputs import COMPLAINT_ANSWERS, LABEL_ANSWERS, MODEL_ANSWERS
from shopvitals.sources.fixture_sql import VIEWS

TABLES = ("orders", "customer", "nation", "lineitem", "supplier", "events", "documents")


# Fixed values, stated here on their own so that a wrong rule of the code shows.
LABEL_FIELDS = ("ai_category", "ai_severity", "customer_emotion", "business_impact", "recommended_action")
_BY_KEYWORD = {
    "payment|upi|card": "payment_issue/high/frustrated/revenue_risk/Check payment gateway logs and failed payment events.",
    "late|delay|delivery": "late_delivery/medium/angry/customer_churn_risk/Check delivery partner SLA and delayed delivery events.",
    "refund": "refund_delay/high/frustrated/trust_risk/Check refund processing queue and payment reversal status.",
    "wrong|different": "wrong_product/medium/disappointed/return_risk/Check warehouse picking and product mapping process.",
    "": "app_issue/low/confused/minor_support_load/Check app logs and customer support ticket details.",
}
_RULE_TEXTS = {
    "root_cause": "Rule-based diagnosis. LLM skipped to reduce cost.",
    "business_impact": "Low cost monitoring mode used. Escalate to LLM only for serious issues.",
    "suggested_fix": "Review flagged metrics and run deeper investigation if issue continues.",
    "investigation_sql": "SELECT failure_reason, COUNT(*) FROM raw_payments WHERE payment_status='failed' AND payment_ts >= "
    "NOW() - INTERVAL '1 hour' GROUP BY failure_reason ORDER BY 2 DESC;",
}


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def half_up(total: str, n: str, digits: int) -> str:
    """round(total / n, digits) for whole numbers, ties away from zero; NULL for n = 0."""
    scale = 10**digits
    total, n = f"CAST({total} AS BIGINT)", f"CAST({n} AS BIGINT)"
    return (
        f"(sign({total}) * CAST((2 * {scale} * abs({total}) + {n}) // nullif(2 * {n}, 0) AS DOUBLE) / {scale})"
    )


def share(hits: str, n: str) -> str:
    return half_up(hits, n, 4)


def percent(rate: str) -> str:
    tenths = f"((CAST(round({rate} * 10000) AS BIGINT) + 5) // 10)"
    return f"concat({tenths} // 10, '.', {tenths} % 10, '%')"


def keyword_case(field: str, column: str = "complaint_text") -> str:
    i = LABEL_FIELDS.index(field)
    branches = " ".join(
        f"WHEN regexp_matches(lower({column}), '{words}') THEN {text(labels.split('/')[i])}"
        for words, labels in _BY_KEYWORD.items()
    )
    return f"CASE WHEN {column} IS NULL THEN NULL {branches} END"


def labelled(source: str) -> str:
    fields = ", ".join(f"{keyword_case(name)} AS {name}" for name in LABEL_FIELDS)
    return f"SELECT *, {fields} FROM {source}"


PARTS: dict[str, str] = {
    name: sql.format(**{t: t for t in TABLES}) for name, sql in VIEWS.items()
}
PARTS["a_raw_complaints"] = labelled("a_complaint_events")
PARTS["b_raw_complaints"] = labelled("b_complaint_events")

# ------------------------------------------------------------------------ staging


def cleaned(column: str, default: str = "unknown") -> str:
    return f"lower(trim(coalesce({column}, '{default}')))"


def amount(column: str) -> str:
    return f"coalesce(TRY_CAST({column} AS DECIMAL(10,2)), 0)"


def flag(column: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"coalesce(lower({column}) IN ({listed}), FALSE)"


def staging_parts(family: str) -> dict[str, str]:
    p = f"{family}_"
    minutes = {
        side: f"coalesce(CAST({side}_minutes AS INTEGER), 0)" for side in ("promised", "actual")
    }
    return {
        f"{p}stg_orders": f"""
            SELECT order_id, customer_id, coalesce(city, 'Unknown') AS city, order_ts,
                   CAST(order_ts AS DATE) AS order_date, hour(order_ts) AS order_hour,
                   {amount('order_amount')} AS order_amount,
                   {cleaned('order_status')} AS order_status,
                   {flag('order_status', 'cancelled')} AS is_cancelled,
                   {flag('order_status', 'delivered', 'shipped', 'confirmed')} AS is_active,
                   created_at
            FROM {p}raw_orders WHERE order_id IS NOT NULL""",
        f"{p}stg_payments": f"""
            SELECT payment_id, order_id, payment_ts, CAST(payment_ts AS DATE) AS payment_date,
                   hour(payment_ts) AS payment_hour, {cleaned('payment_method')} AS payment_method,
                   {cleaned('payment_status')} AS payment_status, {amount('amount')} AS amount,
                   CASE WHEN lower(payment_status) = 'failed'
                        THEN lower(trim(coalesce(failure_reason, 'unknown_failure'))) END AS failure_reason,
                   {flag('payment_status', 'success')} AS is_success,
                   {flag('payment_status', 'failed')} AS is_failed, created_at
            FROM {p}raw_payments WHERE payment_id IS NOT NULL""",
        f"{p}stg_deliveries": f"""
            SELECT delivery_id, order_id, coalesce(city, 'Unknown') AS city,
                   coalesce(delivery_partner, 'Unknown') AS delivery_partner,
                   created_at AS delivery_ts, CAST(created_at AS DATE) AS delivery_date,
                   hour(created_at) AS delivery_hour,
                   {minutes['promised']} AS promised_minutes, {minutes['actual']} AS actual_minutes,
                   {minutes['actual']} - {minutes['promised']} AS delay_minutes,
                   {minutes['actual']} > {minutes['promised']} AS is_delayed,
                   {cleaned('delivery_status')} AS delivery_status
            FROM {p}raw_deliveries WHERE delivery_id IS NOT NULL""",
        f"{p}stg_complaints": f"""
            SELECT complaint_id, order_id, complaint_ts, CAST(complaint_ts AS DATE) AS complaint_date,
                   hour(complaint_ts) AS complaint_hour, complaint_text,
                   {cleaned('ai_category', 'uncategorized')} AS ai_category,
                   {cleaned('ai_severity')} AS ai_severity,
                   {cleaned('customer_emotion')} AS customer_emotion,
                   {cleaned('business_impact')} AS business_impact,
                   {flag('ai_severity', 'high', 'critical')} AS is_severe,
                   {flag('ai_severity', 'critical')} AS is_critical,
                   coalesce(list_position(['low', 'medium', 'high', 'critical'], lower(ai_severity)), 0)
                       AS severity_score,
                   created_at
            FROM {p}raw_complaints WHERE complaint_id IS NOT NULL""",
        f"{p}stg_refunds": f"""
            SELECT refund_id, order_id, refund_ts, CAST(refund_ts AS DATE) AS refund_date,
                   hour(refund_ts) AS refund_hour, coalesce(refund_amount, 0) AS refund_amount,
                   {cleaned('refund_reason')} AS refund_reason, created_at
            FROM {p}raw_refunds WHERE refund_id IS NOT NULL""",
    }


def tier(hits: str, n: str, critical: float, warning: float) -> str:
    value = f"CAST({hits} AS DOUBLE) / {n}"
    return (
        f"CASE WHEN {value} >= {critical} THEN 'critical' WHEN {value} >= {warning} THEN 'warning' "
        "ELSE 'healthy' END"
    )


def mart_parts(family: str) -> dict[str, str]:
    p = f"{family}_"
    cents = "CAST(sum(order_amount) * 100 AS BIGINT)"
    cancelled = "count(*) FILTER (is_cancelled)"
    failed, late = "count(*) FILTER (is_failed)", "count(*) FILTER (is_delayed)"

    def minutes(side: str) -> str:
        return half_up(f"sum({side}_minutes)", "count(*)", 1)

    def day_mean(column: str, digits: int) -> str:
        """Mean of values already rounded to so many digits."""
        return half_up(f"sum(CAST(round({column} * {10 ** digits}) AS BIGINT))", f"({10 ** digits} * count({column}))", digits)

    return {
        f"{p}mart_order_summary": f"""
            SELECT order_date, city, count(*) AS total_orders,
                   count(DISTINCT customer_id) AS unique_customers,
                   count(*) - {cancelled} AS active_orders, {cancelled} AS cancelled_orders,
                   CAST(sum(order_amount) AS DOUBLE) AS total_revenue,
                   {half_up(cents, '(100 * count(*))', 2)} AS avg_order_value,
                   {share(cancelled, 'count(*)')} AS cancellation_rate
            FROM {p}stg_orders GROUP BY order_date, city""",
        f"{p}mart_payment_health": f"""
            SELECT payment_date, payment_method, count(*) AS total_payments,
                   count(*) FILTER (is_success) AS successful_payments, {failed} AS failed_payments,
                   {share('count(*) FILTER (is_success)', 'count(*)')} AS success_rate,
                   {share(failed, 'count(*)')} AS failure_rate,
                   CAST(coalesce(sum(amount) FILTER (is_success), 0) AS DOUBLE) AS successful_revenue,
                   CAST(coalesce(sum(amount) FILTER (is_failed), 0) AS DOUBLE) AS failed_revenue,
                   {tier(failed, 'count(*)', 0.30, 0.20)} AS health_status
            FROM {p}stg_payments GROUP BY payment_date, payment_method""",
        f"{p}mart_delivery_performance": f"""
            SELECT delivery_date, city, delivery_partner, count(*) AS total_deliveries,
                   count(*) - {late} AS on_time_deliveries, {late} AS delayed_deliveries,
                   {share(f'(count(*) - {late})', 'count(*)')} AS on_time_rate,
                   {share(late, 'count(*)')} AS delay_rate,
                   {minutes('promised')} AS avg_promised_minutes,
                   {minutes('actual')} AS avg_actual_minutes,
                   {minutes('delay')} AS avg_delay_minutes,
                   max(delay_minutes) AS max_delay_minutes,
                   {tier(late, 'count(*)', 0.40, 0.25)} AS health_status
            FROM {p}stg_deliveries GROUP BY delivery_date, city, delivery_partner""",
        f"{p}mart_complaint_insights": f"""
            SELECT complaint_date, ai_category, ai_severity, customer_emotion,
                   count(*) AS total_complaints, count(*) FILTER (is_severe) AS severe_complaints,
                   count(*) FILTER (is_critical) AS critical_complaints,
                   {share('count(*) FILTER (is_severe)', 'count(*)')} AS severe_rate,
                   {half_up('sum(severity_score)', 'count(*)', 2)} AS avg_severity_score
            FROM {p}stg_complaints
            GROUP BY complaint_date, ai_category, ai_severity, customer_emotion""",
        f"{p}bh_orders": f"""
            SELECT order_date AS dt, CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
                   CAST(sum(total_orders) AS BIGINT) AS total_orders,
                   {day_mean('avg_order_value', 2)} AS avg_order_value,
                   {day_mean('cancellation_rate', 4)} AS cancellation_rate
            FROM {p}mart_order_summary GROUP BY order_date""",
        f"{p}bh_payments": f"""
            SELECT payment_date AS dt, CAST(sum(total_payments) AS BIGINT) AS total_payments,
                   CAST(sum(failed_payments) AS BIGINT) AS failed_payments,
                   {day_mean('failure_rate', 4)} AS payment_failure_rate,
                   {day_mean('success_rate', 4)} AS payment_success_rate
            FROM {p}mart_payment_health GROUP BY payment_date""",
        f"{p}bh_deliveries": f"""
            SELECT delivery_date AS dt, CAST(sum(total_deliveries) AS BIGINT) AS total_deliveries,
                   {day_mean('delay_rate', 4)} AS delivery_delay_rate,
                   {day_mean('on_time_rate', 4)} AS delivery_on_time_rate,
                   {day_mean('avg_delay_minutes', 1)} AS avg_delay_minutes
            FROM {p}mart_delivery_performance GROUP BY delivery_date""",
        f"{p}bh_complaints": f"""
            SELECT complaint_date AS dt, CAST(sum(total_complaints) AS BIGINT) AS total_complaints,
                   {day_mean('severe_rate', 4)} AS complaint_severe_rate
            FROM {p}mart_complaint_insights GROUP BY complaint_date""",
    }


def business_health(family: str, ai: str | None) -> str:
    """The daily health mart as the chain of full outer joins."""
    p = f"{family}_"
    zero = lambda side, name, new=None: f"coalesce({side}.{name}, 0) AS {new or name}"
    day = "coalesce(o.dt, p.dt, d.dt, c.dt)"
    ai_rows = ai or (
        "(SELECT CAST(NULL AS DATE) AS dt, 0::DOUBLE AS pipeline_health_score, 0 AS alerts_sent, "
        "0::DOUBLE AS llm_usage_rate, 0::DOUBLE AS avg_severity, 0::DOUBLE AS avg_confidence WHERE FALSE)"
    )
    columns = [zero("o", n) for n in ("total_orders", "total_revenue", "avg_order_value", "cancellation_rate")]
    columns += [zero("p", n) for n in ("total_payments", "failed_payments", "payment_failure_rate", "payment_success_rate")]
    columns += [zero("d", n) for n in ("total_deliveries", "delivery_delay_rate", "delivery_on_time_rate", "avg_delay_minutes")]
    columns += [zero("c", n) for n in ("total_complaints", "complaint_severe_rate")]
    columns += [zero("a", n, f"ai_{n}") for n in ("alerts_sent", "llm_usage_rate", "avg_severity", "avg_confidence")]
    return f"""
        SELECT {day} AS business_date, {', '.join(columns)},
               coalesce(a.pipeline_health_score, 100) AS pipeline_health_score,
               CASE WHEN coalesce(p.payment_failure_rate, 0) > 0.30 THEN 'critical'
                    WHEN coalesce(p.payment_failure_rate, 0) > 0.20
                         OR coalesce(d.delivery_delay_rate, 0) > 0.25 THEN 'degraded'
                    ELSE 'healthy' END AS overall_status
        FROM {p}bh_orders o
        FULL JOIN {p}bh_payments p ON o.dt = p.dt
        FULL JOIN {p}bh_deliveries d ON coalesce(o.dt, p.dt) = d.dt
        FULL JOIN {p}bh_complaints c ON coalesce(o.dt, p.dt, d.dt) = c.dt
        LEFT JOIN {ai_rows} a ON {day} = a.dt
        WHERE {day} IS NOT NULL"""


for _family in ("a", "b"):
    PARTS.update(staging_parts(_family))
    PARTS.update(mart_parts(_family))
PARTS["a_business_health"] = business_health("a", None)
PARTS["b_business_health"] = business_health("b", "bh_ai")

# ------------------------------------------------------------------------ ticks and features

QUARTER = "INTERVAL 15 MINUTE"


def ticks(source: str) -> str:
    """Quarter hours from the first to the last event, on days with events and on two days after each."""
    return f"""
        SELECT run_timestamp FROM (
          SELECT unnest(generate_series(lo + {QUARTER}, hi + {QUARTER}, {QUARTER})) AS run_timestamp
          FROM (SELECT time_bucket({QUARTER}, min(ts)) AS lo, time_bucket({QUARTER}, max(ts)) AS hi
                FROM ({source}))) AS every
        WHERE CAST(run_timestamp AS DATE) IN (
          SELECT CAST(CAST(ts AS DATE) + CAST(d AS INTEGER) AS DATE) FROM ({source}) AS s, (SELECT unnest([0, 1, 2]) AS d) AS days)"""


_TIMES = {
    "orders": "SELECT order_ts AS ts FROM b_raw_orders",
    "payments": "SELECT payment_ts AS ts FROM b_raw_payments",
    "deliveries": (
        "SELECT created_at AS ts FROM b_raw_deliveries "
        "WHERE promised_minutes IS NOT NULL AND actual_minutes IS NOT NULL"
    ),
    "complaints": "SELECT complaint_ts AS ts FROM b_raw_complaints",
}
for _name, _source in _TIMES.items():
    PARTS[f"ticks_{_name}"] = ticks(_source)
PARTS["ticks"] = ticks(" UNION ALL ".join(_TIMES.values()))

# What counts in each domain: time, hit, label and extra measure of each row.
PARTS["orders_seen"] = """
    SELECT order_ts AS ts, FALSE AS hit, FALSE AS ok, city AS label,
           CASE WHEN order_status NOT IN ('cancelled', 'failed') THEN order_amount END AS extra
    FROM b_raw_orders"""
PARTS["payments_seen"] = """
    SELECT payment_ts AS ts, payment_status = 'failed' AS hit, payment_status = 'success' AS ok,
           CASE WHEN payment_status = 'failed' THEN failure_reason END AS label, 0 AS extra
    FROM b_raw_payments"""
PARTS["deliveries_seen"] = """
    SELECT created_at AS ts, actual_minutes > promised_minutes AS hit, FALSE AS ok,
           CASE WHEN actual_minutes > promised_minutes THEN city END AS label,
           actual_minutes - promised_minutes AS extra
    FROM b_raw_deliveries WHERE promised_minutes IS NOT NULL AND actual_minutes IS NOT NULL"""
PARTS["complaints_seen"] = """
    SELECT complaint_ts AS ts, ai_severity IN ('high', 'critical') AS hit, FALSE AS ok,
           ai_category AS label, 0 AS extra
    FROM b_raw_complaints"""


def within(minutes: int, run: str = "t.run_timestamp") -> str:
    return f"s.ts >= {run} - INTERVAL {minutes} MINUTE AND s.ts < {run}"


def window_totals(domain: str, tick_part: str) -> str:
    return f"""
        SELECT t.run_timestamp, count(s.ts) AS n, count(*) FILTER (s.hit) AS hits,
               count(*) FILTER (s.ok) AS oks, sum(s.extra) AS extra
        FROM {tick_part} t LEFT JOIN {domain}_seen s ON {within(30)}
        GROUP BY t.run_timestamp"""


def window_tops(domain: str, tick_part: str) -> str:
    return f"""
        SELECT run_timestamp, string_agg(concat(label, ':', cnt), ',' ORDER BY cnt DESC, label) AS top
        FROM (
          SELECT t.run_timestamp, s.label, count(*) AS cnt,
                 row_number() OVER (PARTITION BY t.run_timestamp ORDER BY count(*) DESC, s.label) AS place
          FROM {tick_part} t JOIN {domain}_seen s ON {within(30)}
          WHERE s.label IS NOT NULL GROUP BY t.run_timestamp, s.label
        ) WHERE place <= 5 GROUP BY run_timestamp"""


for _name in _TIMES:
    PARTS[f"{_name}_now"] = window_totals(_name, "ticks")
    PARTS[f"{_name}_now_own"] = window_totals(_name, f"ticks_{_name}")
    PARTS[f"{_name}_top"] = window_tops(_name, "ticks")

_FEATURES = f"""
    SELECT o.run_timestamp, 30 AS window_minutes,
           o.n AS orders, CAST(coalesce(o.extra, 0) AS DOUBLE) AS revenue,
           coalesce(ot.top, '') AS top_order_cities,
           p.n AS payments, p.hits AS failed, p.oks AS success,
           coalesce({share('p.hits', 'p.n')}, 0) AS failure_rate,
           coalesce(pt.top, '') AS top_failure_reasons,
           d.n AS deliveries, d.hits AS delayed,
           coalesce({share('d.hits', 'd.n')}, 0) AS delay_rate,
           coalesce({half_up('d.extra', 'd.n', 1)}, 0) AS avg_delay_minutes,
           coalesce(dt.top, '') AS top_delayed_cities,
           c.n AS complaints, c.hits AS severe,
           coalesce({share('c.hits', 'c.n')}, 0) AS severe_rate,
           coalesce(ct.top, '') AS top_categories
    FROM orders_now o
    JOIN payments_now p USING (run_timestamp)
    JOIN deliveries_now d USING (run_timestamp)
    JOIN complaints_now c USING (run_timestamp)
    LEFT JOIN orders_top ot USING (run_timestamp)
    LEFT JOIN payments_top pt USING (run_timestamp)
    LEFT JOIN deliveries_top dt USING (run_timestamp)
    LEFT JOIN complaints_top ct USING (run_timestamp)"""
PARTS["features"] = _FEATURES

# ------------------------------------------------------------------------ anomalies

_BUCKET = "date_trunc('hour', s.ts) + INTERVAL 30 MINUTE * (extract(minute FROM s.ts) // 30)"
METRIC_OF = {
    "payments": "payment_failure_rate",
    "deliveries": "delivery_delay_rate",
    "orders": "order_volume",
    "complaints": "complaint_severe_rate",
}
for _name in _TIMES:
    for _suffix, _ticks in (("", "ticks_all_baseline"), ("_own", f"ticks_{_name}")):
        _value = (
            "CAST(count(*) AS DOUBLE)"
            if _name == "orders"
            else "CAST(count(*) FILTER (s.hit) AS DOUBLE) / count(*)"
        )
        # A run is served by the cells of the 24 hours before it, also past the last event.
        PARTS[f"{_name}_buckets{_suffix}"] = f"""
            SELECT t.run_timestamp, {_BUCKET} AS bucket, {_value} AS value
            FROM {_ticks} t JOIN {_name}_seen s ON {within(24 * 60)}
            GROUP BY t.run_timestamp, bucket"""


def ticks_past_end(source: str) -> str:
    """Ticks up to a day past the last event: everything its baseline still reaches."""
    return f"""
        SELECT unnest(generate_series(lo + {QUARTER}, hi + INTERVAL 24 HOUR, {QUARTER})) AS run_timestamp
        FROM (SELECT time_bucket({QUARTER}, min(ts)) AS lo, time_bucket({QUARTER}, max(ts)) AS hi
              FROM ({source}))"""


PARTS["ticks_all_baseline"] = ticks_past_end(" UNION ALL ".join(_TIMES.values()))
for _name, _source in _TIMES.items():
    PARTS[f"{_name}_buckets_own"] = PARTS[f"{_name}_buckets_own"].replace(
        f"FROM ticks_{_name} t", f"FROM ticks_{_name}_baseline t"
    )
    PARTS[f"ticks_{_name}_baseline"] = ticks_past_end(_source)

PARTS["stats"] = " UNION ALL ".join(
    f"""SELECT run_timestamp, '{metric}' AS metric, avg(value) AS mean,
               coalesce(stddev_samp(value), 0) AS std
        FROM {name}_buckets GROUP BY run_timestamp"""
    for name, metric in METRIC_OF.items()
)
_CURRENT = {
    "payment_failure_rate": ("failure_rate", 1),
    "delivery_delay_rate": ("delay_rate", 2),
    "order_volume": ("orders", 3),
    "complaint_severe_rate": ("severe_rate", 4),
}
PARTS["current_values"] = " UNION ALL ".join(
    f"SELECT run_timestamp, '{metric}' AS metric, {place} AS place, CAST({column} AS DOUBLE) AS current FROM features"
    for metric, (column, place) in _CURRENT.items()
)
PARTS["scored"] = """
    SELECT run_timestamp, metric, place, current, mean, std,
           (current - mean) / nullif(std, 0) AS z
    FROM current_values JOIN stats USING (run_timestamp, metric)"""
PARTS["anomaly_list"] = """
    SELECT run_timestamp, metric, place, round(current, 4) AS current,
           round(mean, 4) AS baseline_mean, round(std, 4) AS baseline_std,
           round(z, 2) AS z_score, CASE WHEN z > 0 THEN 'spike' ELSE 'drop' END AS direction,
           round(least(abs(z) / 5.0, 1.0), 2) AS severity
    FROM scored WHERE abs(z) >= 2.5"""
PARTS["reports"] = """
    SELECT f.*, coalesce(a.anomaly_count, 0) AS anomaly_count,
           coalesce(a.max_severity, 0.0) AS max_severity, coalesce(a.metrics, '') AS metrics
    FROM features f LEFT JOIN (
      SELECT run_timestamp, count(*) AS anomaly_count, max(severity) AS max_severity,
             string_agg(metric, ',' ORDER BY place) AS metrics
      FROM anomaly_list GROUP BY run_timestamp
    ) a USING (run_timestamp)"""

# ------------------------------------------------------------------------ diagnosis

_ISSUES = (
    ("failure_rate > 0.20", "0.7", "payment", f"concat('payment failure rate ', {percent('failure_rate')})"),
    ("delay_rate > 0.25", "0.6", "delivery", f"concat('delivery delay rate ', {percent('delay_rate')})"),
    ("severe_rate > 0.30", "0.6", "complaints", f"concat('severe complaint rate ', {percent('severe_rate')})"),
    ("anomaly_count > 0", "max_severity", "anomaly", "concat(anomaly_count, ' statistical anomalies')"),
    ("orders = 0", "0.5", "volume", "'no orders in current window'"),
)
_worst = "greatest(0.0, " + ", ".join(f"CASE WHEN {t} THEN {s} ELSE 0.0 END" for t, s, _, _ in _ISSUES) + ")"
_any = " OR ".join(f"({t})" for t, _, _, _ in _ISSUES)
_summary = "concat_ws('; ', " + ", ".join(f"CASE WHEN {t} THEN {x} END" for t, _, _, x in _ISSUES) + ")"
_tags = "list_filter(['rule_based', " + ", ".join(
    f"CASE WHEN {t} THEN '{tag}' END" for t, _, tag, _ in _ISSUES
) + "], lambda x: x IS NOT NULL)"
_rule_texts = ", ".join(f"{text(v)} AS {k}" for k, v in _RULE_TEXTS.items())
PARTS["rules"] = f"""
    SELECT *, CASE WHEN NOT any_issue THEN 'healthy' WHEN severity >= 0.7 THEN 'critical'
                   ELSE 'degraded' END AS status,
           0.5::DOUBLE AS confidence,
           CASE WHEN any_issue THEN listed ELSE 'All metrics within normal range.' END AS issue_summary,
           {_rule_texts}, 'rule_based' AS llm_provider, 'n/a' AS llm_model,
           CAST(NULL AS INTEGER) AS llm_latency_ms
    FROM (SELECT *, {_any} AS any_issue, round(CAST({_worst} AS DOUBLE), 2) AS severity,
                 {_summary} AS listed, {_tags} AS tags FROM reports)"""
PARTS["gated"] = """
    SELECT *, status <> 'healthy'
              AND (severity >= 0.7 OR anomaly_count >= 2 OR max_severity >= 0.8) AS escalate
    FROM rules"""

PARTS["event_runs"] = "SELECT event_id AS n, ts AS run_timestamp FROM events"
PARTS["tick_runs"] = f"""
    SELECT CAST(epoch(run_timestamp) AS BIGINT) // 900 AS n, run_timestamp
    FROM (SELECT DISTINCT time_bucket({QUARTER}, ts) + {QUARTER} AS run_timestamp FROM events)"""
_keys = ("status", "severity", "confidence", "issue_summary", "root_cause", "business_impact",
         "suggested_fix", "investigation_sql", "tags")
_missing = "list_sort(list_filter([" + ", ".join(
    f"CASE WHEN json_type(response, '$.{k}') IS NULL THEN '{k}' END" for k in _keys
) + "], lambda k: k IS NOT NULL))"


def _number_checks(name: str) -> str:
    kind = f"json_type(response, '$.{name}')"
    value = f"TRY_CAST(json_extract_string(response, '$.{name}') AS DOUBLE)"
    return (
        f"WHEN {kind} NOT IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE') THEN '{name} is not a number' "
        f"WHEN {value} < 0 OR {value} > 1 THEN '{name} out of range' "
    )


def answer_parts(prefix: str, runs: str) -> dict[str, str]:
    return {
        f"{prefix}_answers": MODEL_ANSWERS.replace("{runs}", runs),
        f"{prefix}_checked": f"""
            SELECT *, CASE
                     WHEN NOT json_valid(response) THEN 'invalid JSON'
                     WHEN json_type(response) <> 'OBJECT' THEN 'not an object'
                     WHEN len({_missing}) > 0
                          THEN concat('missing keys: ', array_to_string({_missing}, ', '))
                     {_number_checks('severity')} {_number_checks('confidence')}
                     WHEN json_extract_string(response, '$.status')
                          NOT IN ('healthy', 'degraded', 'critical') THEN 'invalid status'
                     WHEN json_type(response, '$.tags') <> 'ARRAY' THEN 'tags is not a list'
                   END AS reason
            FROM {prefix}_answers""",
        f"{prefix}_valid": f"""
            SELECT *, json_extract_string(response, '$.status') AS a_status,
                   CAST(json_extract_string(response, '$.severity') AS DOUBLE) AS a_severity,
                   CAST(json_extract_string(response, '$.confidence') AS DOUBLE) AS a_confidence,
                   {', '.join(f"json_extract_string(response, '$.{k}') AS a_{k}" for k in _keys[3:-1])},
                   json_extract_string(response, '$.tags[*]') AS a_tags
            FROM {prefix}_checked WHERE reason IS NULL""",
    }


PARTS.update(answer_parts("event", "event_runs"))
PARTS.update(answer_parts("tick", "tick_runs"))
PARTS["first_answers"] = """
    SELECT * FROM tick_valid QUALIFY row_number() OVER (PARTITION BY run_timestamp ORDER BY attempt) = 1"""


def _chosen(name: str, answer: str) -> str:
    return f"CASE WHEN g.escalate AND a.run_timestamp IS NOT NULL THEN {answer} ELSE g.{name} END AS {name}"


PARTS["selected"] = f"""
    SELECT g.run_timestamp, {', '.join(_chosen(k, f'a.a_{k}') for k in _keys)},
           {_chosen('llm_provider', 'a.provider')}, {_chosen('llm_model', 'a.model')},
           {_chosen('llm_latency_ms', 'a.latency_ms')},
           CASE WHEN g.escalate AND a.run_timestamp IS NOT NULL THEN 'llm'
                WHEN g.escalate THEN 'fallback' ELSE 'rule_based_cost_saved' END AS source,
           g.orders, g.avg_delay_minutes, g.top_failure_reasons, g.anomaly_count, g.metrics
    FROM gated g LEFT JOIN first_answers a USING (run_timestamp)"""

# ------------------------------------------------------------------------ decisions


def decision_parts(prefix: str, selected: str) -> dict[str, str]:
    return {
        f"{prefix}flagged": f"""
            SELECT *, left(sha1(concat(status, '|', array_to_string(list_sort(tags), ','))), 12)
                          AS alert_fingerprint,
                   status IN ('degraded', 'critical') AND severity >= 0.5 AND confidence >= 0.4
                          AS candidate
            FROM {selected}""",
        f"{prefix}sent": f"""
            SELECT alert_fingerprint, min(run_timestamp) AS sent_at FROM {prefix}flagged
            WHERE candidate GROUP BY alert_fingerprint
            UNION ALL
            SELECT s.alert_fingerprint, min(f.run_timestamp)
            FROM {prefix}sent s JOIN {prefix}flagged f
              ON f.candidate AND f.alert_fingerprint = s.alert_fingerprint
                 AND f.run_timestamp > s.sent_at + INTERVAL 30 MINUTE
            GROUP BY s.alert_fingerprint""",
        f"{prefix}decided": f"""
            SELECT f.*, f.candidate AND s.sent_at IS NOT NULL AS should_alert,
                   CASE WHEN f.candidate AND s.sent_at IS NULL THEN 'duplicate_within_window' END
                        AS suppression_reason,
                   CASE WHEN status = 'critical' AND severity >= 0.85 THEN 'telegram+pager'
                        ELSE 'telegram' END AS routing,
                   CASE WHEN f.candidate THEN s.sent_at END AS alerted_at
            FROM {prefix}flagged f LEFT JOIN {prefix}sent s
              ON f.alert_fingerprint = s.alert_fingerprint AND f.run_timestamp = s.sent_at""",
    }


PARTS.update(decision_parts("", "selected"))
# The stream sees no model answers, so every escalated run falls back to the rules.
PARTS["rule_selected"] = """
    SELECT *, CASE WHEN escalate THEN 'fallback' ELSE 'rule_based_cost_saved' END AS source
    FROM gated"""
PARTS.update(decision_parts("rule_", "rule_selected"))

PARTS["audit"] = """
    SELECT CAST(epoch(run_timestamp) AS BIGINT) AS diagnosis_id, *, run_timestamp AS created_at
    FROM decided"""
PARTS["stg_ai_diagnosis"] = f"""
    SELECT diagnosis_id, run_timestamp, CAST(run_timestamp AS DATE) AS run_date,
           hour(run_timestamp) AS run_hour, {cleaned('status')} AS status,
           coalesce(severity, 0) AS severity, coalesce(confidence, 0) AS confidence,
           issue_summary, root_cause, business_impact, suggested_fix,
           {cleaned('source')} AS diagnosis_source, coalesce(llm_provider, 'n/a') AS llm_provider,
           coalesce(llm_model, 'n/a') AS llm_model, coalesce(llm_latency_ms, 0) AS llm_latency_ms,
           alert_fingerprint, alerted_at, alerted_at IS NOT NULL AS was_alerted,
           {flag('status', 'healthy')} AS is_healthy, {flag('status', 'degraded')} AS is_degraded,
           {flag('status', 'critical')} AS is_critical, {flag('source', 'llm')} AS is_llm_diagnosis
    FROM audit WHERE diagnosis_id IS NOT NULL"""


def _count(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


PARTS["mart_ai_diagnosis_summary"] = f"""
    SELECT run_date, count(*) AS total_diagnoses, {_count('is_healthy')} AS healthy_count,
           {_count('is_degraded')} AS degraded_count, {_count('is_critical')} AS critical_count,
           {_count('was_alerted')} AS alerts_sent, {_count('is_llm_diagnosis')} AS llm_diagnoses,
           {_count('NOT is_llm_diagnosis')} AS fallback_diagnoses,
           {share(_count('is_healthy'), 'count(*)')} AS healthy_rate,
           {share(_count('is_critical'), 'count(*)')} AS critical_rate,
           {share(_count('was_alerted'), 'count(*)')} AS alert_rate,
           {share(_count('is_llm_diagnosis'), 'count(*)')} AS llm_usage_rate,
           {half_up('sum(CAST(round(severity * 100) AS BIGINT))', '(100 * count(*))', 3)} AS avg_severity,
           {half_up('sum(CAST(round(confidence * 100) AS BIGINT))', '(100 * count(*))', 3)} AS avg_confidence,
           {half_up(f"({_count('is_healthy')} * 100 + {_count('is_degraded')} * 50)", 'count(*)', 1)}
               AS pipeline_health_score
    FROM stg_ai_diagnosis GROUP BY run_date"""
PARTS["bh_ai"] = """
    SELECT run_date AS dt, pipeline_health_score, alerts_sent, llm_usage_rate, avg_severity,
           avg_confidence
    FROM mart_ai_diagnosis_summary"""
PARTS["label_answers"] = LABEL_ANSWERS
PARTS["complaint_answers"] = COMPLAINT_ANSWERS.replace("{complaints}", "b_complaint_events")

# ------------------------------------------------------------------------ messages

_MESSAGE_KEYS = {
    "orders": ("b_raw_orders", "order_id"),
    "payments": ("b_raw_payments", "payment_id"),
    "deliveries": ("b_raw_deliveries", "delivery_id"),
    "refunds": ("b_raw_refunds", "refund_id"),
    "complaints": ("b_complaint_events", "complaint_id"),
}
_EVENT_TIME = {"orders": "order_ts", "payments": "payment_ts", "refunds": "refund_ts",
               "complaints": "complaint_ts"}
_number = "CAST(regexp_extract({key}, '([0-9]+)$', 1) AS BIGINT)"
_sent = []
for _topic, (_view, _key) in _MESSAGE_KEYS.items():
    _ts = _EVENT_TIME.get(_topic, "CAST(NULL AS TIMESTAMP)")
    _base = f"SELECT {_number.format(key=_key)} AS num, {_key} AS k, {_ts} AS event_ts, created_at FROM {_view}"
    _sent.append(
        f"""SELECT '{_topic}_topic' AS topic, k AS event_key, num * 8 + shift AS "offset", shift,
                   event_ts, created_at + INTERVAL 1 MINUTE * least(shift, 1) AS received_at
            FROM ({_base}) CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4, 5]) AS shift)
            WHERE shift = 0 OR (shift = 1 AND num % 10 = 0) OR (shift = 2 AND num % 97 = 0)
               OR (shift = 3 AND num % 89 = 0) OR (shift = 4 AND num % 83 = 0) OR (shift = 5 AND num % 79 = 0)"""
    )
PARTS["messages"] = " UNION ALL ".join(_sent)


def assemble(final: str) -> str:
    """The final query preceded by the parts it needs, in dependency order."""
    order: list[str] = []
    seen: set[str] = set()

    def need(sql: str) -> None:
        for name in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql):
            if name in PARTS and name not in seen:
                seen.add(name)
                need(PARTS[name])
                order.append(name)

    need(final)
    if not order:
        return final
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in order)
    return f"WITH RECURSIVE {parts}\n{final}"


