"""The SQL each registered query is checked against."""

from __future__ import annotations

from registry.sql_parts import LABEL_FIELDS, METRIC_OF, assemble, half_up, keyword_case, share, text

_RAW = ("orders", "payments", "deliveries", "complaints", "refunds")
_KEY_OF = {
    "orders": "order_id", "payments": "payment_id", "deliveries": "delivery_id",
    "complaints": "complaint_id", "refunds": "refund_id",
}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str) -> None:
    ORACLES[name] = assemble(sql)


# ------------------------------------------------------------------------ ingest

# Fields of the events in the order they are sent; the key comes first.
_SENT = {
    "orders": "order_id:text customer_id:text city:text order_ts:time order_amount:number order_status:text",
    "payments": "payment_id:text order_id:text payment_ts:time payment_method:text payment_status:text "
                "amount:number failure_reason:text",
    "deliveries": "delivery_id:text order_id:text city:text delivery_partner:text promised_minutes:number "
                  "actual_minutes:number delivery_status:text",
    "refunds": "refund_id:text order_id:text refund_ts:time refund_amount:number refund_reason:text",
    "complaints": "complaint_id:text order_id:text complaint_ts:time complaint_text:text",
}
_LACKING = {
    "orders": "city", "payments": "payment_status", "deliveries": "delivery_partner",
    "refunds": "refund_reason", "complaints": "complaint_text",
}


def _wire(topic: str, lacking: str | None = None) -> str:
    """The JSON text of a message whose key has been made a new one."""
    parts = []
    for field, kind in (entry.split(":") for entry in _SENT[topic].split()):
        if field == lacking:
            continue
        value = {
            "text": f"'\"' || r.{field} || '\"'",
            "number": f"CAST(r.{field} AS VARCHAR)",
            "time": f"'\"' || strftime(r.{field}, '%Y-%m-%dT%H:%M:%S.%f+00:00') || '\"'",
        }[kind]
        if field == _KEY_OF[topic]:
            value = f"'\"BAD-' || r.{field} || '\"'"
        parts.append(f"'\"{field}\":' || coalesce({value}, 'null')")
    return "('{' || " + " || ',' || ".join(parts) + " || '}')"


_problem = (
    "CASE WHEN shift IN (2, 4, 5) THEN 'malformed JSON' WHEN shift = 3 THEN concat('missing ', CASE topic "
    + " ".join(f"WHEN '{t}_topic' THEN '{field}'" for t, field in _LACKING.items())
    + " END) END"
)
_logged = " UNION ALL ".join(
    f"""SELECT concat('{t}_topic: ', {_problem}, ': ',
                      CASE shift WHEN 2 THEN left({_wire(t)}, 40) WHEN 3 THEN {_wire(t, _LACKING[t])}
                                 WHEN 4 THEN {_wire(t)} || ' as sent' ELSE {_wire(t)} || {_wire(t)} END) AS message,
               m.received_at
        FROM messages m JOIN b_{'complaint_events' if t == 'complaints' else 'raw_' + t} r
             ON r.{_KEY_OF[t]} = m.event_key AND m.topic = '{t}_topic'
        WHERE m.shift >= 2"""
    for t in _RAW
)
_seen_key = "CASE WHEN shift = 2 THEN NULL WHEN shift > 2 THEN concat('BAD-', event_key) ELSE event_key END"
check(
    "decode_messages",
    f"""SELECT topic, "offset", {_seen_key} AS event_key, {_problem} AS problem FROM messages""",
)
check(
    "ingest_route",
    " UNION ALL ".join(
        f"""SELECT 'raw_{t}' AS table_name, 'loadable' AS outcome, count(*) AS n
            FROM messages WHERE topic = '{t}_topic' AND shift < 2
            UNION ALL SELECT 'raw_{t}', 'quarantined', count(*)
            FROM messages WHERE topic = '{t}_topic' AND shift >= 2"""
        for t in _RAW
    ),
)
check(
    "parse_event_ts",
    """SELECT topic, "offset", CASE WHEN shift = 2 THEN NULL ELSE event_ts END AS event_ts
       FROM messages WHERE topic <> 'deliveries_topic'""",
)
check("ingest_orders", "SELECT * REPLACE (CAST(order_amount AS DOUBLE) AS order_amount) FROM b_raw_orders")
check("ingest_payments", "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM b_raw_payments")
check("ingest_deliveries", "SELECT * FROM b_raw_deliveries")
check("ingest_refunds", "SELECT * REPLACE (CAST(refund_amount AS DOUBLE) AS refund_amount) FROM b_raw_refunds")
check("ingest_complaints", "SELECT * FROM b_raw_complaints")
check(
    "dedup_first_write",
    " UNION ALL ".join(
        f"""SELECT 'raw_{t}' AS table_name, {_KEY_OF[t]} AS event_key,
                   {'customer_id' if t == 'orders' else 'order_id'} AS other_id, created_at
            FROM b_{'complaint_events' if t == 'complaints' else 'raw_' + t}
            WHERE CAST(substr({_KEY_OF[t]}, 5) AS BIGINT) % 3 <> 0"""
        for t in _RAW
    ),
)
check(
    "quarantine",
    f"""SELECT 'ingest' AS component, 'error' AS status, message, received_at AS created_at FROM ({_logged})""",
)

# ------------------------------------------------------------------------ staging and marts

check("stg_orders", "SELECT * REPLACE (CAST(order_amount AS DOUBLE) AS order_amount) FROM a_stg_orders")
check("stg_payments", "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM a_stg_payments")
check("stg_deliveries", "SELECT * FROM a_stg_deliveries")
check("stg_complaints", "SELECT * FROM a_stg_complaints")
check("stg_refunds", "SELECT * REPLACE (CAST(refund_amount AS DOUBLE) AS refund_amount) FROM a_stg_refunds")
check("stg_ai_diagnosis", "SELECT * FROM stg_ai_diagnosis")
for _name in (
    "mart_order_summary", "mart_payment_health", "mart_delivery_performance",
    "mart_complaint_insights", "bh_orders", "bh_payments", "bh_deliveries", "bh_complaints",
):
    check(_name, f"SELECT * FROM a_{_name}")
check("mart_ai_diagnosis_summary", "SELECT * FROM mart_ai_diagnosis_summary")
check("bh_ai", "SELECT * FROM bh_ai")
check("mart_business_health_daily", "SELECT * FROM b_business_health")
check("mart_business_health_history", "SELECT * FROM a_business_health")
check("stored_marts", "SELECT * FROM b_business_health")
check("incremental_order_summary", "SELECT * FROM b_mart_order_summary")
check("incremental_delivery_performance", "SELECT * FROM b_mart_delivery_performance")
check(
    "customers_of_span",
    """SELECT city, count(DISTINCT customer_id) AS customers, TRUE AS within FROM b_stg_orders
       WHERE order_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY city""",
)

# ------------------------------------------------------------------------ features

check("feat_orders", "SELECT run_timestamp, n AS orders FROM orders_now_own")
check(
    "feat_revenue",
    "SELECT run_timestamp, CAST(coalesce(extra, 0) AS DOUBLE) AS revenue FROM orders_now_own",
)
check(
    "feat_payments",
    f"""SELECT run_timestamp, n AS payments, hits AS failed, oks AS success,
               coalesce({share('hits', 'n')}, 0) AS failure_rate FROM payments_now_own""",
)
check(
    "feat_deliveries",
    f"""SELECT run_timestamp, n AS deliveries, hits AS delayed,
               coalesce({share('hits', 'n')}, 0) AS delay_rate,
               coalesce({half_up('extra', 'n', 1)}, 0) AS avg_delay_minutes
        FROM deliveries_now_own""",
)
check(
    "feat_complaints",
    f"""SELECT run_timestamp, n AS complaints, hits AS severe,
               coalesce({share('hits', 'n')}, 0) AS severe_rate FROM complaints_now_own""",
)
for _name, _domain, _column in (
    ("feat_top_cities", "orders", "top_order_cities"),
    ("feat_top_failure_reasons", "payments", "top_failure_reasons"),
    ("feat_top_delayed_cities", "deliveries", "top_delayed_cities"),
    ("feat_top_categories", "complaints", "top_categories"),
):
    check(
        _name,
        f"""SELECT run_timestamp, coalesce(top, '') AS {_column}
            FROM ticks_{_domain} LEFT JOIN {_domain}_top USING (run_timestamp)""",
    )
check("features_history", "SELECT * FROM features")
check("features_now", "SELECT * FROM features WHERE run_timestamp = TIMESTAMP '2024-01-15 12:00:00'")
check(
    "probe_recent_orders",
    """SELECT t.run_timestamp, count(s.ts) AS orders_count, count(s.ts) < 1 AS low_volume
       FROM ticks_orders t LEFT JOIN orders_seen s
         ON s.ts >= t.run_timestamp - INTERVAL 15 MINUTE AND s.ts < t.run_timestamp
       GROUP BY t.run_timestamp""",
)
_last_hour = "s.ts >= t.run_timestamp - INTERVAL 1 HOUR AND s.ts < t.run_timestamp"
check(
    "probe_payment_failure",
    f"""SELECT *, failure_rate > 0.30 AS breach FROM (
          SELECT t.run_timestamp, count(s.ts) AS total_payments,
                 coalesce(CAST(count(*) FILTER (s.hit) AS DOUBLE) / nullif(count(s.ts), 0), 0)
                     AS failure_rate
          FROM ticks_payments t LEFT JOIN payments_seen s ON {_last_hour}
          GROUP BY t.run_timestamp)""",
)
check(
    "investigate_failures",
    """SELECT t.run_timestamp, s.label AS failure_reason, count(*) AS failures
       FROM ticks_payments_baseline t JOIN payments_seen s
         ON s.ts >= t.run_timestamp - INTERVAL 1 HOUR AND s.ts < t.run_timestamp
       WHERE s.hit GROUP BY t.run_timestamp, s.label""",
)
check(
    "failed_payments_last_hour",
    """SELECT t.run_timestamp, p.payment_id, p.payment_method, CAST(p.amount AS DOUBLE) AS amount,
              p.failure_reason
       FROM ticks_payments_baseline t JOIN b_raw_payments p
         ON p.payment_ts >= t.run_timestamp - INTERVAL 1 HOUR AND p.payment_ts < t.run_timestamp
       WHERE p.payment_status = 'failed'""",
)

# ------------------------------------------------------------------------ anomalies

check(
    "bucket_30min",
    " UNION ALL ".join(
        f"SELECT {key} AS key, time_bucket(INTERVAL 30 MINUTE, {time}) AS bucket FROM {table}"
        for table, key, time in (
            ("b_raw_orders", "order_id", "order_ts"), ("b_raw_payments", "payment_id", "payment_ts"),
            ("b_raw_deliveries", "delivery_id", "created_at"), ("b_complaint_events", "complaint_id", "complaint_ts"),
        )
    ),
)
for _name, _domain in (
    ("baseline_payment_failure", "payments"),
    ("baseline_delivery_delay", "deliveries"),
    ("baseline_order_volume", "orders"),
    ("baseline_complaint_severe", "complaints"),
):
    check(_name, f"SELECT run_timestamp, bucket, round(value, 9) AS value FROM {_domain}_buckets_own")
check(
    "baseline_stats",
    "SELECT run_timestamp, metric, round(mean, 6) AS mean, round(std, 6) AS std FROM stats",
)
check("anomaly_rows", "SELECT * EXCLUDE (place) FROM anomaly_list")
check("anomaly_summary", "SELECT run_timestamp, anomaly_count, max_severity, metrics FROM reports")

# ------------------------------------------------------------------------ complaints

check(
    "classify_complaint_rules",
    f"SELECT complaint_id, {', '.join(LABEL_FIELDS)} FROM a_raw_complaints",
)


# JSON key of each label, and what an absent key means.
_MODEL_KEYS = {
    "ai_category": ("category", "other"), "ai_severity": ("severity", "medium"),
    "customer_emotion": ("customer_emotion", "unknown"), "business_impact": ("business_impact", "operational_risk"),
    "recommended_action": ("recommended_action", "Review complaint manually."),
}


def _model_label(field: str) -> str:
    key, default = _MODEL_KEYS[field]
    return f"""CASE WHEN NOT coalesce(usable, FALSE) THEN {keyword_case(field)}
                    WHEN json_type(answer, '$.{key}') IS NULL THEN {text(default)}
                    ELSE json_extract_string(answer, '$.{key}') END AS {field}"""


check(
    "normalize_complaint_labels",
    f"""SELECT complaint_id, {', '.join(_model_label(f) for f in LABEL_FIELDS)}
        FROM (SELECT *, json_type(answer) = 'OBJECT' AS usable
              FROM (SELECT *, CASE WHEN json_valid(response) THEN response END AS answer
                    FROM label_answers))""",
)

check(
    "complaint_prompt",
    """SELECT complaint_id, 'openai' AS provider, 'gpt-4o-mini' AS model, complaint_text, TRUE AS names_severities
       FROM a_complaint_events WHERE complaint_text IS NOT NULL""",
)
check(
    "ingest_complaints_model",
    f"""SELECT complaint_id, order_id, complaint_ts, complaint_text, {', '.join(_model_label(f) for f in LABEL_FIELDS)}, created_at
        FROM (SELECT e.*, answer, answer IS NOT NULL AS usable
              FROM b_complaint_events e LEFT JOIN (
                SELECT complaint_id, arg_min(response, attempt) AS answer FROM complaint_answers
                WHERE response IS NOT NULL AND json_valid(response) GROUP BY complaint_id) USING (complaint_id))""",
)

# ------------------------------------------------------------------------ diagnosis

_FALLBACK_TEXTS = {  # fixed values
    "root_cause": "AI module failed — manual investigation needed",
    "business_impact": "Unknown without AI diagnosis",
    "suggested_fix": "Check AI service logs and Postgres",
    "investigation_sql": "SELECT * FROM raw_payments WHERE payment_status='failed' AND payment_ts >= NOW() - INTERVAL '1 hour';",
}
_DIAGNOSIS = (
    "run_timestamp, status, severity, confidence, issue_summary, root_cause, business_impact, "
    "suggested_fix, investigation_sql, array_to_string(tags, ',') AS tags, llm_provider, llm_model, "
    "llm_latency_ms"
)
check("rule_diagnosis", f"SELECT {_DIAGNOSIS} FROM rules")
check("llm_gate", "SELECT run_timestamp, status, escalate FROM gated")
check("diagnosis_select", f"SELECT {_DIAGNOSIS}, source FROM selected")
_full_row = lambda value: f"CASE WHEN NOT lost THEN {value} END"
check(
    "dag_fallback_rows",
    f"""SELECT run_timestamp, CASE WHEN lost THEN 'warning' ELSE 'degraded' END AS status,
               {_full_row('0.5::DOUBLE')} AS severity, {_full_row('0.3::DOUBLE')} AS confidence,
               concat(CASE WHEN lost THEN 'Total fallback. ' ELSE 'AI unavailable. ' END,
                      'orders=', orders_count, ', failure_rate=', failure_rate) AS issue_summary,
               {', '.join(f"{_full_row(text(v))} AS {k}" for k, v in _FALLBACK_TEXTS.items())},
               {_full_row("'dag_fallback'")} AS tags, {_full_row("'{}'")} AS features_json,
               {_full_row("'{}'")} AS anomalies_json,
               CASE WHEN lost THEN 'dag_emergency_fallback' ELSE 'dag_fallback' END AS source,
               {_full_row("'fallback'")} AS llm_provider, {_full_row("'n/a'")} AS llm_model,
               CAST(NULL AS INTEGER) AS llm_latency_ms,
               {_full_row("'dag_fallback'")} AS alert_fingerprint,
               CAST(NULL AS TIMESTAMP) AS alerted_at
        FROM (
          SELECT o.*, p.failure_rate, (CAST(epoch(run_timestamp) AS BIGINT) // 900) % 3 = 0 AS lost
          FROM (SELECT t.run_timestamp, count(s.ts) AS orders_count
                FROM ticks_orders t LEFT JOIN orders_seen s
                  ON s.ts >= t.run_timestamp - INTERVAL 15 MINUTE AND s.ts < t.run_timestamp
                GROUP BY t.run_timestamp) o
          JOIN (SELECT t.run_timestamp, coalesce({share('count(*) FILTER (s.hit)', 'count(s.ts)')}, 0.0)
                           AS failure_rate
                FROM ticks_payments t LEFT JOIN payments_seen s ON {_last_hour}
                GROUP BY t.run_timestamp) p USING (run_timestamp))""",
)
check(
    "llm_prompt",
    """SELECT run_timestamp, 'openai' AS provider, 'gpt-4o-mini' AS model,
              CAST(30 AS DOUBLE) AS window_minutes, CAST(orders AS DOUBLE) AS orders,
              revenue, failure_rate, delay_rate, severe_rate,
              CAST(anomaly_count AS DOUBLE) AS anomaly_count, max_severity
       FROM gated WHERE escalate""",
)
check(
    "validate_llm_response",
    """SELECT c.n, c.attempt, c.reason, v.a_status AS status, v.a_severity AS severity,
              v.a_confidence AS confidence, v.a_issue_summary AS issue_summary,
              array_to_string(v.a_tags, ',') AS tags
       FROM event_checked c LEFT JOIN event_valid v USING (n, attempt)""",
)
check(
    "llm_answer_meta",
    """SELECT run_timestamp, attempt, provider AS llm_provider, model AS llm_model,
              latency_ms AS llm_latency_ms FROM first_answers""",
)

# ------------------------------------------------------------------------ decisions

check("alert_fingerprint", "SELECT run_timestamp, status, alert_fingerprint FROM flagged")
check("alert_candidates", "SELECT run_timestamp, candidate FROM flagged")
check(
    "alert_suppress",
    """SELECT run_timestamp, alert_fingerprint, candidate, should_alert, suppression_reason
       FROM decided""",
)
check(
    "recently_alerted",
    """SELECT run_timestamp, alert_fingerprint FROM decided d WHERE candidate AND EXISTS (
         SELECT 1 FROM decided h
         WHERE h.should_alert AND h.alert_fingerprint = d.alert_fingerprint
           AND h.run_timestamp < d.run_timestamp
           AND h.run_timestamp >= d.run_timestamp - INTERVAL 30 MINUTE)""",
)
check("alert_routing", "SELECT run_timestamp, status, severity, routing FROM decided")
_icon = "CASE status WHEN 'healthy' THEN '🟢' WHEN 'degraded' THEN '🟡' WHEN 'critical' THEN '🔴' ELSE '⚪' END"
check(
    "alert_message",
    f"""SELECT run_timestamp, concat(
          {_icon}, ' *Pipeline ', upper(status), '*', chr(10),
          '*Severity:* ', CAST(trunc(severity * 100) AS BIGINT), '% | *Confidence:* ',
          CAST(trunc(confidence * 100) AS BIGINT), '%', chr(10), chr(10),
          '*Issue:* ', issue_summary, chr(10), '*Root Cause:* ', root_cause, chr(10),
          '*Business Impact:* ', business_impact, chr(10), '*Suggested Fix:* ', suggested_fix,
          chr(10), chr(10), '*Investigation SQL:*', chr(10), '```', chr(10), investigation_sql,
          chr(10), '```', chr(10), '_Source: ', llm_provider, ' | fingerprint: ',
          alert_fingerprint, '_') AS message
        FROM decided WHERE should_alert""",
)
check(
    "diagnosis_record",
    f"""SELECT diagnosis_id, {_DIAGNOSIS}, source, alert_fingerprint, alerted_at, created_at,
               CAST(orders AS DOUBLE) AS json_orders, avg_delay_minutes AS json_avg_delay,
               nullif(split_part(top_failure_reasons, ':', 1), '') AS json_top_reason,
               CAST(anomaly_count AS DOUBLE) AS json_anomaly_count,
               nullif(split_part(metrics, ',', 1), '') AS json_first_metric
        FROM audit""",
)

# ------------------------------------------------------------------------ sinks

_COLUMNS = {
    "raw_orders": "order_id customer_id city order_ts order_amount order_status created_at",
    "raw_payments": "payment_id order_id payment_ts payment_method payment_status amount failure_reason created_at",
    "raw_deliveries": "delivery_id order_id city delivery_partner promised_minutes actual_minutes delivery_status created_at",
    "raw_refunds": "refund_id order_id refund_ts refund_amount refund_reason created_at",
    "raw_complaints": "complaint_id order_id complaint_ts complaint_text " + " ".join(LABEL_FIELDS) + " created_at",
    "ai_pipeline_diagnosis": "diagnosis_id run_timestamp status severity confidence issue_summary root_cause "
    "business_impact suggested_fix investigation_sql tags features_json anomalies_json source llm_provider llm_model "
    "llm_latency_ms alert_fingerprint alerted_at created_at",
}


def _movement(family: str) -> dict[str, str]:
    return {name: "audit" if name == "ai_pipeline_diagnosis" else f"{family}_{name}" for name in _COLUMNS}


def _text_of(column: str, family: str) -> str:
    """A value as the text whose hash is summed up."""
    if column.endswith("_ts") or column in ("created_at", "run_timestamp", "alerted_at"):
        return f"strftime(CAST({column} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"
    if column in ("severity", "confidence", "refund_amount") or (column in ("order_amount", "amount") and family == "b"):
        return f"CAST(CAST({column} AS DECIMAL(38,10)) AS VARCHAR)"
    if column == "tags":
        return "CAST(to_json(tags) AS VARCHAR)"
    return f"CAST({column} AS VARCHAR)"


def _digest(text: str) -> str:
    return f"CAST(sum(CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT)::HUGEINT) AS VARCHAR)"


def _content_of(name: str, source: str, columns: str, family: str, upper: bool) -> str:
    rows, texts = [], []
    for k in sorted(columns.split()):
        shown = k.upper() if upper else k
        if k.endswith("_json") or k == "log_id":
            rows.append(f"SELECT '{name}', '{shown}', count(*), NULL FROM {source}")
            continue
        value = _text_of(k, family)
        texts.append(f"coalesce({value}, '\\N')")
        rows.append(f"SELECT '{name}', '{shown}', count({k}), {_digest(f"'{k}=' || {value}")} FROM {source}")
    rows.append(f"SELECT '{name}', '*', count(*), {_digest(f'concat_ws(chr(31), {', '.join(texts)})')} FROM {source}")
    return " UNION ALL ".join(rows)


def _content(family: str, upper: bool, *more: str) -> str:
    rows = [_content_of(name, source, _COLUMNS[name], family, upper) for name, source in _movement(family).items()]
    return "SELECT * FROM (" + " UNION ALL ".join([*rows, *more]) + ") AS p(table_name, column_name, n_values, digest)"


check(
    "export_csv",
    _content("b", False, _content_of(
        "pipeline_logs",
        f"(SELECT 0 AS log_id, 'ingest' AS component, 'error' AS status, message, received_at AS created_at FROM ({_logged}))",
        "log_id component status message created_at", "b", False)),
)
check(
    "backup_parquet",
    " UNION ALL ".join(
        f"SELECT 2024 AS year, 2 AS month, 1 AS day, count(*) AS n, '{name}' AS table_name FROM {source}"
        for name, source in _movement("b").items()
    ),
)
check(
    "scan_backup_day",
    "SELECT order_id, customer_id, order_ts, CAST(order_amount AS DOUBLE) AS order_amount FROM b_raw_orders",
)
check(
    "scan_backup_weekdays",
    """SELECT order_id, customer_id, order_ts, CAST(order_amount AS DOUBLE) AS order_amount FROM b_raw_orders
       WHERE dayofweek(order_ts) = 1""",
)
check("warehouse_refresh", _content("a", True))
check("clean_for_load", _content("b", True))
check(
    "cleaned_orders",
    """SELECT order_id AS "ORDER_ID", customer_id AS "CUSTOMER_ID", city AS "CITY",
              strftime(order_ts, '%Y-%m-%d %H:%M:%S.%f') AS "ORDER_TS", CAST(order_amount AS DOUBLE) AS "ORDER_AMOUNT",
              order_status AS "ORDER_STATUS", strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS "CREATED_AT" FROM b_raw_orders""",
)
_WRONG = {
    "swapped": "(SELECT * REPLACE (payment_status AS payment_method, payment_method AS payment_status) FROM b_raw_payments)",
    "rounded": "(SELECT * REPLACE (CASE WHEN payment_id LIKE '%7' THEN round(amount, 0) ELSE amount END AS amount) FROM b_raw_payments)",
    "shifted": "(SELECT * REPLACE (CASE WHEN payment_id LIKE '%7' THEN date_trunc('second', payment_ts) ELSE payment_ts END AS payment_ts) "
               "FROM b_raw_payments)",
    "traded": "(SELECT * FROM b_raw_payments WHERE payment_id <> (SELECT max(payment_id) FROM b_raw_payments) UNION ALL "
              "SELECT * FROM b_raw_payments WHERE payment_id = (SELECT min(payment_id) FROM b_raw_payments))",
}
_loaded_right = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{k}' AS column_name, {n} AS n_source, {n} AS n_loaded, TRUE AS ok FROM {source}"
    for name, source in _movement("a").items()
    for k, n in [("*", "count(*)"), *((k, "count(*)" if k.endswith("_json") else f"count({k})") for k in _COLUMNS[name].split())]
)
_loaded_wrong = " UNION ALL ".join(
    f"""SELECT t.table_name, t.column_name, s.n_values, t.n_values, s.digest IS NOT DISTINCT FROM t.digest
        FROM ({_content_of(name, source, _COLUMNS['raw_payments'], 'b', False)}) AS t(table_name, column_name, n_values, digest)
        JOIN ({_content_of(name, 'b_raw_payments', _COLUMNS['raw_payments'], 'b', False)}) AS s(table_name, column_name, n_values, digest)
        USING (column_name)"""
    for name, source in _WRONG.items()
)
check("verify_content", f"{_loaded_right} UNION ALL {_loaded_wrong}")
check(
    "verify_counts",
    " UNION ALL ".join(
        f"SELECT '{label}{name}' AS table_name, count(*) AS rows, count(*) > 0 AS ok FROM {source}"
        for family, label in (("a", ""), ("b", "b_"), ("a", "loaded_"))
        for name, source in _movement(family).items()
        if label != "b_" or source != "audit"
    ),
)
_summary_rows = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows, 'success' AS status, TRUE AS has_size FROM {source}"
    for name, source in _movement("a").items()
)
check(
    "load_summary",
    f"""{_summary_rows} UNION ALL
        SELECT 'all', CAST(sum(rows) AS BIGINT), '6 0 0', TRUE FROM ({_summary_rows})""",
)
check(
    "evolve_unreadable",
    """SELECT * FROM (
         SELECT 'raw_orders' AS table_name, 'order_amount' AS column_name, count(*) FILTER (order_amount = 'n/a') AS rows
         FROM a_raw_orders
         UNION ALL SELECT 'raw_payments', 'amount', count(*) FILTER (amount = 'n/a') FROM a_raw_payments)
       WHERE rows > 0""",
)
check(
    "evolve_schema",
    """SELECT payment_id, order_id, payment_ts, payment_method, payment_status,
              CAST(TRY_CAST(amount AS DECIMAL(32,10)) AS DOUBLE) AS amount,
              CAST(NULL AS VARCHAR) AS failure_reason, CAST(NULL AS TIMESTAMP) AS created_at
       FROM a_raw_payments""",
)

# ------------------------------------------------------------------------ quality


def _unique(source: str, column: str) -> str:
    return (
        f"(SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1))"
    )


def _outside(source: str, column: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(text(v) for v in values)
    return f"(SELECT count(*) FROM {source} WHERE {column} NOT IN ({listed}))"


check(
    "dq_unique",
    " UNION ALL ".join(
        f"SELECT 'raw_{t}' AS table_name, '{k}' AS column_name, 'unique' AS test, {_unique(v, k)} AS failures"
        for t, v, k in (
            ("orders", "a_raw_orders", "order_id"), ("payments", "a_raw_payments", "payment_id"),
            ("payments", "a_raw_payments", "order_id"), ("deliveries", "a_raw_deliveries", "delivery_id"),
            ("deliveries", "a_raw_deliveries", "order_id"), ("complaints", "a_complaint_events", "complaint_id"),
            ("complaints", "a_complaint_events", "order_id"), ("refunds", "a_raw_refunds", "refund_id"),
            ("refunds", "a_raw_refunds", "order_id"),
        )
    ),
)
check(
    "dq_not_null",
    " UNION ALL ".join(
        f"SELECT 'raw_{t}' AS table_name, '{k}' AS column_name, 'not_null' AS test, count(*) FILTER ({k} IS NULL) AS failures FROM {v}"
        for t, v, columns in (
            ("orders", "a_raw_orders", "order_id customer_id city order_ts order_amount order_status created_at"),
            ("payments", "a_raw_payments", "payment_id order_id payment_ts payment_method payment_status amount failure_reason created_at"),
            ("deliveries", "a_raw_deliveries", "delivery_id order_id city delivery_partner promised_minutes actual_minutes delivery_status created_at"),
            ("complaints", "a_raw_complaints", "complaint_id order_id complaint_ts complaint_text created_at ai_category ai_severity "
                                               "customer_emotion business_impact recommended_action"),
            ("refunds", "a_raw_refunds", "refund_id order_id refund_ts refund_amount refund_reason created_at"),
        )
        for k in columns.split()
    ),
)
check(
    "dq_accepted_values",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS column_name, 'accepted_values' AS test, {_outside(f'a_{t}', k, v)} AS failures"
        for t, k, v in (
            ("raw_orders", "order_status", ("confirmed", "Delivered", "CANCELLED")),
            ("raw_payments", "payment_status", ("success", "failed")),
            ("raw_payments", "payment_method", ("UPI", "Wallet", "COD")),
            ("raw_deliveries", "delivery_status", ("on_time", "delayed")),
            ("raw_deliveries", "delivery_partner", ("Delhivery", "BlueDart")),
            ("raw_complaints", "ai_severity", ("low", "medium", "high", "critical")),
            ("raw_complaints", "ai_category", ("app_issue",)),
            ("raw_refunds", "refund_reason", ("payment_failed", "wrong_product")),
        )
    ),
)
_SOURCE_OF = {
    "ai_pipeline_diagnosis": "audit",
    "stg_ai_diagnosis": "stg_ai_diagnosis",
    "mart_ai_diagnosis_summary": "mart_ai_diagnosis_summary",
    "mart_business_health_daily": "a_business_health",
}


# Layer, table, unique column or -, columns that are not null, and accepted values.
_TESTS = """
raw raw_orders order_id order_id,customer_id,order_ts
raw raw_payments payment_id payment_id,order_id,payment_ts
raw raw_deliveries delivery_id delivery_id,order_id
raw raw_complaints complaint_id complaint_id,order_id,complaint_ts
raw raw_refunds refund_id refund_id,order_id
raw ai_pipeline_diagnosis diagnosis_id diagnosis_id,run_timestamp
staging stg_orders order_id order_id,customer_id,order_ts,order_amount,city
staging stg_payments payment_id payment_id,order_id,payment_ts,is_success,is_failed
staging stg_deliveries delivery_id delivery_id,order_id,city,is_delayed
staging stg_complaints complaint_id complaint_id,order_id,severity_score
staging stg_refunds refund_id refund_id,order_id,refund_amount
staging stg_ai_diagnosis diagnosis_id diagnosis_id,run_timestamp,severity,confidence
marts mart_order_summary - order_date,city,total_orders,total_revenue
marts mart_payment_health - payment_date,payment_method health_status=healthy,warning,critical
marts mart_delivery_performance - delivery_date,city health_status=healthy,warning,critical
marts mart_complaint_insights - complaint_date,total_complaints
marts mart_ai_diagnosis_summary run_date run_date,pipeline_health_score
marts mart_business_health_daily business_date business_date overall_status=healthy,degraded,critical
"""


def _report() -> str:
    rows = []
    for line in _TESTS.split("\n")[1:-1]:
        layer, table, unique, filled, *accepted = line.split(" ")
        source = _SOURCE_OF.get(table, f"a_{table}")
        failures = [(k, "not_null", f"(SELECT count(*) FROM {source} WHERE {k} IS NULL)") for k in filled.split(",")]
        for k, values in (rule.split("=") for rule in accepted):
            failures.append((k, "accepted_values", _outside(source, k, tuple(values.split(",")))))
        if unique != "-":
            failures.append((unique, "unique", _unique(source, unique)))
        rows += [
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{k}' AS column_name, '{test}' AS test, {n} AS failures"
            for k, test, n in failures
        ]
    return f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(rows)})"


check("dq_report", _report())
check(
    "dq_on_write",
    f"""SELECT *, bool_and(passed) OVER (PARTITION BY table_name) AS published
        FROM ({_report()}) WHERE layer <> 'raw'""",
)

# ------------------------------------------------------------------------ dashboards

check(
    "dash_executive",
    """SELECT business_date, total_orders, total_revenue, cancellation_rate, overall_status
       FROM a_business_health""",
)
check(
    "dash_payment_by_method",
    f"""SELECT payment_method, count(*) AS total_payments,
               count(*) FILTER (is_failed) AS failed_payments,
               {share('count(*) FILTER (is_failed)', 'count(*)')} AS failure_rate
        FROM a_stg_payments GROUP BY payment_method""",
)
check(
    "dash_delay_heatmap",
    f"""SELECT city, delivery_date, count(*) AS total_deliveries,
               count(*) FILTER (is_delayed) AS delayed_deliveries,
               {share('count(*) FILTER (is_delayed)', 'count(*)')} AS delay_rate
        FROM a_stg_deliveries GROUP BY city, delivery_date""",
)
check(
    "dash_complaint_severity",
    "SELECT ai_severity, count(*) AS total_complaints FROM a_stg_complaints GROUP BY ai_severity",
)
check("dash_health_trend", "SELECT run_date, pipeline_health_score FROM mart_ai_diagnosis_summary")
check(
    "dash_llm_usage",
    f"""SELECT count(*) AS total_diagnoses, count(*) FILTER (is_llm_diagnosis) AS llm_diagnoses,
               count(*) FILTER (NOT is_llm_diagnosis) AS fallback_diagnoses,
               {share('count(*) FILTER (is_llm_diagnosis)', 'count(*)')} AS llm_usage_rate,
               {share('count(*) FILTER (NOT is_llm_diagnosis)', 'count(*)')} AS fallback_rate
        FROM stg_ai_diagnosis""",
)
check(
    "dash_recent_diagnoses",
    """SELECT diagnosis_id, run_timestamp, status, severity, confidence, issue_summary, diagnosis_source
       FROM stg_ai_diagnosis ORDER BY run_timestamp DESC, diagnosis_id DESC LIMIT 20""",
)

# ------------------------------------------------------------------------ streams

check(
    "stream_ingest",
    " UNION ALL ".join(
        f"SELECT 'raw_{t}' AS table_name, {_KEY_OF[t]} AS event_key, order_id, created_at FROM b_raw_{t}"
        for t in _RAW
    )
    + f" UNION ALL SELECT 'pipeline_logs', message, 'error', received_at FROM ({_logged})",
)
check(
    "stream_dedup",
    f"""SELECT DISTINCT topic, {_seen_key} AS event_key, CASE WHEN shift = 2 THEN "offset" END AS unkeyed_offset
        FROM messages""",
)
_activity = " UNION ALL ".join(
    f"SELECT '{d}' AS domain, ts, hit FROM {d}_seen" for d in METRIC_OF
)
_closed = f"(SELECT max(ts) - INTERVAL 10 MINUTE FROM ({_activity}))"
check(
    "stream_window_metrics",
    f"""SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, domain,
               count(*) AS total, count(*) FILTER (hit) AS hits,
               {share('count(*) FILTER (hit)', 'count(*)')} AS hit_rate
        FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) AS window_start FROM ({_activity}))
        WHERE window_start + INTERVAL 30 MINUTE <= {_closed}
        GROUP BY window_start, domain""",
)
check(
    "stream_sliding_features",
    f"""SELECT run_timestamp, orders, revenue, payments, failed, failure_rate, deliveries, delayed,
               delay_rate, avg_delay_minutes, complaints, severe, severe_rate
        FROM features
        WHERE run_timestamp <= {_closed} AND orders + payments + deliveries + complaints > 0""",
)
check(
    "stream_doctor",
    f"""SELECT run_timestamp, status, severity, issue_summary, array_to_string(tags, ',') AS tags,
               source, alert_fingerprint, alerted_at
        FROM decided
        WHERE run_timestamp <= (SELECT max(cell_end) FROM (
          SELECT time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS cell_end FROM ({_activity})
        ) WHERE cell_end <= {_closed})""",
)
check(
    "stream_alert_dedup",
    """SELECT alert_fingerprint, run_timestamp, should_alert, suppression_reason
       FROM decided WHERE candidate""",
)
check(
    "compacted_batches",
    """SELECT order_id, customer_id, city, order_ts, CAST(order_amount AS DOUBLE) AS order_amount, order_status, created_at
       FROM b_raw_orders""",
)
check("stream_alert_gate", "SELECT alert_fingerprint, run_timestamp, should_alert, suppression_reason FROM decided WHERE candidate")
check(
    "late_policy",
    """SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS rows, 0 AS late_rows, max(ts) AS max_event_ts
       FROM events WHERE event_id % 50 <> 0
       UNION ALL
       SELECT 1, count(*),
              count(*) FILTER (time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE <= mark), max(ts)
       FROM events CROSS JOIN (SELECT max(ts) - INTERVAL 10 MINUTE AS mark
                               FROM events WHERE event_id % 50 <> 0)
       WHERE event_id % 50 = 0""",
)
