"""Raw tables derived from the test data.

The texts run unchanged in Spark and in the SQL check; ``{orders}`` and the like stand
for the source tables. Family ``a`` has warehouse grain (many days and cities, midnight
timestamps), family ``b`` event grain (30 days of events).
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "a_raw_orders": """
SELECT concat('ORD-', o_orderkey) AS order_id,
       concat('CUST-', o_custkey) AS customer_id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE n_name END AS city,
       o_orderdate AS order_ts,
       CASE WHEN o_orderkey % 101 = 0 THEN 'n/a'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS order_amount,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL
            WHEN o_orderkey % 50 = 1 THEN ' Cancelled '
            WHEN o_orderkey % 50 = 2 THEN ' delivered'
            WHEN o_orderstatus = 'F' THEN 'Delivered'
            WHEN o_orderstatus = 'P' THEN 'CANCELLED'
            ELSE 'confirmed' END AS order_status,
       o_orderdate AS created_at
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
""",
    "a_raw_payments": """
SELECT concat('PAY-', o_orderkey) AS payment_id,
       concat('ORD-', o_orderkey) AS order_id,
       o_orderdate AS payment_ts,
       CASE o_orderkey % 6 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Credit Card' WHEN 2 THEN ' Debit Card'
            WHEN 3 THEN 'Wallet' WHEN 4 THEN 'COD' ELSE NULL END AS payment_method,
       CASE WHEN o_custkey % 25 < 4 THEN 'Failed' WHEN o_custkey % 25 = 24 THEN 'pending'
            WHEN o_custkey % 25 = 23 THEN ' failed' ELSE 'success' END AS payment_status,
       CASE WHEN o_orderkey % 101 = 0 THEN 'n/a'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS amount,
       CASE WHEN o_custkey % 25 >= 4 THEN NULL
            ELSE CASE o_orderkey % 7 WHEN 0 THEN 'bank_timeout' WHEN 1 THEN 'insufficient_funds'
                 WHEN 2 THEN ' Gateway_Error' WHEN 3 THEN 'invalid_otp'
                 WHEN 4 THEN 'network_error' ELSE NULL END END AS failure_reason,
       o_orderdate AS created_at
FROM {orders}
""",
    "a_raw_deliveries": """
SELECT concat('DEL-', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS delivery_id,
       concat('ORD-', l_orderkey) AS order_id,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE n_name END AS city,
       CASE l_partkey % 6 WHEN 0 THEN 'Delhivery' WHEN 1 THEN 'Ecom Express' WHEN 2 THEN 'BlueDart'
            WHEN 3 THEN 'Shadowfax' WHEN 4 THEN 'Xpressbees' ELSE NULL END AS delivery_partner,
       CASE WHEN l_orderkey % 89 = 0 THEN NULL
            ELSE CASE l_suppkey % 4 WHEN 0 THEN 30 WHEN 1 THEN 45 WHEN 2 THEN 60 ELSE 90 END
       END AS promised_minutes,
       CASE l_suppkey % 4 WHEN 0 THEN 30 WHEN 1 THEN 45 WHEN 2 THEN 60 ELSE 90 END
           - 35 + CAST(l_quantity AS INT) AS actual_minutes,
       CASE WHEN l_quantity > 35 THEN 'delayed' ELSE 'on_time' END AS delivery_status,
       l_shipdate AS created_at
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
""",
    "a_raw_refunds": """
SELECT concat('REF-', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS refund_id,
       concat('ORD-', l_orderkey) AS order_id,
       l_shipdate AS refund_ts,
       CASE WHEN l_orderkey % 101 = 0 THEN NULL
            ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS refund_amount,
       CASE l_partkey % 5 WHEN 0 THEN 'payment_failed' WHEN 1 THEN 'wrong_product'
            WHEN 2 THEN 'late_delivery' WHEN 3 THEN 'customer_cancelled' ELSE NULL END AS refund_reason,
       l_shipdate AS created_at
FROM {lineitem} WHERE l_returnflag = 'R'
""",
    "a_complaint_events": """
SELECT concat('CMP-', doc_id) AS complaint_id,
       concat('ORD-', o_orderkey) AS order_id,
       o_orderdate AS complaint_ts,
       CASE doc_id % 8
            WHEN 0 THEN 'Payment deducted but order not confirmed'
            WHEN 1 THEN 'Delivery is very late and support is not responding'
            WHEN 2 THEN 'Wrong product received'
            WHEN 3 THEN 'Refund is still pending after many days'
            WHEN 4 THEN 'App crashed while placing order'
            WHEN 5 THEN 'Delivery partner marked delivered but I did not receive it'
            WHEN 6 THEN text ELSE NULL END AS complaint_text,
       o_orderdate AS created_at
FROM {documents} JOIN {orders} ON o_orderkey = doc_id
""",
    "b_raw_orders": """
SELECT concat('ORD-', event_id) AS order_id, concat('CUST-', user_id) AS customer_id,
       CASE user_id % 9 WHEN 0 THEN 'Bengaluru' WHEN 1 THEN 'Mumbai' WHEN 2 THEN 'Delhi'
            WHEN 3 THEN 'Hyderabad' WHEN 4 THEN 'Pune' WHEN 5 THEN 'Kolkata'
            WHEN 6 THEN 'Chennai' WHEN 7 THEN 'Rourkela' ELSE NULL END AS city,
       CAST(ts AS TIMESTAMP) AS order_ts, CAST(value AS DECIMAL(10,2)) AS order_amount,
       CASE event_id % 7 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'created' WHEN 2 THEN 'packed'
            WHEN 3 THEN NULL ELSE 'confirmed' END AS order_status,
       CAST(ts AS TIMESTAMP) AS created_at
FROM {events}
""",
    "b_raw_payments": """
SELECT concat('PAY-', event_id) AS payment_id, concat('ORD-', event_id) AS order_id,
       CAST(ts AS TIMESTAMP) AS payment_ts,
       CASE event_id % 5 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Debit Card'
            WHEN 3 THEN 'Wallet' ELSE 'COD' END AS payment_method,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS payment_status,
       CAST(value AS DECIMAL(10,2)) AS amount,
       CASE WHEN event_type <> 'error' THEN NULL
            ELSE CASE user_id % 6 WHEN 0 THEN 'bank_timeout' WHEN 1 THEN 'insufficient_funds'
                 WHEN 2 THEN 'gateway_error' WHEN 3 THEN 'invalid_otp' WHEN 4 THEN 'network_error'
                 ELSE NULL END END AS failure_reason,
       CAST(ts AS TIMESTAMP) AS created_at
FROM {events}
""",
    "b_raw_deliveries": """
SELECT concat('DEL-', event_id) AS delivery_id, concat('ORD-', event_id) AS order_id,
       CASE user_id % 9 WHEN 0 THEN 'Bengaluru' WHEN 1 THEN 'Mumbai' WHEN 2 THEN 'Delhi'
            WHEN 3 THEN 'Hyderabad' WHEN 4 THEN 'Pune' WHEN 5 THEN 'Kolkata'
            WHEN 6 THEN 'Chennai' WHEN 7 THEN 'Rourkela' ELSE NULL END AS city,
       CASE event_id % 5 WHEN 0 THEN 'Delhivery' WHEN 1 THEN 'Ecom Express' WHEN 2 THEN 'BlueDart'
            WHEN 3 THEN 'Shadowfax' ELSE 'Xpressbees' END AS delivery_partner,
       CASE WHEN event_id % 37 = 0 THEN NULL
            ELSE CASE event_id % 4 WHEN 0 THEN 30 WHEN 1 THEN 45 WHEN 2 THEN 60 ELSE 90 END
       END AS promised_minutes,
       greatest(10, CASE event_id % 4 WHEN 0 THEN 30 WHEN 1 THEN 45 WHEN 2 THEN 60 ELSE 90 END
                    - 75 + CAST(floor(value) AS INT)) AS actual_minutes,
       CASE WHEN value >= 76 THEN 'delayed' ELSE 'on_time' END AS delivery_status,
       CAST(ts AS TIMESTAMP) AS created_at
FROM {events}
""",
    "b_raw_refunds": """
SELECT concat('REF-', event_id) AS refund_id, concat('ORD-', event_id) AS order_id,
       CAST(ts AS TIMESTAMP) AS refund_ts, CAST(value AS DECIMAL(10,2)) AS refund_amount,
       CASE WHEN event_type = 'error' THEN 'payment_failed' WHEN event_id % 25 = 0 THEN 'wrong_product'
            ELSE 'late_delivery' END AS refund_reason,
       CAST(ts AS TIMESTAMP) AS created_at
FROM {events} WHERE event_type = 'error' OR event_id % 25 < 2
""",
    "b_complaint_events": """
SELECT concat('CMP-', event_id) AS complaint_id, concat('ORD-', event_id) AS order_id,
       CAST(ts AS TIMESTAMP) AS complaint_ts,
       CASE user_id % 6
            WHEN 0 THEN 'Payment deducted but order not confirmed'
            WHEN 1 THEN 'Delivery is very late and support is not responding'
            WHEN 2 THEN 'Wrong product received'
            WHEN 3 THEN 'Refund is still pending after many days'
            WHEN 4 THEN 'App crashed while placing order'
            ELSE 'Delivery partner marked delivered but I did not receive it' END AS complaint_text,
       CAST(ts AS TIMESTAMP) AS created_at
FROM {events} WHERE event_type = 'error'
""",
}
