"""Named SQL parts: the silver-shaped views and the gold tables, in DuckDB SQL."""

VIEWS = {
    "r_orders": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS sales_channel,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 12 AS VARCHAR) END AS store_id,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'CANCELLED' END AS status,
  o_orderdate AS ordered_at_utc, o_orderdate + INTERVAL '1' DAY AS updated_at_utc, o_orderdate + INTERVAL '2' DAY AS ingested_at_utc,
  CAST(o_orderkey % 25 AS DECIMAL(14,2)) AS shipping_revenue, CAST(o_orderkey AS VARCHAR) AS source_row_id
FROM orders
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderpriority,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 12 AS VARCHAR) END, 'RETURNED',
  o_orderdate, o_orderdate + INTERVAL '9' DAY, o_orderdate + INTERVAL '10' DAY,
  CAST(o_orderkey % 25 AS DECIMAL(14,2)), concat('dup-', CAST(o_orderkey AS VARCHAR))
FROM orders WHERE o_orderkey % 20 = 0""",
    "r_order_items": """
SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS order_item_id,
  CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
  CASE WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS quantity,
  CAST(l_extendedprice AS DECIMAL(14,2)) AS unit_price,
  CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS item_discount_amount,
  concat(CAST(l_partkey AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR), '-', CAST(CAST(l_quantity AS INT) AS VARCHAR)) AS source_row_id
FROM lineitem""",
    "r_order_promotions": """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, concat('PR-', CAST(CAST(round(l_discount * 100, 0) AS INT) AS VARCHAR)) AS promotion_id,
  CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS discount_amount
FROM lineitem""",
    "r_customers": """
SELECT CASE WHEN c_acctbal < 0 THEN concat('archived-', c_custkey) ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
  CAST(c_nationkey AS VARCHAR) AS city_id, c_mktsegment AS customer_segment, concat('c-', CAST(c_custkey AS VARCHAR)) AS source_row_id
FROM customer""",
    "r_customer_profiles": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_nationkey AS VARCHAR) AS city_id, c_mktsegment AS customer_segment,
  TIMESTAMP '1994-01-01' AS valid_from_utc, TIMESTAMP '1997-06-15' AS valid_to_utc, concat('v-1-', CAST(c_custkey AS VARCHAR)) AS source_row_id
FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), 'LOYAL', TIMESTAMP '1997-06-15', NULL, concat('v-2-', CAST(c_custkey AS VARCHAR)) FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), 'TRIAL', TIMESTAMP '1997-01-01', TIMESTAMP '1999-01-01', concat('v-3-', CAST(c_custkey AS VARCHAR))
FROM customer WHERE c_acctbal > 5000""",
    "r_products": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, concat('SKU-', CAST(p_partkey AS VARCHAR)) AS sku, p_name AS product_name,
  CAST(p_retailprice AS DECIMAL(14,2)) AS unit_price, CAST(p_partkey AS VARCHAR) AS source_row_id
FROM part""",
    "r_product_categories": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category_name, DATE '1995-01-01' AS valid_from_utc,
  DATE '1998-01-01' AS valid_to_utc, CAST(p_partkey AS VARCHAR) AS source_row_id
FROM part
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), p_brand, DATE '1998-01-01', CAST(NULL AS DATE), concat('b', CAST(p_partkey AS VARCHAR)) FROM part
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), 'STALE', DATE '1998-01-01', CAST(NULL AS DATE), concat('a', CAST(p_partkey AS VARCHAR))
FROM part WHERE p_partkey % 10 = 0""",
    "paid_orders": """
SELECT *, CAST(o_totalprice AS DECIMAL(14,2)) AS total, (o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT') AS is_captured,
  CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN concat('lost-', o_orderkey) ELSE CAST(o_orderkey AS VARCHAR) END AS order_id
FROM orders""",
    "first_captures": """
SELECT order_id, o_orderkey, concat('cap1-', CAST(o_orderkey AS VARCHAR)) AS event_id, 'PAYMENT_CAPTURED' AS event_type,
  o_orderdate + INTERVAL '1' HOUR AS occurred_at_utc,
  CASE WHEN o_orderkey % 101 = 0 THEN CAST(0 AS DECIMAL(14,2))
       WHEN o_orderkey % 5 = 0 THEN CAST(total * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(14,2)) ELSE total END AS amount
FROM paid_orders WHERE is_captured""",
    "all_payments": """
SELECT order_id, o_orderkey, concat('auth-', CAST(o_orderkey AS VARCHAR)) AS event_id, 'PAYMENT_AUTHORIZED' AS event_type, o_orderdate AS occurred_at_utc, total AS amount FROM paid_orders
UNION ALL SELECT * FROM first_captures
UNION ALL SELECT * FROM first_captures WHERE o_orderkey % 11 = 0
UNION ALL
SELECT order_id, o_orderkey, concat('cap2-', CAST(o_orderkey AS VARCHAR)), 'PAYMENT_CAPTURED', o_orderdate + INTERVAL '2' HOUR,
  CASE WHEN o_orderkey % 101 = 0 THEN CAST(0 AS DECIMAL(14,2)) ELSE CAST(total * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(14,2)) END
FROM paid_orders WHERE is_captured AND o_orderkey % 5 = 0
UNION ALL
SELECT order_id, o_orderkey, concat('fail-', CAST(o_orderkey AS VARCHAR)), 'PAYMENT_FAILED', o_orderdate + INTERVAL '3' HOUR, CAST(0 AS DECIMAL(14,2))
FROM paid_orders WHERE o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'""",
    "r_payment_events": """
SELECT event_id, event_type, occurred_at_utc, order_id,
  concat('PAY-', CAST(o_orderkey AS VARCHAR)) AS payment_id, amount
FROM all_payments""",
    "returned_lines": """
SELECT *, concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS line
FROM lineitem WHERE l_returnflag = 'R'""",
    "refunds_once": """
SELECT concat('rf-', line, '-', CAST(l_partkey % 2 AS VARCHAR)) AS event_id,
  CASE WHEN l_linestatus = 'F' THEN 'REFUND_COMPLETED' ELSE 'REFUND_REQUESTED' END AS event_type,
  l_shipdate + INTERVAL '5' DAY AS occurred_at_utc, l_shipdate + INTERVAL '5' DAY + to_days(CAST(l_suppkey % 3 AS INT)) AS ingested_at_utc,
  CAST(l_orderkey AS VARCHAR) AS order_id, concat('RF-', line) AS refund_id,
  CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(14,2)) AS amount, l_linenumber
FROM returned_lines""",
    "r_refund_events": """
SELECT * EXCLUDE (l_linenumber) FROM refunds_once
UNION ALL SELECT * EXCLUDE (l_linenumber) FROM refunds_once WHERE l_linenumber = 3""",
    "r_return_events": """
SELECT concat('rt-', line, '-', l_linestatus) AS event_id,
  CASE WHEN l_linestatus = 'F' THEN 'RETURN_COMPLETED' ELSE 'RETURN_REQUESTED' END AS event_type,
  l_shipdate + INTERVAL '3' DAY + to_days(early) AS occurred_at_utc, l_shipdate + INTERVAL '6' DAY - to_days(early) AS ingested_at_utc,
  CAST(l_orderkey AS VARCHAR) AS order_id, concat('RET-', l_orderkey, CASE early WHEN 1 THEN '-first' ELSE '' END) AS return_id
FROM returned_lines, (VALUES (0), (1)) AS arrivals(early) WHERE early = 0 OR l_linenumber = 3""",
    "r_support_events": """
SELECT concat('su-', CAST(o_orderkey AS VARCHAR)) AS event_id,
  CASE WHEN o_orderstatus = 'P' THEN 'SUPPORT_TICKET_CLOSED' ELSE 'SUPPORT_TICKET_CREATED' END AS event_type,
  o_orderdate + INTERVAL '6' HOUR + to_days(early) AS occurred_at_utc, o_orderdate + INTERVAL '3' DAY - to_days(early) AS ingested_at_utc,
  CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN o_orderkey % 3 <> 0 THEN concat('T', o_orderkey, CASE early WHEN 1 THEN '-first' ELSE '' END) END AS ticket_id
FROM orders, (VALUES (0), (1)) AS arrivals(early) WHERE early = 0 OR o_orderkey % 7 = 0""",
    "web_hits": """
SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS hit, event_id // 4 AS web_order FROM events""",
    "r_web_events": """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, o_orderdate - INTERVAL '1' DAY + to_hours(CAST(event_id % 3 AS INT)) AS occurred_at_utc,
  CASE WHEN event_type IN ('purchase', 'click') THEN CAST(o_orderkey AS VARCHAR) END AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
  CASE WHEN hit % 5 = 0 THEN NULL ELSE concat('CMP-', CAST(hit % 8 AS VARCHAR)) END AS campaign_id,
  CASE WHEN event_id % 2 = 0 THEN 'WEB' ELSE 'MOBILE' END AS channel,
  concat(CAST(user_id AS VARCHAR), '-', CAST(event_id % 6 AS VARCHAR)) AS session_id
FROM web_hits JOIN orders ON o_orderkey = web_order""",
    "r_inventory_snapshots": """
SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey % 3 AS VARCHAR) AS location_id, l_shipdate AS snapshot_date,
  CAST((l_partkey * 7 + l_suppkey) % 40 - 8 AS BIGINT) AS available_quantity, CAST(l_linenumber AS BIGINT) AS reserved_quantity
FROM lineitem
UNION ALL
SELECT CAST(l_partkey AS VARCHAR), '0', o_orderdate, CAST((l_partkey + o_orderkey) % 30 - 5 AS BIGINT), CAST(1 AS BIGINT)
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linestatus = 'O'""",
    "r_campaign_spend": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS spend_date, concat('CMP-', CAST(o_orderkey % 9 AS VARCHAR)) AS campaign_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'WEB' ELSE 'MOBILE' END AS channel,
  CAST(CASE WHEN o_orderkey % 17 = 0 THEN 0 ELSE 50 + o_orderkey % 400 END AS DECIMAL(14,2)) AS spend_amount
FROM orders""",
}

FACTS = {
    "latest_orders": """
SELECT DISTINCT ON (order_id) * FROM r_orders
ORDER BY order_id, updated_at_utc DESC NULLS LAST, ingested_at_utc DESC NULLS LAST, source_row_id ASC NULLS LAST""",
    "items_clean": """
SELECT DISTINCT ON (order_item_id) * FROM r_order_items WHERE quantity >= 0 ORDER BY order_item_id, source_row_id""",
    "items_by_order": """
SELECT order_id, count(DISTINCT order_item_id) AS item_count, CAST(sum(quantity) AS BIGINT) AS unit_quantity,
  sum(quantity * unit_price) AS gross_merchandise_value, sum(item_discount_amount) AS discount_amount
FROM r_order_items GROUP BY ALL""",
    "pay_once": """
SELECT DISTINCT event_id, order_id, amount, event_type, occurred_at_utc FROM r_payment_events""",
    "captures": """
SELECT order_id, sum(if(event_type = 'PAYMENT_CAPTURED', amount, NULL)) AS captured_payment_amount FROM pay_once GROUP BY ALL""",
    "pay_latest": """
SELECT DISTINCT ON (order_id) order_id, event_type AS payment_status FROM r_payment_events
ORDER BY order_id, occurred_at_utc DESC NULLS LAST, event_id DESC""",
    "refund_max": """
SELECT DISTINCT ON (order_id, refund_id) order_id, refund_id, amount FROM r_refund_events
WHERE event_type = 'REFUND_COMPLETED' ORDER BY order_id, refund_id, amount DESC NULLS LAST""",
    "refund_totals": """
SELECT order_id, sum(amount) AS refunded_amount FROM refund_max GROUP BY ALL""",
    "return_latest": """
SELECT DISTINCT ON (order_id) order_id, event_type AS return_status FROM r_return_events
ORDER BY order_id, occurred_at_utc DESC NULLS LAST, event_id DESC, event_type DESC""",
    "promos_by_order": """
SELECT order_id, count(DISTINCT promotion_id) AS promotion_count FROM r_order_promotions GROUP BY ALL""",
    "order_ranks": """
SELECT order_id, customer_id, ordered_at_utc, row_number() OVER (PARTITION BY customer_id ORDER BY ordered_at_utc, order_id) AS customer_order_rank
FROM latest_orders""",
    # every contribution to an order as one row, added up once
    "order_parts": """
SELECT order_id, quantity * unit_price AS gross, item_discount_amount AS discount, quantity AS units, order_item_id AS item FROM r_order_items
UNION ALL BY NAME SELECT order_id, amount AS captured FROM pay_once WHERE event_type = 'PAYMENT_CAPTURED'
UNION ALL BY NAME SELECT order_id, amount AS refunded FROM refund_max
UNION ALL BY NAME SELECT order_id, promotion_id AS promo FROM r_order_promotions
UNION ALL BY NAME SELECT order_id, shipping_revenue AS shipping FROM latest_orders""",
    "order_totals": """
SELECT order_id, ifnull(sum(gross), 0) AS gross_merchandise_value, ifnull(sum(discount), 0) AS discount_amount,
  ifnull(sum(shipping), 0) AS shipping_revenue, ifnull(sum(captured), 0) AS captured_payment_amount, ifnull(sum(refunded), 0) AS refunded_amount,
  count(DISTINCT item) AS item_count, CAST(ifnull(sum(units), 0) AS BIGINT) AS unit_quantity, count(DISTINCT promo) AS promotion_count
FROM order_parts GROUP BY ALL""",
    "o360": """
SELECT order_id, customer_id, CAST(ordered_at_utc AS DATE) AS order_date, sales_channel, store_id, status AS order_status,
  order_totals.* EXCLUDE (order_id), gross_merchandise_value - discount_amount + order_totals.shipping_revenue - refunded_amount AS net_revenue,
  ifnull(payment_status, 'NO_PAYMENT') AS payment_status, ifnull(return_status, 'NO_RETURN') AS return_status,
  order_id IN (SELECT order_id FROM order_ranks WHERE customer_order_rank = 1) AS first_order_flag
FROM latest_orders JOIN order_totals USING (order_id) LEFT JOIN pay_latest USING (order_id) LEFT JOIN return_latest USING (order_id)""",
    "contacts": """
SELECT customer_id, CAST(occurred_at_utc AS DATE) AS metric_date, count(DISTINCT ifnull(ticket_id, event_id)) AS support_contacts
FROM r_support_events WHERE event_type = 'SUPPORT_TICKET_CREATED' GROUP BY ALL""",
    "channel_of_day": """
SELECT DISTINCT ON (customer_id, metric_date) customer_id, metric_date, sales_channel AS active_channel
FROM (SELECT customer_id, order_date AS metric_date, sales_channel, count(*) AS n FROM o360 GROUP BY ALL)
ORDER BY customer_id, metric_date, n DESC, sales_channel""",
    "cust_totals": """
SELECT customer_id, order_date AS metric_date, count(*) AS order_count, CAST(sum(unit_quantity) AS BIGINT) AS unit_quantity,
  sum(gross_merchandise_value) AS gross_revenue, sum(net_revenue) AS net_revenue, sum(refunded_amount) AS refund_amount,
  count_if(return_status <> 'NO_RETURN') AS return_count, max(first_order_flag) AS new_customer_flag, NOT min(first_order_flag) AS repeat_customer_flag
FROM o360 GROUP BY ALL""",
    "cust_day": """
SELECT * REPLACE (ifnull(support_contacts, 0) AS support_contacts)
FROM cust_totals JOIN channel_of_day USING (customer_id, metric_date) LEFT JOIN contacts USING (customer_id, metric_date)""",
    "line_days": """
SELECT r_order_items.*, order_date AS metric_date, refunded_amount > 0 AS refunded FROM r_order_items JOIN o360 USING (order_id)""",
    "sales_day": """
SELECT product_id, metric_date, CAST(sum(quantity) AS BIGINT) AS units_sold, count(DISTINCT order_id) AS order_count, sum(quantity * unit_price) AS gross_revenue
FROM line_days GROUP BY ALL""",
    "stock_day": """
SELECT product_id, CAST(snapshot_date AS DATE) AS metric_date, CAST(sum(available_quantity) AS BIGINT) AS available_inventory,
  CAST(sum(reserved_quantity) AS BIGINT) AS reserved_inventory
FROM r_inventory_snapshots GROUP BY ALL""",
    "versions": """
SELECT DISTINCT ON (product_id, valid_from_utc) * FROM r_product_categories ORDER BY product_id, valid_from_utc, source_row_id DESC""",
    "promo_day": """
SELECT product_id, metric_date, count(DISTINCT promotion_id) AS promotion_count FROM line_days LEFT JOIN r_order_promotions USING (order_id) GROUP BY ALL""",
    "refund_units_day": """
SELECT product_id, metric_date, CAST(sum(quantity) AS BIGINT) AS refunded_units FROM line_days WHERE refunded GROUP BY ALL""",
    "discount_day": """
SELECT product_id, metric_date, sum(item_discount_amount) AS discount_amount FROM line_days GROUP BY ALL""",
    "refund_value_day": """
SELECT product_id, metric_date, sum(quantity * unit_price * refunded::INT) AS refund_amount FROM line_days GROUP BY ALL""",
    # sales lines, stock counts and promotions of a product day as rows of one list
    "day_rows": """
SELECT product_id, metric_date, order_id, quantity AS units, quantity * unit_price AS gross, item_discount_amount AS discount, refunded FROM line_days
UNION ALL BY NAME SELECT product_id, CAST(snapshot_date AS DATE) AS metric_date, available_quantity AS available, reserved_quantity AS reserved FROM r_inventory_snapshots
UNION ALL BY NAME SELECT product_id, metric_date, promotion_id FROM line_days JOIN r_order_promotions USING (order_id)""",
    "grid_day": """
SELECT DISTINCT product_id, metric_date FROM day_rows""",
    "covering": """
SELECT product_id, metric_date, category_name, valid_from_utc, source_row_id FROM grid_day JOIN r_product_categories USING (product_id)
WHERE metric_date >= valid_from_utc AND metric_date < ifnull(valid_to_utc, DATE '9999-12-31')""",
    "category_day": """
SELECT product_id, metric_date, max_by(category_name, (valid_from_utc, source_row_id)) AS active_category
FROM grid_day LEFT JOIN covering USING (product_id, metric_date) GROUP BY ALL""",
    "category_stock_day": """
SELECT product_id, metric_date, category_name FROM stock_day LEFT JOIN versions ON versions.product_id = stock_day.product_id
  AND metric_date BETWEEN valid_from_utc AND ifnull(valid_to_utc - 1, DATE '9999-12-31')""".replace("SELECT product_id", "SELECT stock_day.product_id"),
    "prod_measures": """
SELECT product_id, metric_date, CAST(ifnull(sum(units), 0) AS BIGINT) AS units_sold, count(DISTINCT order_id) AS order_count, ifnull(sum(gross), 0) AS gross_revenue,
  ifnull(sum(gross) - sum(discount) - ifnull(sum(if(refunded, gross, NULL)), 0), 0) AS net_revenue,
  CAST(ifnull(sum(if(refunded, units, NULL)), 0) AS BIGINT) AS refunded_units, CAST(sum(available) AS BIGINT) AS available_inventory,
  CAST(sum(reserved) AS BIGINT) AS reserved_inventory, sum(available) <= 0 AS stockout_flag, count(DISTINCT promotion_id) AS promotion_count
FROM day_rows GROUP BY ALL""",
    "prod_day": """
SELECT * FROM prod_measures JOIN category_day USING (product_id, metric_date)""",
    "touches": """
SELECT DISTINCT event_id, order_id, customer_id, campaign_id, channel AS sales_channel, occurred_at_utc FROM r_web_events WHERE campaign_id IS NOT NULL""",
    "under_way": """
SELECT l_returnflag AS flag, o_orderdate AS ordered_at, CAST(l_shipdate AS DATE) AS shipped, l_orderkey * 8 + l_linenumber AS line
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE l_returnflag IS NOT NULL""",
    "last_touch": """
SELECT DISTINCT ON (order_id) order_id, campaign_id, sales_channel, occurred_at_utc, event_id
FROM touches WHERE order_id IS NOT NULL ORDER BY order_id, occurred_at_utc DESC NULLS LAST, event_id DESC""",
    "won_orders": """
SELECT order_date AS metric_date, last_touch.sales_channel, campaign_id, order_id, customer_id, gross_merchandise_value, net_revenue, refunded_amount
FROM last_touch JOIN o360 USING (order_id)""",
    "attributed": """
SELECT metric_date, sales_channel, campaign_id, count(DISTINCT order_id) AS attributed_orders, count(DISTINCT customer_id) AS attributed_customers,
  sum(gross_merchandise_value) AS gross_revenue, sum(net_revenue) AS net_revenue, sum(refunded_amount) AS refunds
FROM won_orders GROUP BY ALL""",
    "spend_day": """
SELECT spend_date AS metric_date, channel AS sales_channel, campaign_id, sum(spend_amount) AS campaign_spend FROM r_campaign_spend GROUP BY ALL""",
    "session_day": """
SELECT CAST(occurred_at_utc AS DATE) AS metric_date, channel AS sales_channel, campaign_id, count(DISTINCT session_id) AS sessions
FROM r_web_events WHERE campaign_id IS NOT NULL GROUP BY ALL""",
    "campaign_rows": """
SELECT * FROM won_orders
UNION ALL BY NAME SELECT spend_date AS metric_date, channel AS sales_channel, campaign_id, spend_amount FROM r_campaign_spend""",
    "grid_campaign": """
SELECT DISTINCT metric_date, sales_channel, campaign_id FROM campaign_rows""",
    "campaign_totals": """
SELECT metric_date, sales_channel, campaign_id, ifnull(sum(spend_amount), 0) AS campaign_spend, count(DISTINCT order_id) AS attributed_orders,
  count(DISTINCT customer_id) AS attributed_customers, ifnull(sum(gross_merchandise_value), 0) AS gross_revenue,
  ifnull(sum(net_revenue), 0) AS net_revenue, ifnull(sum(refunded_amount), 0) AS refunds
FROM campaign_rows GROUP BY ALL""",
    "camp_day": """
SELECT * EXCLUDE (sessions), net_revenue::DOUBLE / nullif(campaign_spend, 0)::DOUBLE AS roas, attributed_orders::DOUBLE / nullif(sessions, 0)::DOUBLE AS conversion_rate
FROM campaign_totals LEFT JOIN session_day USING (metric_date, sales_channel, campaign_id)""",
    "kpi_orders": """
SELECT order_date AS metric_date, count(*) AS total_orders, sum(gross_merchandise_value) AS gross_revenue, sum(net_revenue) AS net_revenue,
  sum(gross_merchandise_value)::DOUBLE / count(*)::DOUBLE AS average_order_value,
  count_if(refunded_amount > 0) AS refunded_orders, count_if(payment_status = 'PAYMENT_CAPTURED') AS captured_orders,
  count_if(return_status <> 'NO_RETURN') AS returned_orders,
  count_if(return_status <> 'NO_RETURN' OR order_status <> 'PENDING') AS resolved_orders
FROM o360 GROUP BY ALL""",
    "kpi_customers": """
SELECT metric_date, count(DISTINCT customer_id) AS active_customers, count_if(repeat_customer_flag)::DOUBLE / count(*)::DOUBLE AS repeat_customer_rate,
  CAST(sum(support_contacts) AS BIGINT) AS support_contacts
FROM cust_day GROUP BY ALL""",
    "kpi_stock": """
SELECT metric_date, count_if(stockout_flag)::DOUBLE / count(stockout_flag)::DOUBLE AS stockout_rate FROM prod_measures
GROUP BY ALL HAVING count(stockout_flag) > 0""",
    "kpi_day": """
SELECT metric_date, total_orders, gross_revenue, net_revenue, average_order_value,
  ifnull(refunded_orders::DOUBLE / nullif(captured_orders, 0)::DOUBLE, 0) AS refund_rate,
  ifnull(returned_orders::DOUBLE / nullif(resolved_orders, 0)::DOUBLE, 0) AS return_rate, ifnull(repeat_customer_rate, 0) AS repeat_customer_rate,
  ifnull(stockout_rate, 0) AS stockout_rate, ifnull(active_customers, 0) AS active_customers,
  ifnull(support_contacts, 0)::DOUBLE / total_orders::DOUBLE AS support_contact_rate
FROM kpi_orders LEFT JOIN kpi_customers USING (metric_date) LEFT JOIN kpi_stock USING (metric_date)""",
    # the wider customer day
    "refund_done": """
SELECT * FROM r_refund_events WHERE event_type = 'REFUND_COMPLETED'""",
    "refund_by_event": """
SELECT DISTINCT ON (event_id) * FROM refund_done
ORDER BY event_id, ingested_at_utc DESC NULLS LAST, occurred_at_utc DESC NULLS LAST, amount DESC NULLS LAST, refund_id""",
    "refund_by_refund": """
SELECT DISTINCT ON (refund_id) * FROM refund_done
ORDER BY refund_id, occurred_at_utc DESC NULLS LAST, event_id DESC, amount DESC NULLS LAST, order_id""",
    "returns_counted": """
SELECT order_id, count(DISTINCT return_id) AS return_count FROM newest_returns GROUP BY ALL""",
    "o360_faulty": """
SELECT * FROM o360 UNION ALL BY NAME
SELECT * REPLACE (CAST(-1 AS DECIMAL(14,2)) AS refunded_amount, gross_merchandise_value - discount_amount + shipping_revenue + 5 AS net_revenue)
FROM o360 WHERE return_status <> 'NO_RETURN'""",
    "order_rich_faulty": """
SELECT * FROM order_rich UNION ALL BY NAME
SELECT * REPLACE (new_customer_flag AS repeat_customer_flag, 0 AS return_count) FROM order_rich WHERE return_status <> 'NO_RETURN'""",
    "newest_returns": """
SELECT DISTINCT ON (event_id) * FROM r_return_events
ORDER BY event_id, ingested_at_utc DESC NULLS LAST, occurred_at_utc DESC NULLS LAST, return_id""",
    "pay_alt": """
SELECT order_id, max(if(event_type = 'PAYMENT_CAPTURED', amount, 0)) AS captured_payment_amount,
  list_extract(['UNKNOWN', 'PAYMENT_FAILED', 'PAYMENT_AUTHORIZED', 'PAYMENT_CAPTURED'],
    max(ifnull(list_position(['UNKNOWN', 'PAYMENT_FAILED', 'PAYMENT_AUTHORIZED', 'PAYMENT_CAPTURED'], event_type), 1))) AS payment_status
FROM r_payment_events GROUP BY ALL""",
    "captures_corrected": """
SELECT order_id, sum(amount) AS captured_payment_amount FROM pay_once WHERE event_type = 'PAYMENT_CAPTURED' GROUP BY ALL""",
    "rich_parts": """
SELECT order_id, amount AS refund FROM refund_by_event
UNION ALL BY NAME SELECT order_id, quantity * unit_price AS gross, item_discount_amount AS discount, quantity AS units FROM r_order_items
UNION ALL BY NAME SELECT order_id, return_id FROM newest_returns
UNION ALL BY NAME SELECT order_id, shipping_revenue AS shipping FROM latest_orders""",
    "rich_totals": """
SELECT order_id, CAST(ifnull(sum(units), 0) AS BIGINT) AS unit_quantity, ifnull(sum(gross), 0) AS gross_revenue, ifnull(sum(discount), 0) AS discount_amount,
  ifnull(sum(shipping), 0) AS shipping_revenue, ifnull(sum(refund), 0) AS refund_amount, count(DISTINCT return_id) AS return_count
FROM rich_parts GROUP BY ALL""",
    "order_rich": """
SELECT order_id, latest_orders.customer_id, CAST(latest_orders.ordered_at_utc AS DATE) AS metric_date, sales_channel, rich_totals.* EXCLUDE (order_id),
  gross_revenue - discount_amount + rich_totals.shipping_revenue - refund_amount AS net_revenue,
  customer_order_rank = 1 AS new_customer_flag, customer_order_rank > 1 AS repeat_customer_flag,
  captured_payment_amount, payment_status, ifnull(return_status, 'NO_RETURN') AS return_status
FROM latest_orders JOIN rich_totals USING (order_id) JOIN order_ranks USING (order_id)
LEFT JOIN pay_alt USING (order_id) LEFT JOIN return_latest USING (order_id)""",
    "cust_day_wide": """
SELECT customer_id, metric_date, count(DISTINCT order_id) AS order_count, CAST(sum(unit_quantity) AS BIGINT) AS unit_quantity,
  sum(gross_revenue) AS gross_revenue, sum(discount_amount) AS discount_amount, sum(shipping_revenue) AS shipping_revenue,
  sum(refund_amount) AS refund_amount, CAST(sum(return_count) AS BIGINT) AS return_count, sum(net_revenue) AS net_revenue,
  ifnull(sum(captured_payment_amount), 0) AS captured_payment_amount,
  count_if(new_customer_flag) AS new_customer_order_count, count_if(repeat_customer_flag) AS repeat_customer_order_count
FROM order_rich GROUP BY ALL""",
    "negative_orders": """
SELECT order_id, gross_merchandise_value, discount_amount, shipping_revenue, net_revenue + refunded_amount AS revenue_before_refund,
  refunded_amount, net_revenue, order_status, payment_status, return_status, net_revenue < 0 AND refunded_amount > net_revenue + refunded_amount AS refund_exceeds_revenue
FROM o360 WHERE net_revenue < 0""",
    "anomalies": """
SELECT order_id, payment_status, captured_payment_amount, net_revenue FROM o360
WHERE captured_payment_amount < 0 OR (payment_status = 'PAYMENT_CAPTURED' AND captured_payment_amount <= 0)
  OR (payment_status = 'PAYMENT_AUTHORIZED' AND captured_payment_amount > 0)""",
}

PARTS = {**VIEWS, **FACTS}
