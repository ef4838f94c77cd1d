"""The final SELECT of every oracle; parts are named in ``parts.py``."""


def _share(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) / CAST(count(*) AS DOUBLE)"


def _mean(value: str) -> str:
    return f"CAST(sum({value}) AS DOUBLE) / CAST(count({value}) AS DOUBLE)"


def _daily(name: str) -> str:
    return f"SELECT metric_date, {name} FROM kpi_day"


def _grain(table: str, keys: str, null_test: str) -> str:
    return f"""
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS unique_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, CAST(sum(k) AS BIGINT) AS null_rows
FROM (SELECT {keys}, count(*) AS n, count(*) FILTER (WHERE {null_test}) AS k FROM {table} GROUP BY {keys})"""


_KPI_JSON = """SELECT strftime(metric_date, '%Y-%m-%d') AS metric_date, total_orders, CAST(gross_revenue AS DOUBLE) AS gross_revenue,
  CAST(net_revenue AS DOUBLE) AS net_revenue, average_order_value, refund_rate, return_rate, repeat_customer_rate, stockout_rate,
  active_customers, support_contact_rate FROM kpi_day"""

_O360_COLUMNS = [
    "order_id", "customer_id", "order_date", "sales_channel", "store_id", "gross_merchandise_value", "discount_amount",
    "shipping_revenue", "captured_payment_amount", "refunded_amount", "net_revenue", "item_count", "unit_quantity",
    "order_status", "payment_status", "return_status", "promotion_count", "first_order_flag",
]
_MEASURES = [
    "gross_merchandise_value", "discount_amount", "shipping_revenue", "captured_payment_amount", "refunded_amount",
    "net_revenue", "item_count", "unit_quantity", "promotion_count",
]


def _quartile(c: str, p: float) -> str:
    """Linear interpolation between the two neighbouring ranks, written out."""
    at = f"({p} * (n - 1))"
    pick = f"max(CASE WHEN rn = {{}} THEN CAST({c} AS DOUBLE) END)"
    lo, hi = pick.format(f"CAST(floor({at}) AS BIGINT)"), pick.format(f"CAST(ceil({at}) AS BIGINT)")
    return f"{lo} + ({hi} - {lo}) * max({at} - floor({at}))"


_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS metric, count({c}) AS count, {_mean(c)} AS mean,
  round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev,
  CAST(min({c}) AS DOUBLE) AS min, {_quartile(c, 0.25)} AS q25, {_quartile(c, 0.5)} AS q50, {_quartile(c, 0.75)} AS q75, CAST(max({c}) AS DOUBLE) AS max
FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS rn, count(*) OVER () AS n FROM o360 WHERE {c} IS NOT NULL)"""
    for c in _MEASURES
)
_TABLES = {
    "orders": "r_orders", "order_items": "r_order_items", "order_promotions": "r_order_promotions", "customers": "r_customers",
    "products": "r_products", "product_categories": "r_product_categories", "payment_events": "r_payment_events",
    "refund_events": "r_refund_events", "return_events": "r_return_events", "support_events": "r_support_events",
    "web_events": "r_web_events", "inventory_snapshots": "r_inventory_snapshots", "campaign_spend": "r_campaign_spend",
}
_COLUMN_TYPES = {
    "orders": [("order_id", "string"), ("customer_id", "string"), ("sales_channel", "string"), ("store_id", "string"), ("status", "string"),
               ("ordered_at_utc", "timestamp_ntz"), ("updated_at_utc", "timestamp_ntz"), ("ingested_at_utc", "timestamp_ntz"),
               ("shipping_revenue", "decimal(14,2)"), ("source_row_id", "string")],
    "order_items": [("order_item_id", "string"), ("order_id", "string"), ("product_id", "string"), ("quantity", "bigint"),
                    ("unit_price", "decimal(14,2)"), ("item_discount_amount", "decimal(14,2)"), ("source_row_id", "string")],
    "payment_events": [("event_id", "string"), ("event_type", "string"), ("occurred_at_utc", "timestamp_ntz"), ("order_id", "string"),
                       ("payment_id", "string"), ("amount", "decimal(14,2)")],
    "refund_events": [("event_id", "string"), ("event_type", "string"), ("occurred_at_utc", "timestamp_ntz"),
                      ("ingested_at_utc", "timestamp_ntz"), ("order_id", "string"), ("refund_id", "string"), ("amount", "decimal(14,2)")],
    "return_events": [("event_id", "string"), ("event_type", "string"), ("occurred_at_utc", "timestamp_ntz"),
                      ("ingested_at_utc", "timestamp_ntz"), ("order_id", "string"), ("return_id", "string")],
}
_INVENTORY = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {i} AS position, '{n}' AS column_name, '{k}' AS data_type, count(*) - count({n}) AS null_count FROM r_{t}"
    for t, cols in _COLUMN_TYPES.items() for i, (n, k) in enumerate(cols, 1)
)
_PROFILED = [("customer_id", "categorical"), ("metric_date", "date"), ("order_count", "numeric"), ("support_contacts", "numeric"),
             ("active_channel", "categorical"), ("new_customer_flag", "categorical")]
_COLUMN_PROFILE = " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count(*) AS row_count, count({n}) AS value_count, count(DISTINCT {n}) AS distinct_count, '{k}' AS column_class FROM cust_day"
    for n, k in _PROFILED
)
_RICH = "gross_revenue discount_amount shipping_revenue refund_amount net_revenue captured_payment_amount".split()
_CAMPAIGN_TOTALS = """SELECT campaign_id, sum(campaign_spend) AS spend, sum(net_revenue) AS net_revenue,
  CAST(sum(net_revenue) AS DOUBLE) / CAST(nullif(sum(campaign_spend), 0) AS DOUBLE) AS roas FROM camp_day GROUP BY campaign_id"""

_NOT_LANDED = [
    *[f"events/{x}_events.json" for x in ("payment", "refund", "return", "support", "web")], "inventory/inventory_snapshots.csv",
    *[f"operational/{x}.json" for x in ("customer_addresses", "customer_profiles", "order_items", "order_promotions", "orders", "product_categories", "promotions",
                                        "sales_channels", "stores")],
]

_REFERENCES = [
    ("order_items order_promotions payment_events refund_events return_events support_events web_events", "order_id", "SELECT order_id FROM r_orders"),
    ("orders customer_profiles support_events web_events", "customer_id", "SELECT customer_id FROM r_customers"),
    ("order_items product_categories inventory_snapshots", "product_id", "SELECT product_id FROM r_products"),
    ("customers customer_profiles", "city_id", "SELECT CAST(n_nationkey AS VARCHAR) FROM nation"),
]

ANSWERS = {
    "order_360": "SELECT * FROM o360",
    "orders_dedup": "SELECT * FROM latest_orders",
    "order_items_summary": "SELECT * FROM items_by_order",
    "payment_events_dedup": "SELECT * FROM pay_once",
    "captured_payments": "SELECT * FROM captures",
    "payment_status": "SELECT * FROM pay_latest",
    "payment_status_precedence": """SELECT order_id, list_extract(['PAYMENT_AUTHORIZED', 'PAYMENT_FAILED', 'PAYMENT_CAPTURED'],
  max(list_position(['PAYMENT_AUTHORIZED', 'PAYMENT_FAILED', 'PAYMENT_CAPTURED'], event_type))) AS payment_status FROM r_payment_events GROUP BY ALL""",
    "payment_status_precedence_alt": "SELECT * FROM pay_alt",
    "refund_dedup_max": "SELECT * FROM refund_max",
    "refunds_by_order": "SELECT * FROM refund_totals",
    "return_status": "SELECT * FROM return_latest",
    "order_promo_count": "SELECT * FROM promos_by_order",
    "customer_order_rank": "SELECT * FROM order_ranks",
    "customer_daily": "SELECT * FROM cust_day",
    "active_channel": "SELECT * FROM channel_of_day",
    "support_contacts_daily": "SELECT * FROM contacts",
    "support_tickets_daily": """SELECT customer_id, CAST(occurred_at_utc AS DATE) AS metric_date, count(DISTINCT ticket_id) AS support_contacts
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at_utc DESC, occurred_at_utc DESC, ticket_id) AS rn FROM r_support_events) WHERE rn = 1
GROUP BY customer_id, CAST(occurred_at_utc AS DATE)""",
    "product_daily": "SELECT * FROM prod_day",
    "product_daily_as_first_written": """SELECT prod_measures.*, category_name AS active_category FROM prod_measures LEFT JOIN category_stock_day USING (product_id, metric_date)""",
    "product_sales_daily": "SELECT * FROM sales_day",
    "product_inventory_daily": "SELECT * FROM stock_day",
    "product_promo_daily": "SELECT * FROM promo_day",
    "product_refund_units_daily": "SELECT * FROM refund_units_day",
    "product_discount_daily": "SELECT * FROM discount_day",
    "product_refund_daily": "SELECT * FROM refund_value_day",
    "product_grid": "SELECT * FROM grid_day",
    "category_versions": "SELECT * FROM versions",
    "category_asof_day": "SELECT * FROM category_day",
    "category_asof_day_as_first_written": "SELECT * FROM category_stock_day",
    "last_line_under_way": """SELECT flag AS return_flag, day AS first_day, until_day, best.line // 8 AS l_orderkey, CAST(best.line % 8 AS INTEGER) AS l_linenumber
FROM (
  SELECT d.flag, d.day, any_value(d.until_day) AS until_day, max({'ordered': u.ordered_at, 'line': u.line}) AS best
  FROM (SELECT flag, day, lead(day) OVER (PARTITION BY flag ORDER BY day) AS until_day
        FROM (SELECT DISTINCT flag, day FROM under_way, unnest([CAST(ordered_at AS DATE), shipped]) AS t(day) WHERE day IS NOT NULL)) d
  JOIN under_way u ON u.flag = d.flag AND CAST(u.ordered_at AS DATE) <= d.day AND (u.shipped IS NULL OR d.day < u.shipped)
  GROUP BY d.flag, d.day)""",
    "category_asof_order": """SELECT oi.order_id, oi.product_id, o.ordered_at_utc AS order_date, c.category_name, count(*) AS joined_rows
FROM r_order_items oi JOIN r_orders o ON o.order_id = oi.order_id
LEFT JOIN r_product_categories c ON c.product_id = oi.product_id AND o.ordered_at_utc >= c.valid_from_utc AND o.ordered_at_utc <= c.valid_to_utc
GROUP BY oi.order_id, oi.product_id, o.ordered_at_utc, c.category_name""",
    "category_match_counts": """SELECT order_id, product_id, CAST(sum(greatest(hits, 1)) AS BIGINT) AS category_matches FROM (
  SELECT oi.order_id, oi.product_id, (SELECT count(*) FROM r_product_categories c
    WHERE c.product_id = oi.product_id AND o.ordered_at_utc BETWEEN c.valid_from_utc AND c.valid_to_utc) AS hits
  FROM r_order_items oi JOIN r_orders o USING (order_id)) GROUP BY ALL HAVING category_matches > 1""",
    "channel_campaign_daily": "SELECT * FROM camp_day",
    "campaign_touches": "SELECT * FROM touches",
    "last_touch_attribution": "SELECT * FROM last_touch",
    "attributed_daily": "SELECT * FROM attributed",
    "campaign_spend_daily": "SELECT * FROM spend_day",
    "campaign_sessions_daily": "SELECT * FROM session_day",
    "campaign_grid": "SELECT * FROM grid_campaign",
    "executive_kpis_daily": "SELECT * FROM kpi_day",
    "order_kpis_daily": "SELECT * FROM kpi_orders",
    "customer_kpis_daily": "SELECT * FROM kpi_customers",
    "stockout_rate_daily": "SELECT * FROM kpi_stock",
    "order_enriched": "SELECT * FROM order_rich",
    "customer_daily_extended": "SELECT * FROM cust_day_wide",
    "refund_events_by_id": "SELECT * FROM refund_by_event",
    "refund_correction": """SELECT order_id, gross_merchandise_value, discount_amount, shipping_revenue, refunded_amount, net_revenue FROM o360""",
    "payment_correction": """SELECT order_rich.* REPLACE (ifnull(captures_corrected.captured_payment_amount, 0) AS captured_payment_amount,
  if(captures_corrected.captured_payment_amount > 0, 'PAYMENT_CAPTURED', 'PAYMENT_AUTHORIZED') AS payment_status)
FROM order_rich LEFT JOIN captures_corrected USING (order_id)""",
    "corrected_captures": "SELECT * FROM captures_corrected",
    "return_count_by_order": "SELECT * FROM returns_counted",
    # questions
    "q01_net_revenue_by_channel": "SELECT sales_channel, sum(net_revenue) AS net_revenue FROM o360 GROUP BY sales_channel",
    "q02_refund_rate_by_channel": f"SELECT sales_channel, {_share('refunded_amount > 0')} AS refund_rate FROM o360 GROUP BY sales_channel",
    "q03_orders_per_day": "SELECT order_date, count(*) AS total_orders FROM o360 GROUP BY order_date",
    "q04_aov_by_channel": f"SELECT sales_channel, {_mean('net_revenue')} AS average_order_value FROM o360 GROUP BY sales_channel",
    "q05_stockouts": "SELECT product_id, metric_date FROM prod_day WHERE stockout_flag IS TRUE",
    "q06_revenue_by_category": "SELECT active_category, sum(net_revenue) AS net_revenue FROM prod_day GROUP BY active_category",
    "q07_active_customers": "SELECT metric_date, count(DISTINCT customer_id) AS active_customers FROM cust_day WHERE order_count > 0 GROUP BY metric_date",
    "q08_repeat_rate": f"SELECT metric_date, {_share('repeat_customer_flag')} AS repeat_customer_rate FROM cust_day GROUP BY metric_date",
    "q09_roas": f"SELECT campaign_id, roas FROM ({_CAMPAIGN_TOTALS}) WHERE spend > 0",
    "q10_channel_campaign_orders": "SELECT sales_channel, campaign_id, CAST(sum(attributed_orders) AS BIGINT) AS orders FROM camp_day GROUP BY sales_channel, campaign_id",
    "q11_daily_net_revenue": _daily("net_revenue"),
    "q12_daily_refund_rate": _daily("refund_rate"),
    "q13_daily_return_rate": _daily("return_rate"),
    "q14_daily_stockout_rate": _daily("stockout_rate"),
    "q15_fully_refunded": "SELECT order_id, refunded_amount, net_revenue FROM o360 WHERE refunded_amount > 0 AND net_revenue <= 0",
    "q16_customer_net_revenue": "SELECT customer_id, sum(net_revenue) AS net_revenue FROM cust_day GROUP BY customer_id",
    "q17_support_customers": "SELECT customer_id, CAST(sum(support_contacts) AS BIGINT) AS support_contacts FROM cust_day WHERE support_contacts > 0 GROUP BY customer_id",
    "q18_category_refund": "SELECT active_category, sum(gross_revenue - net_revenue) AS refund_amount FROM prod_day GROUP BY active_category",
    "q19_campaign_spend": "SELECT campaign_id, sum(campaign_spend) AS campaign_spend FROM camp_day GROUP BY campaign_id",
    "q20_busiest_days": _daily("total_orders"),
    "q21_units_sold": "SELECT product_id, CAST(sum(units_sold) AS BIGINT) AS units_sold FROM prod_day GROUP BY product_id",
    "q22_captured_per_day": "SELECT order_date, sum(captured_payment_amount) AS captured_payment_amount FROM o360 GROUP BY order_date",
    "q23_refund_per_day": "SELECT order_date, sum(refunded_amount) AS refunded_amount FROM o360 GROUP BY order_date",
    "q24_repeat_by_channel": "SELECT active_channel, count(DISTINCT customer_id) AS repeat_customers FROM cust_day WHERE repeat_customer_flag GROUP BY active_channel",
    "q25_last_refresh": "SELECT max(data_freshness_utc) AS last_refresh_utc FROM (SELECT *, TIMESTAMP '2002-01-01' AS data_freshness_utc FROM kpi_day)",
    "dash_executive": "SELECT * FROM kpi_day",
    "dash_channel": f"SELECT sales_channel, sum(net_revenue) AS net_revenue, {_share('refunded_amount > 0')} AS refund_rate FROM o360 GROUP BY sales_channel",
    "dash_campaign_roas": _CAMPAIGN_TOTALS,
    "dash_stockout": "SELECT * FROM kpi_stock",
    "capped_result": "SELECT customer_id, sum(net_revenue) AS net_revenue FROM cust_day GROUP BY customer_id ORDER BY net_revenue DESC NULLS LAST, customer_id LIMIT 100",
    "json_friendly_rows": _KPI_JSON,
    # checks
    "grain_order_360": _grain("o360_faulty", "order_id", "order_id IS NULL"),
    "grain_customer_daily": _grain("cust_day", "customer_id, metric_date",
                                   "customer_id IS NULL OR metric_date IS NULL OR order_count IS NULL OR gross_revenue IS NULL OR net_revenue IS NULL"),
    "grain_product_daily": _grain("prod_day", "product_id, metric_date", "product_id IS NULL OR metric_date IS NULL"),
    "grain_channel_campaign_daily": _grain("camp_day", "metric_date, sales_channel, campaign_id",
                                           "metric_date IS NULL OR sales_channel IS NULL OR campaign_id IS NULL"),
    "grain_executive_daily": _grain("kpi_day", "metric_date", "metric_date IS NULL"),
    "null_counts_order_360": "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in _O360_COLUMNS) + " FROM o360",
    "layer_row_counts": " UNION ALL ".join(f"SELECT '{k}' AS table_name, count(*) AS row_count FROM {v}" for k, v in _TABLES.items()),
    "schema_inventory": _INVENTORY,
    "column_profile": _COLUMN_PROFILE,
    "order_numeric_profile": _PROFILE,
    "net_revenue_mismatch": """SELECT count(*) AS mismatch_count FROM o360_faulty
WHERE net_revenue <> gross_merchandise_value - discount_amount + shipping_revenue - refunded_amount""",
    "payment_anomalies": "SELECT * FROM anomalies",
    "payments_of_anomalies": """SELECT order_id, event_id, event_type, amount AS payment_amount, occurred_at_utc FROM r_payment_events
WHERE order_id IN (SELECT order_id FROM anomalies)""",
    "payment_status_split": """SELECT payment_status, count(*) AS total_orders, count(*) FILTER (WHERE captured_payment_amount > 0) AS orders_with_payment,
  count(*) FILTER (WHERE captured_payment_amount = 0) AS orders_without_payment FROM o360 GROUP BY payment_status""",
    "payment_amount_by_status": f"""SELECT payment_status, count(captured_payment_amount) AS n, min(captured_payment_amount) AS smallest,
  max(captured_payment_amount) AS largest, {_mean('captured_payment_amount')} AS average FROM o360 GROUP BY payment_status""",
    "negative_refunds": "SELECT count(*) AS negative_refund_orders FROM o360_faulty WHERE refunded_amount < 0",
    "negative_net_orders": "SELECT * FROM negative_orders",
    "negative_net_by_return": "SELECT return_status, refund_exceeds_revenue, count(*) AS orders FROM negative_orders GROUP BY return_status, refund_exceeds_revenue",
    "neg_orders_with_refund": "SELECT order_id, net_revenue FROM negative_orders WHERE order_id IN (SELECT order_id FROM r_refund_events)",
    "neg_orders_without_refund": "SELECT order_id, net_revenue FROM negative_orders WHERE order_id NOT IN (SELECT order_id FROM r_refund_events)",
    "negative_order_refund_events": """SELECT order_id, count(*) AS refund_event_count, sum(amount) AS silver_refunded_amount,
  string_agg(event_type, ', ' ORDER BY occurred_at_utc, event_id, event_type) AS refund_events
FROM r_refund_events WHERE order_id IN (SELECT order_id FROM negative_orders) GROUP BY order_id""",
    "cancelled_but_captured": """SELECT order_id, customer_id, captured_payment_amount, payment_status FROM o360
WHERE order_status = 'CANCELLED' AND captured_payment_amount > 0""",
    "return_status_mismatch": """SELECT count(*) AS orders_with_return, count(*) FILTER (WHERE l.return_status <> coalesce(o.return_status, 'NO_RETURN')) AS mismatch_count
FROM return_latest l LEFT JOIN o360 o ON o.order_id = l.order_id""",
    "first_order_check": """SELECT count(*) AS total_orders, count(DISTINCT customer_id) AS unique_customers, count_if(customer_order_rank = 1) AS first_orders,
  count_if(first_order_flag IS DISTINCT FROM (customer_order_rank = 1)) AS first_order_mismatch FROM o360 JOIN order_ranks USING (order_id, customer_id)""",
    "refund_total_recon": """SELECT s.t AS silver_refund_total, g.t AS gold_refund_total, s.t - g.t AS difference
FROM (SELECT sum(amount) AS t FROM refund_max) s CROSS JOIN (SELECT sum(refunded_amount) AS t FROM o360) g""",
    "refund_recon_by_id": """SELECT s.t AS deduplicated_refund_total, g.t AS enriched_refund_total, s.t - g.t AS difference
FROM (SELECT sum(amount) AS t FROM refund_by_refund) s CROSS JOIN (SELECT sum(refund_amount) AS t FROM order_rich) g""",
    "refund_raw_vs_dedup": """SELECT r.order_id, r.t AS raw_refunded_amount, d.refunded_amount AS deduplicated_refunded_amount, r.t - d.refunded_amount AS difference
FROM (SELECT order_id, sum(amount) AS t FROM r_refund_events WHERE event_type = 'REFUND_COMPLETED' GROUP BY order_id) r
JOIN refund_totals d ON d.order_id = r.order_id WHERE r.t <> d.refunded_amount""",
    "refund_duplicates": """SELECT refund_id, order_id, event_type, amount, occurred_at_utc, count(*) AS duplicate_count FROM r_refund_events
WHERE event_type = 'REFUND_COMPLETED' GROUP BY refund_id, order_id, event_type, amount, occurred_at_utc HAVING count(*) > 1""",
    "refund_duplicate_impact": """SELECT sum(amount) - sum(if(first_copy, amount, 0)) AS duplicate_amount FROM (
  SELECT amount, row_number() OVER (PARTITION BY refund_id, order_id, amount, occurred_at_utc) = 1 AS first_copy FROM refund_done)""",
    "payment_recon_silver": """SELECT order_id, captured_payment_amount, silver_captured_payment, captured_payment_amount - silver_captured_payment AS difference FROM (
  SELECT order_id, max(gold) AS captured_payment_amount, ifnull(sum(silver), 0) AS silver_captured_payment FROM (
    SELECT order_id, captured_payment_amount AS gold FROM o360
    UNION ALL BY NAME SELECT order_id, amount AS silver FROM pay_once WHERE event_type = 'PAYMENT_CAPTURED') GROUP BY ALL) WHERE difference <> 0""",
    "payment_recon_silver_raw": """SELECT order_id, captured_payment_amount, silver_captured_payment, captured_payment_amount - silver_captured_payment AS difference FROM (
  SELECT order_id, max(gold) AS captured_payment_amount, ifnull(sum(silver), 0) AS silver_captured_payment FROM (
    SELECT order_id, captured_payment_amount AS gold FROM o360
    UNION ALL BY NAME SELECT order_id, amount AS silver FROM r_payment_events WHERE event_type = 'PAYMENT_CAPTURED') GROUP BY ALL) WHERE difference <> 0""",
    "multi_capture_orders": """SELECT order_id, count(*) AS captured_event_count, sum(amount) AS captured_amount FROM r_payment_events
WHERE event_type = 'PAYMENT_CAPTURED' GROUP BY order_id HAVING count(*) > 1""",
    "multi_refund_orders": """SELECT order_id, count(DISTINCT refund_id) AS refund_count, sum(amount) AS refunded_amount FROM r_refund_events
WHERE event_type = 'REFUND_COMPLETED' GROUP BY order_id HAVING count(DISTINCT refund_id) > 1""",
    "return_event_path": """SELECT order_id, count(*) AS return_event_count, string_agg(event_type, ', ' ORDER BY occurred_at_utc, event_id, event_type) AS return_events
FROM r_return_events GROUP BY order_id""",
    "payment_event_set": """SELECT order_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS payment_events FROM r_payment_events GROUP BY order_id""",
    "event_type_counts": """SELECT 'payment' AS source, event_type, count(*) AS event_count FROM r_payment_events GROUP BY event_type
UNION ALL SELECT 'refund', event_type, count(*) FROM r_refund_events GROUP BY event_type
UNION ALL SELECT 'return', event_type, count(*) FROM r_return_events GROUP BY event_type""",
    "event_trace": """SELECT * FROM (
  SELECT order_id, 'payment' AS source, event_id, event_type, occurred_at_utc, amount FROM r_payment_events
  UNION ALL SELECT order_id, 'refund', event_id, event_type, occurred_at_utc, amount FROM r_refund_events
  UNION ALL SELECT order_id, 'return', event_id, event_type, occurred_at_utc, CAST(NULL AS DECIMAL(14,2)) FROM r_return_events)
WHERE order_id IN (SELECT order_id FROM negative_orders)""",
    "order_vs_customer_totals": """SELECT * FROM (SELECT count(*) AS total_orders, sum(gross_merchandise_value) AS total_gross_revenue, sum(discount_amount) AS total_discount,
  sum(shipping_revenue) AS total_shipping_revenue, sum(refunded_amount) AS total_refund, sum(net_revenue) AS total_net_revenue,
  sum(captured_payment_amount) AS total_captured_payment FROM o360) a
CROSS JOIN (SELECT count(*) AS total_customer_daily_rows, sum(gross_revenue) AS total_gross_revenue_daily, sum(discount_amount) AS total_discount_daily,
  sum(shipping_revenue) AS total_shipping_revenue_daily, sum(refund_amount) AS total_refund_daily, sum(net_revenue) AS total_net_revenue_daily,
  sum(captured_payment_amount) AS total_captured_payment_daily FROM cust_day_wide) b""",
    "top_payment_diffs": """SELECT order_id, order_360_payment, customer_daily_payment, order_360_payment - customer_daily_payment AS difference FROM (
  SELECT order_id, o360.captured_payment_amount AS order_360_payment, cust_day_wide.captured_payment_amount AS customer_daily_payment
  FROM o360 JOIN cust_day_wide ON cust_day_wide.customer_id = o360.customer_id AND metric_date = order_date)
WHERE difference <> 0""",
    "payment_recon_customer_day": """SELECT customer_id, metric_date, sum(a) AS order_360_payment, sum(b) AS customer_daily_payment, sum(a) - sum(b) AS difference FROM (
  SELECT customer_id, order_date AS metric_date, captured_payment_amount AS a, 0 AS b FROM o360 UNION ALL SELECT customer_id, metric_date, 0, captured_payment_amount FROM cust_day_wide) GROUP BY ALL HAVING difference <> 0""",
    "payment_recon_day": """SELECT metric_date, sum(a) AS order_360_payment, sum(b) AS customer_daily_payment, sum(a) - sum(b) AS difference FROM (
  SELECT order_date AS metric_date, captured_payment_amount AS a, 0 AS b FROM o360 UNION ALL SELECT metric_date, 0, captured_payment_amount FROM cust_day_wide) GROUP BY ALL""",
    "payment_recon_order": """SELECT order_id, sum(a) AS captured_payment_enriched, sum(b) AS captured_payment_gold, sum(a) - sum(b) AS difference FROM (
  SELECT order_id, ifnull(captured_payment_amount, 0) AS a, 0 AS b FROM order_rich UNION ALL SELECT order_id, 0, captured_payment_amount FROM o360)
GROUP BY ALL HAVING difference <> 0""",
    "customer_daily_rules": """SELECT count(*) FILTER (WHERE order_count <= 0) AS order_count_not_positive, count(*) FILTER (WHERE gross_revenue < 0) AS negative_gross_revenue,
  count(*) FILTER (WHERE net_revenue < 0) AS negative_net_revenue, count(*) FILTER (WHERE refund_amount < 0) AS negative_refund,
  count(*) FILTER (WHERE return_count < 0) AS negative_return_count,
  count(*) FILTER (WHERE new_customer_order_count + repeat_customer_order_count <> order_count) AS flag_sum_mismatch,
  count(*) FILTER (WHERE customer_id IS NULL OR metric_date IS NULL OR order_count IS NULL OR gross_revenue IS NULL OR net_revenue IS NULL) AS null_rows
FROM cust_day_wide""",
    "customer_flag_mismatch": "SELECT count(*) AS customer_flag_mismatch FROM order_rich_faulty WHERE new_customer_flag = repeat_customer_flag",
    "return_count_mismatch": "SELECT count(*) AS return_inconsistency FROM order_rich_faulty WHERE (return_count > 0) <> (return_status <> 'NO_RETURN')",
    "multi_order_days": "SELECT customer_id, metric_date, order_count, gross_revenue, net_revenue FROM cust_day WHERE order_count > 1",
    "business_summary": """SELECT count(DISTINCT customer_id) AS unique_customers, count(*) AS orders, count(*) FILTER (WHERE new_customer_flag) AS new_customer_orders,
  count(*) FILTER (WHERE repeat_customer_flag) AS repeat_customer_orders, count(*) FILTER (WHERE refund_amount > 0) AS orders_with_refund,
  count(*) FILTER (WHERE return_count > 0) AS orders_with_return, """ + ", ".join(f"sum({c}) AS total_{c}" for c in _RICH) + " FROM order_rich",
    "orders_store_coverage": """SELECT sales_channel, count(*) AS total_orders, count(store_id) AS orders_with_store, count(*) - count(store_id) AS orders_without_store
FROM r_orders GROUP BY sales_channel""",
    "order_row_counts_top": "SELECT order_id, count(*) AS row_count FROM r_orders GROUP BY order_id ORDER BY row_count DESC, order_id LIMIT 10",
    "orders_in_list": "SELECT order_id, status FROM latest_orders WHERE status IN ('COMPLETED', 'RETURNED', 'CANCELLED')",
    "orders_with_customer": """SELECT o.order_id, o.customer_id, c.city_id, c.customer_segment FROM latest_orders o LEFT JOIN r_customers c ON c.customer_id = o.customer_id""",
    "duplicate_orders": "SELECT order_id, count(*) AS row_count FROM r_orders GROUP BY order_id HAVING count(*) > 1",
    "duplicate_customers": "SELECT customer_id, count(*) AS row_count FROM r_customer_profiles GROUP BY customer_id HAVING count(*) > 1",
    "duplicate_categories": "SELECT product_id, count(*) AS row_count FROM r_product_categories GROUP BY product_id HAVING count(*) > 1",
    "missing_snapshots": """SELECT product_id, CAST(day + INTERVAL '1' DAY AS DATE) AS gap_start, CAST(next_day - INTERVAL '1' DAY AS DATE) AS gap_end,
  CAST(next_day - day - 1 AS INT) AS missing_days
FROM (SELECT product_id, day, lead(day) OVER (PARTITION BY product_id ORDER BY day) AS next_day
  FROM (SELECT DISTINCT product_id, CAST(snapshot_date AS DATE) AS day FROM r_inventory_snapshots)) WHERE next_day - day > 1""",
    # bronze, silver and streaming
    "bronze_json_array": "SELECT event_id, event_type, occurred_at_utc, order_id, return_id, true AS numbered FROM r_return_events",
    "bronze_array_split": "SELECT event_id, event_type, occurred_at_utc, order_id, return_id, true AS numbered FROM r_return_events",
    "bronze_csv_by_name": """SELECT spend_date, campaign_id, channel, spend_amount, concat('line one', chr(10), 'of "', campaign_id, '"') AS note FROM r_campaign_spend""",
    "bronze_json_scan": "SELECT event_id, event_type, occurred_at_utc, order_id, return_id FROM r_return_events",
    "bronze_csv_scan": "SELECT * FROM r_campaign_spend",
    "bronze_raw_payload": """SELECT concat('{"order_id":"', order_id, '","promotion_id":"', promotion_id, '","discount_amount":',
  CAST(discount_amount AS VARCHAR), '}') AS raw FROM r_order_promotions""",
    "bronze_lineage": """SELECT order_item_id AS record_id, sha256(concat('{"order_item_id":"', order_item_id, '","order_id":"', order_id,
  '","product_id":"', product_id, '","quantity":', CAST(quantity AS VARCHAR), ',"unit_price":', CAST(unit_price AS VARCHAR),
  ',"item_discount_amount":', CAST(item_discount_amount AS VARCHAR), ',"source_row_id":"', source_row_id, '"}')) AS record_sha,
  'check' AS run_id, TRUE AS has_file, true AS has_number FROM r_order_items""",
    # the feeds that were not landed, and those whose checksums the manifest misstates
    "raw_files_missing": "SELECT path, regexp_extract(path, '/([a-z_]+)[.]', 1) AS source FROM (VALUES " + ", ".join(f"('{x}')" for x in _NOT_LANDED) + ") AS t(path)",
    "manifest_check": "SELECT * FROM (VALUES ('campaign_spend', 'ok'), ('city_reference', 'ok'), ('customers', 'ok'), ('lost', 'missing'), ('products', 'changed')) AS t(feed, status)",
    # digests of a month's rows, in blocks of 64 lines, as they should be and as they were landed
    "manifest_tree": """SELECT * FROM (WITH line AS (SELECT strftime(ordered_at_utc, '%Y-%m') AS file, row_number() OVER (PARTITION BY strftime(ordered_at_utc, '%Y-%m') ORDER BY order_id::BIGINT) - 1 AS n,
  concat('{"order_id":"', order_id, '","status":"', status, '","shipping_revenue":', shipping_revenue, '}') AS v FROM latest_orders),
m AS (SELECT *, file[1:4]::INT * 12 + file[6:7]::INT AS mo FROM line),
landed AS (SELECT file, n, CASE WHEN mo % 7 = 1 AND n = 0 THEN '{}' ELSE v END AS v FROM m WHERE mo % 11 <> 2 UNION ALL SELECT 'extra-' || file, n, v FROM m WHERE mo % 13 = 3),
found AS (SELECT file, sum(c)::BIGINT AS found_lines, sha256(string_agg(d, '' ORDER BY b)) AS found_digest
  FROM (SELECT file, n // 64 AS b, count(*) AS c, sha256(string_agg(sha256(v), '' ORDER BY n)) AS d FROM landed GROUP BY ALL) GROUP BY file)
SELECT file, CASE WHEN found_lines IS NULL THEN 'missing' WHEN file LIKE 'extra-%' THEN 'unlisted' WHEN mo % 7 = 1 THEN 'changed' ELSE 'ok' END AS status, found_lines, found_digest
FROM (SELECT DISTINCT file, mo FROM m) FULL JOIN found USING (file))""",
    "ops_runs": """SELECT 'check' AS run_id, 'orders' AS stage, 'ok' AS status, count(*) AS row_count FROM r_orders
UNION ALL SELECT 'check', 'order_items', 'ok', count(*) FROM r_order_items
UNION ALL SELECT 'check', 'payment_events', 'ok', count(*) FROM r_payment_events""",
    "silver_flatten": """SELECT event_id, event_type, strftime(occurred_at_utc, '%Y-%m-%dT%H:%M:%SZ') AS occurred_at_utc, order_id, payment_id, amount FROM r_payment_events""",
    "silver_flatten_any": """SELECT event_id, event_type, strftime(occurred_at_utc, '%Y-%m-%dT%H:%M:%SZ') AS occurred_at_utc, j->>'$.payload.order_id' AS payload__order_id,
  j->>'$.payload.payment_id' AS payload__payment_id, CAST(j->>'$.payload.amount' AS DECIMAL(14,2)) AS payload__amount, j->>'$.device.os' AS device__os,
  CAST(j->>'$.device.app.version' AS BIGINT) AS device__app__version, j->>'$.device.app.tags' AS device__app__tags, j->>'$.note' AS note
FROM (SELECT event_id, event_type, occurred_at_utc, CAST(regexp_extract(payment_id, '[0-9]+') AS BIGINT) AS k, to_json({'payload': {'order_id': order_id, 'payment_id': payment_id, 'amount': amount},
  'device': CASE WHEN k % 3 = 0 THEN {'os': concat('os', k % 4), 'app': {'version': k % 5, 'tags': ['a', k::VARCHAR]}} END, 'note': CASE WHEN k % 5 = 0 THEN 'a "note" {' END}) AS j FROM r_payment_events)""",
    "silver_key_drift": """SELECT path, kind, count(*) FILTER (json_extract(j, '$.' || path) IS NOT NULL AND json_type(j, '$.' || path) <> 'NULL') AS record_count, false AS declared
FROM (SELECT event_id, event_type, occurred_at_utc, CAST(regexp_extract(payment_id, '[0-9]+') AS BIGINT) AS k, to_json({'payload': {'order_id': order_id, 'payment_id': payment_id, 'amount': amount},
  'device': CASE WHEN k % 3 = 0 THEN {'os': concat('os', k % 4), 'app': {'version': k % 5, 'tags': ['a', k::VARCHAR]}} END, 'note': CASE WHEN k % 5 = 0 THEN 'a "note" {' END}) AS j FROM r_payment_events), (VALUES ('device.os', 'string'), ('device.app.version', 'bigint'), ('device.app.tags', 'json'), ('note', 'string')) AS t(path, kind) GROUP BY path, kind""",
    "silver_payment_events": "SELECT DISTINCT event_id, event_type, occurred_at_utc, order_id, payment_id, amount FROM r_payment_events",
    "silver_utc": """SELECT source_row_id, t AS ordered_at_utc, CAST(t AS DATE) AS order_date FROM (
  SELECT source_row_id, CASE status WHEN 'COMPLETED' THEN ordered_at_utc - INTERVAL '7' HOUR WHEN 'CANCELLED' THEN ordered_at_utc + INTERVAL '5' HOUR
    ELSE ordered_at_utc END AS t FROM r_orders)""",
    "silver_status_norm": "SELECT source_row_id, status FROM r_orders",
    "silver_rejects": """SELECT 'order_items' AS table_name, order_item_id AS record_id, 'negative_quantity' AS reason FROM r_order_items WHERE quantity < 0
UNION ALL SELECT 'order_items', order_item_id, 'unknown_order_id' FROM r_order_items
  WHERE order_id NOT IN (SELECT order_id FROM r_orders WHERE customer_id IN (SELECT customer_id FROM r_customers))
UNION ALL SELECT 'order_items', order_item_id, 'unknown_product_id' FROM r_order_items WHERE product_id NOT IN (SELECT product_id FROM r_products)""",
    "silver_orphans": """SELECT customer_id, count(*) AS row_count FROM r_orders WHERE customer_id NOT IN (SELECT customer_id FROM r_customers) GROUP BY customer_id""",
    "silver_orphans_all": "\nUNION ALL ".join(
        f"SELECT '{feed}' AS feed, '{column}' AS column_name, {column} AS key, count(*) AS row_count FROM r_{feed} "
        f"WHERE {column} IS NOT NULL AND {column} NOT IN ({known}) GROUP BY {column}"
        for feeds, column, known in _REFERENCES for feed in feeds.split()),
    "silver_clean_items": "SELECT * FROM items_clean",
    "silver_clean_items_summary": """SELECT order_id, count(DISTINCT order_item_id) AS item_count, CAST(sum(quantity) AS BIGINT) AS unit_quantity,
  sum(quantity * unit_price) AS gross_merchandise_value, sum(item_discount_amount) AS discount_amount FROM items_clean GROUP BY order_id""",
    "customer_version_at_order": """SELECT order_id, customer_id, ordered_at_utc, customer_segment FROM (
  SELECT o.order_id, o.customer_id, o.ordered_at_utc, p.customer_segment,
    row_number() OVER (PARTITION BY o.order_id ORDER BY p.valid_from_utc DESC NULLS LAST, p.source_row_id DESC NULLS LAST) AS rn
  FROM latest_orders o LEFT JOIN r_customer_profiles p ON p.customer_id = o.customer_id AND p.valid_from_utc <= o.ordered_at_utc
    AND (p.valid_to_utc IS NULL OR o.ordered_at_utc < p.valid_to_utc)) WHERE rn = 1""",
    "stream_event_dedup": "SELECT DISTINCT event_id, event_type, occurred_at_utc, order_id, payment_id, amount FROM r_payment_events",
    "stream_payment_status": "SELECT * FROM pay_latest",
    # a month is written again if an order, ticket, spend or web event of it came with the drop, or an order became or ceased to be a first one
    "gold_incremental": """SELECT * FROM (WITH came AS (SELECT order_id, try_cast(order_id AS BIGINT) AS k, date_trunc('month', ordered_at_utc)::DATE AS d, ordered_at_utc, customer_id FROM latest_orders),
firsts AS (SELECT min_by(order_id, (ordered_at_utc, order_id)) AS now, min_by(order_id, (ordered_at_utc, order_id)) FILTER (WHERE k % 9970 <> 5) AS before FROM came GROUP BY customer_id),
flips AS (SELECT now AS order_id FROM firsts WHERE now IS DISTINCT FROM before UNION SELECT before FROM firsts WHERE now IS DISTINCT FROM before),
order_days AS (SELECT d FROM came WHERE k % 9970 = 5 OR k % 5000 = 0 OR order_id IN (SELECT order_id FROM flips WHERE order_id IS NOT NULL)
  OR order_id IN (SELECT order_id FROM r_refund_events WHERE try_cast(order_id AS BIGINT) % 4990 = 3)),
ticket_days AS (SELECT date_trunc('month', occurred_at_utc)::DATE AS d FROM r_support_events WHERE try_cast(order_id AS BIGINT) % 9970 = 5 OR try_cast(order_id AS BIGINT) % 7010 = 2),
web AS (SELECT order_id, date_trunc('month', occurred_at_utc)::DATE AS d FROM r_web_events WHERE try_cast(order_id AS BIGINT) % 9970 = 5 OR try_cast(order_id AS BIGINT) % 8110 = 7),
web_days AS (SELECT d FROM web UNION SELECT d FROM came WHERE order_id IN (SELECT order_id FROM web)
  UNION SELECT date_trunc('month', spend_date)::DATE FROM r_campaign_spend WHERE campaign_id = 'CMP-8' AND spend_amount = 0 AND spend_date < DATE '1996-01-01')
SELECT 'order_360' AS table_name, order_date AS metric_date, count(*) AS row_count, sum(net_revenue) AS total, count_if(first_order_flag)::BIGINT AS counted,
  date_trunc('month', order_date) IN (SELECT d FROM order_days) AS written_again FROM o360 GROUP BY order_date
UNION ALL SELECT 'customer_daily', metric_date, count(*), sum(net_revenue), sum(support_contacts)::BIGINT,
  date_trunc('month', metric_date) IN (SELECT d FROM order_days UNION SELECT d FROM ticket_days) FROM cust_day GROUP BY metric_date
UNION ALL SELECT 'product_daily', metric_date, count(*), sum(net_revenue), sum(units_sold)::BIGINT, date_trunc('month', metric_date) IN (SELECT d FROM order_days) FROM prod_day GROUP BY metric_date
UNION ALL SELECT 'channel_campaign_daily', metric_date, count(*), sum(net_revenue), sum(attributed_customers)::BIGINT,
  date_trunc('month', metric_date) IN (SELECT d FROM order_days UNION SELECT d FROM web_days) FROM camp_day GROUP BY metric_date
UNION ALL SELECT 'executive_kpis_daily', metric_date, count(*), sum(net_revenue), sum(active_customers)::BIGINT,
  date_trunc('month', metric_date) IN (SELECT d FROM order_days UNION SELECT d FROM ticket_days) FROM kpi_day GROUP BY metric_date)""",
    # an event is late if the newest one of all earlier years was more than seven days younger when it first came
    "stream_late_events": """SELECT * FROM (WITH came AS (
  SELECT e.*, year(occurred_at_utc + to_days(d)) AS y FROM r_payment_events e
  JOIN (VALUES (0, 0), (0, 400), (1, 60), (2, 0)) AS t(k, d) ON k = least(CAST(regexp_extract(payment_id, '[0-9]+') AS BIGINT) % 20, 2)),
seen AS (SELECT y, max(max(occurred_at_utc)) OVER (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM came GROUP BY y)
SELECT event_id, event_type, occurred_at_utc, order_id, payment_id, amount, coalesce(occurred_at_utc < newest - INTERVAL 7 DAY, false) AS late
FROM (SELECT event_id, event_type, occurred_at_utc, order_id, payment_id, amount, min(y) AS y FROM came GROUP BY ALL) JOIN seen USING (y))""",
}
