"""Queries that need files: the star views are landed as raw feeds, then read back."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import canonical, utc
from ..operators.versions import version_at
from ..schemas import MONEY, SOURCES, STATUS_ALIASES, gold_contract
from ..sources import raw, tree_digest
from ..sources.scratch import scratch_path
from ..sources.tables import GoldTables, LayerStore, gold_parts, gold_table, ops_runs, published_state
from ..streaming import events as stream
from ..streaming import late as late_stream
from . import bronze, incremental, medallion, orders, silver
from . import flatten as any_depth

RUN_ID = "check"
LOADED_AT = datetime(2002, 1, 1)


def _land_json(df: DataFrame, path: str) -> str:
    df.write.json(path)
    return path


def json_scan(w) -> DataFrame:
    """Return events written as JSON lines and scanned with their declared schema."""
    view = w.v.return_events.drop("ingested_at_utc")
    path = _land_json(view, scratch_path(w.spark, "json-scan"))
    return raw.scan_json(w.spark, path, "event_id string, event_type string, occurred_at_utc timestamp_ntz, order_id string, return_id string", raw.LINES)


def csv_scan(w) -> DataFrame:
    path = scratch_path(w.spark, "csv-scan")
    w.v.campaign_spend.write.option("header", True).csv(path)
    return raw.scan_csv(w.spark, path, "spend_date date, campaign_id string, channel string, spend_amount decimal(14,2)")


def json_array(w) -> DataFrame:
    """Return events landed as files of one JSON array each, found to be arrays, numbered and flattened."""
    source = SOURCES["return_events"]
    at = F.date_format("occurred_at_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("occurred_at_utc")
    nested = w.v.return_events.select("event_id", "event_type", at, F.struct("order_id", "return_id").alias("payload"))
    count = max(1, nested.count() // 2000)  # about 2,000 records in a file, however many there are
    files = nested.groupBy(F.pmod(F.xxhash64("event_id"), F.lit(count))).agg(F.to_json(F.collect_list(F.struct(*nested.columns))).alias("value"))
    path = scratch_path(w.spark, "json-array")
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    records = raw.raw_records(w.spark, path, source)
    flat = silver.flatten(bronze.with_lineage(records, source, RUN_ID, LOADED_AT), source)
    return flat.select("event_id", "event_type", F.col("occurred_at_utc").cast("timestamp").cast("timestamp_ntz").alias("occurred_at_utc"),
                       "order_id", "return_id", (F.col("row_number") >= 0).alias("numbered"))


def array_split(w) -> DataFrame:
    """Return events landed as few long array files, each begun with a null, and read by many tasks."""
    source = SOURCES["return_events"]
    at = F.date_format("occurred_at_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("occurred_at_utc")
    nested = w.v.return_events.select("event_id", "event_type", at, F.struct("order_id", "return_id").alias("payload"))
    count = max(1, nested.count() // 50_000)
    number = F.pmod(F.xxhash64("event_id"), F.lit(count)).alias("number")
    rows = nested.select(number, F.lit(1).alias("rank"), F.concat(F.lit(","), F.to_json(F.struct(*nested.columns))).alias("value"))
    files = w.spark.range(count)
    for rank, text in ((0, "[null"), (2, "]")):
        rows = rows.unionByName(files.select(F.col("id").alias("number"), F.lit(rank).alias("rank"), F.lit(text).alias("value")))
    path = scratch_path(w.spark, "array-split")
    rows.repartition(count, "number").sortWithinPartitions("number", "rank").select("number", "value").write.partitionBy("number").text(path)
    records = raw.raw_records(w.spark, path, source, raw.LONG_ARRAY).filter("raw <> 'null'")
    flat = silver.flatten(bronze.with_lineage(records, source, RUN_ID, LOADED_AT), source)
    return flat.select("event_id", "event_type", F.col("occurred_at_utc").cast("timestamp").cast("timestamp_ntz").alias("occurred_at_utc"),
                       "order_id", "return_id", (F.col("row_number") >= 1).alias("numbered"))


def csv_by_name(w) -> DataFrame:
    """Campaign spend landed with its columns in two orders and an undeclared one, then read by name."""
    spend = w.v.campaign_spend.withColumn("note", F.concat(F.lit('line one\nof "'), "campaign_id", F.lit('"')))
    root = scratch_path(w.spark, "csv-by-name")
    orders_ = {"WEB": ["note", "spend_amount", "channel", "spend_date", "campaign_id"], "MOBILE": ["campaign_id", "note", "channel", "spend_amount", "spend_date"]}
    for channel, names in orders_.items():
        rows = spend.filter(F.col("channel") == channel).select(*names)
        rows.write.option("header", True).option("escape", '"').csv(f"{root}/{channel}")
    records = raw.raw_records(w.spark, f"{root}/*", SOURCES["campaign_spend"])
    field = lambda name, kind: F.get_json_object("raw", f"$.{name}").cast(kind).alias(name)
    return records.select(field("spend_date", "date"), field("campaign_id", "string"), field("channel", "string"), field("spend_amount", MONEY), field("note", "string"))


def raw_payload(w) -> DataFrame:
    return bronze.raw_payload(w.v.order_promotions)


def lineage(w) -> DataFrame:
    """Order items landed as JSON lines, each with its checksum, id, run and file."""
    source = SOURCES["order_items"]
    path = _land_json(w.v.order_items, scratch_path(w.spark, "lineage"))
    records = bronze.with_lineage(raw.raw_records(w.spark, path, source, raw.LINES), source, RUN_ID, LOADED_AT)
    return records.select("record_id", "record_sha", "run_id", F.col("file_name").isNotNull().alias("has_file"), (F.col("row_number") >= 0).alias("has_number"))


def _payment_records(w) -> DataFrame:
    """Payment events landed in the raw shape: an envelope with a nested payload."""
    at = F.date_format("occurred_at_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("occurred_at_utc")
    payload = F.struct("order_id", "payment_id", "amount").alias("payload")
    nested = w.v.payment_events.select("event_id", "event_type", at, payload)
    path = _land_json(nested, scratch_path(w.spark, "payments"))
    return raw.raw_records(w.spark, path, SOURCES["payment_events"], raw.LINES)


def flatten(w) -> DataFrame:
    source = SOURCES["payment_events"]
    records = bronze.with_lineage(_payment_records(w), source, RUN_ID, LOADED_AT)
    return silver.flatten(records, source).select(*source.silver_columns).withColumn("amount", F.col("amount").cast(MONEY))


def _unknown_keys(w) -> DataFrame:
    """Payment events as raw records, some of which hold keys that nobody declared, at several depths."""
    number = F.regexp_extract("payment_id", "[0-9]+", 0).cast("bigint")
    at = F.date_format("occurred_at_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("occurred_at_utc")
    app = F.struct((number % 5).alias("version"), F.array(F.lit("a"), number.cast("string")).alias("tags"))
    device = F.when(number % 3 == 0, F.struct(F.concat(F.lit("os"), (number % 4).cast("string")).alias("os"), app.alias("app")))
    note = F.when(number % 5 == 0, F.lit('a "note" {'))
    record = F.struct("event_id", "event_type", at, F.struct("order_id", "payment_id", "amount").alias("payload"), device.alias("device"), note.alias("note"))
    return w.v.payment_events.select(F.to_json(record).alias("raw"))


def flatten_any(w) -> DataFrame:
    """Every path of the records as a column; the dots of the names are written ``__`` here."""
    flat = any_depth.flatten_any(_unknown_keys(w))
    return flat.select(*[F.col(f"`{c}`").cast(MONEY if c == "payload.amount" else flat.schema[c].dataType).alias(c.replace(".", "__")) for c in flat.columns])


def key_drift(w) -> DataFrame:
    return any_depth.drift(_unknown_keys(w), SOURCES["payment_events"])


def payment_events_silver(w) -> DataFrame:
    """The whole silver path for one feed: parse, type, check, keep one row per event copy."""
    source = SOURCES["payment_events"]
    records = bronze.with_lineage(_payment_records(w), source, RUN_ID, LOADED_AT)
    kept = silver.accepted(silver.checked(records, source), source)
    return kept.select(*[F.col(c).cast("timestamp_ntz").alias(c) if k == "time" else F.col(c) for c, k in source.columns.items()])


def utc_times(w) -> DataFrame:
    """Order times written with different offsets, brought back to one UTC instant."""
    text = F.date_format("ordered_at_utc", "yyyy-MM-dd'T'HH:mm:ss")
    offset = F.when(F.col("status") == "COMPLETED", "+07:00").when(F.col("status") == "PENDING", "Z").when(
        F.col("status") == "CANCELLED", "-05:00").otherwise("")
    instant = utc(F.concat(text, offset))
    return w.v.orders.select(
        "source_row_id", instant.cast("timestamp_ntz").alias("ordered_at_utc"), F.to_date(instant).alias("order_date")
    )


def status_norm(w) -> DataFrame:
    """Statuses in mixed case, padded and with an old spelling, made canonical."""
    messy = F.concat(F.lit("  "), F.lower(F.regexp_replace("status", "COMPLETED", "complete")), F.lit(" "))
    return w.v.orders.select("source_row_id", canonical(messy, STATUS_ALIASES).alias("status"))


def known_orders(w) -> DataFrame:
    """Orders of customers that exist in the customer master."""
    return w.v.orders.join(w.v.customers.select("customer_id"), "customer_id", "left_semi")


def item_rejects(w) -> DataFrame:
    return silver.item_rejects(w.v.order_items, known_orders(w), w.v.products)


def orphan_customers(w) -> DataFrame:
    return silver.orphan_keys(w.v.orders, SOURCES["orders"].references[0], w.v.customers)


def _view(w, name: str) -> DataFrame | None:
    return getattr(w.v, "cities" if name == "city_reference" else name, None)


def all_orphans(w) -> DataFrame:
    """Orphan keys of every declared reference between two views, with their row counts."""
    found = []
    for feed, source in SOURCES.items():
        for reference in source.references:
            facts, target = _view(w, feed), _view(w, reference.target)
            if facts is not None and target is not None:
                keys = silver.orphan_keys(facts, reference, target)
                found.append(keys.select(F.lit(feed).alias("feed"), F.lit(reference.column).alias("column_name"), F.col(reference.column).alias("key"), "row_count"))
    return reduce(DataFrame.unionByName, found)


def clean_items(w) -> DataFrame:
    return silver.clean_items(w.v.order_items)


def clean_items_summary(w) -> DataFrame:
    return orders.order_items_summary(clean_items(w))


def customer_version_at_order(w) -> DataFrame:
    latest = orders.orders_dedup(w.v.orders).select("order_id", "customer_id", "ordered_at_utc")
    return version_at(latest, w.v.customer_profiles, "customer_id", "ordered_at_utc", ["customer_segment"])


# ---- raw folder checks ------------------------------------------------------
_LANDED = ("customers", "products", "city_reference")


def _land_some(w) -> str:
    root = scratch_path(w.spark, "raw")
    views = {"customers": w.v.customers, "products": w.v.products, "city_reference": w.v.cities}
    for name in _LANDED:
        _land_json(views[name], f"{root}/{SOURCES[name].path}")
    w.v.campaign_spend.write.option("header", True).csv(f"{root}/{SOURCES['campaign_spend'].path}")
    return root


def files_missing(w) -> DataFrame:
    """Four of the sources are landed, so the others must be reported."""
    return raw.raw_files_missing(w.spark, _land_some(w))


def manifest_check(w) -> DataFrame:
    """A manifest of the landed files in which the products' checksums are wrong and one file is unknown."""
    root = _land_some(w)
    feed = F.regexp_extract("path", r"([a-z_]+)\.(json|csv)/part", 1)
    listed = raw.listed_files(w.spark, root, with_content=True).filter(feed != "").select(
        "path", F.when(feed == "products", F.sha2(F.lit("other"), 256)).otherwise(F.sha2("content", 256)).alias("sha256")
    )
    absent = listed.limit(1).select(F.lit("events/lost.json/part-0").alias("path"), "sha256")
    status = raw.manifest_check(w.spark, root, listed.unionByName(absent))
    return status.select(feed.alias("feed"), "status").distinct()


def tree_manifest(w) -> DataFrame:
    """Orders landed in one file per month, some months changed, left out or added, beside digests of the rows themselves."""
    month = F.date_format("ordered_at_utc", "yyyy-MM").alias("file")
    number = F.row_number().over(Window.partitionBy("file").orderBy(F.col("order_id").cast("bigint"))) - 1
    rows = orders.orders_dedup(w.v.orders).select(month, "order_id", F.to_json(F.struct("order_id", "status", "shipping_revenue")).alias("value"))
    rows = rows.withColumn("number", number).select("file", "number", "value")
    expected = tree_digest.digests(rows, block_lines=64)
    at = F.substring("file", 1, 4).cast("int") * 12 + F.substring("file", 6, 2).cast("int")
    landed = rows.filter(at % 11 != 2).withColumn("value", F.when((at % 7 == 1) & (F.col("number") == 0), F.lit("{}")).otherwise(F.col("value")))
    landed = landed.unionByName(rows.filter(at % 13 == 3).withColumn("file", F.concat(F.lit("extra-"), "file")))
    path = scratch_path(w.spark, "tree")
    landed.repartition("file").sortWithinPartitions("file", "number").select("file", "value").write.partitionBy("file").text(path)
    found = tree_digest.file_digests(w.spark, path, block_lines=64).withColumn("file", F.regexp_extract("file", "/file=([^/]+)/", 1))
    return tree_digest.compared(found, expected)


def stage_log(w) -> DataFrame:
    """Run records appended stage by stage, with the rows each stage read."""
    store = LayerStore(w.spark, scratch_path(w.spark, "ops"), RUN_ID)
    for name in ("orders", "order_items", "payment_events"):
        store.append_ops([(RUN_ID, name, "ok", LOADED_AT, LOADED_AT, getattr(w.v, name).count(), None)])
    return ops_runs(w.spark, store.root).select("run_id", "stage", "status", "row_count")


# ---- streaming --------------------------------------------------------------
def _land_payments(w, label: str) -> str:
    return _land_json(w.v.payment_events, scratch_path(w.spark, label))


def stream_event_dedup(w) -> DataFrame:
    """All payment events through the streaming job in one batch; copies drop out."""
    folder = _land_payments(w, "stream-in")
    out, state = scratch_path(w.spark, "stream-out"), scratch_path(w.spark, "stream-state")
    stream.deduplicate(w.spark, folder, out, state).awaitTermination()
    events = w.spark.read.schema(stream.EVENT_SCHEMA).parquet(out)
    return events.withColumn("occurred_at_utc", F.col("occurred_at_utc").cast("timestamp_ntz"))


def stream_payment_status(w) -> DataFrame:
    """Payment status upserted batch by batch, several files at a time."""
    folder = scratch_path(w.spark, "stream-in")
    w.v.payment_events.repartition(8, "event_id").write.json(folder)
    out, state = scratch_path(w.spark, "stream-out"), scratch_path(w.spark, "stream-state")
    stream.upsert_status(w.spark, folder, out, state, files_per_batch=3).awaitTermination()
    return stream.current_status(w.spark, out)


def _arrivals(w) -> DataFrame:
    """Payment events with the year they arrive in: of 20 orders one pays again 400 days later, one pays 60 days late."""
    order = F.regexp_extract("payment_id", "[0-9]+", 0).cast("bigint") % 20
    days = F.when(order == 0, F.array(F.lit(0), F.lit(400))).when(order == 1, F.array(F.lit(60))).otherwise(F.array(F.lit(0)))
    late = w.v.payment_events.withColumn("days", F.explode(days))
    return late.withColumn("arrival", F.year(F.col("occurred_at_utc") + F.make_dt_interval("days"))).drop("days")


def stream_late_events(w) -> DataFrame:
    """Payment events arriving year by year; those behind the watermark are found in the late table, none is lost."""
    arrivals = _arrivals(w)
    folder, out, state = (scratch_path(w.spark, f"late-{x}") for x in ("in", "out", "state"))
    years = [r["arrival"] for r in arrivals.select("arrival").distinct().orderBy("arrival").collect()]  # a handful of years
    for year in years:
        arrivals.filter(F.col("arrival") == year).drop("arrival").write.mode("append").json(folder)
        late_stream.ingest(w.spark, folder, out, state, period="year").awaitTermination()
    events = late_stream.all_events(w.spark, out).drop("batch_id", "period")
    return events.withColumn("occurred_at_utc", F.col("occurred_at_utc").cast("timestamp_ntz"))


# ---- gold after a drop --------------------------------------------------------
_ORDER_NO = "try_cast(order_id AS bigint)"
# What comes with the drop: some orders whole, late refunds, tickets and web events of others, and one campaign's free days of early years.
_DROPPED = {feed: f"coalesce({_ORDER_NO} % 9970 = 5, false)" for feed in (
    "orders", "order_items", "order_promotions", "payment_events", "refund_events", "return_events", "support_events", "web_events")}
_DROPPED |= {
    "refund_events": f"coalesce({_ORDER_NO} % 9970 = 5 OR {_ORDER_NO} % 4990 = 3, false)",
    "support_events": f"coalesce({_ORDER_NO} % 9970 = 5 OR {_ORDER_NO} % 7010 = 2, false)",
    "web_events": f"coalesce({_ORDER_NO} % 9970 = 5 OR {_ORDER_NO} % 8110 = 7, false)",
    "campaign_spend": "campaign_id = 'CMP-8' AND spend_amount = 0 AND spend_date < DATE '1996-01-01'",
}
# A sum and a count of each gold table that show what changed in it.
_SHOWN = {
    "order_360": ("net_revenue", "count_if(first_order_flag)"), "customer_daily": ("net_revenue", "sum(support_contacts)"),
    "product_daily": ("net_revenue", "sum(units_sold)"), "channel_campaign_daily": ("net_revenue", "sum(attributed_customers)"),
    "executive_kpis_daily": ("net_revenue", "sum(active_customers)"),
}


def gold_incremental(w) -> DataFrame:
    """Gold of all but a drop's rows, then refreshed with them: each table's days, their totals, and whether the day's month was written again.

    Every five-thousandth order also comes back returned, which replaces its row.
    """
    v, root = w.v, scratch_path(w.spark, "lake")
    now = {
        "orders": orders.orders_dedup(v.orders), "order_items": v.order_items, "order_promotions": v.order_promotions,
        "payment_events": orders.payment_events_dedup(v.payment_events), "refund_events": v.refund_events, "return_events": v.return_events,
        "support_events": v.support_events, "web_events": v.web_events, "inventory_snapshots": v.inventory_snapshots,
        "campaign_spend": v.campaign_spend, "product_categories": v.product_categories,
    }
    rows = {feed: df.filter(f"NOT ({_DROPPED[feed]})") if feed in _DROPPED else df for feed, df in now.items()}
    changes = {feed: incremental.Change(now[feed].filter(_DROPPED[feed]), now[feed].limit(0)) for feed in _DROPPED}
    returned = f"{_ORDER_NO} % 5000 = 0"
    earlier = orders.orders_dedup(v.orders.filter(f"{returned} AND status <> 'RETURNED'"))
    rows["orders"] = rows["orders"].filter(f"NOT ({returned})").unionByName(earlier)
    changes["orders"] = incremental.Change(now["orders"].filter(f"{_DROPPED['orders']} OR {returned}"), earlier)
    full, drop = (LayerStore(w.spark, root, run, period="month") for run in ("full", "drop"))
    medallion.write_gold(full, rows, LOADED_AT)
    full.publish(LOADED_AT)
    place = (w.spark, root, published_state(w.spark, root))
    refresh = incremental.GoldRefresh(drop, lambda t: gold_table(*place, t), lambda t: gold_parts(*place, t), now.__getitem__, changes, LOADED_AT)
    months = refresh.run()
    drop.publish(LOADED_AT + timedelta(days=1), [*place[2].chain, (drop.run_id, drop.attempt, sorted(changes))])
    gold, found = GoldTables(w.spark, root), []
    for name, table in gold_contract().items():
        total, count = _SHOWN[name]
        again = F.trunc("metric_date", "month").isin(sorted(months[name])).alias("written_again")
        found.append(getattr(gold, name).groupBy(F.col(table.date).alias("metric_date")).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(total).alias("total"), F.expr(count).cast("bigint").alias("counted"))
            .select(F.lit(name).alias("table_name"), "metric_date", "row_count", "total", "counted", again))
    return reduce(DataFrame.unionByName, found)


LANDING = {
    "bronze_json_scan": json_scan,
    "bronze_csv_scan": csv_scan,
    "bronze_json_array": json_array,
    "bronze_array_split": array_split,
    "bronze_csv_by_name": csv_by_name,
    "bronze_raw_payload": raw_payload,
    "bronze_lineage": lineage,
    "raw_files_missing": files_missing,
    "manifest_check": manifest_check,
    "manifest_tree": tree_manifest,
    "ops_runs": stage_log,
    "silver_flatten": flatten,
    "silver_flatten_any": flatten_any,
    "silver_key_drift": key_drift,
    "silver_payment_events": payment_events_silver,
    "silver_utc": utc_times,
    "silver_status_norm": status_norm,
    "silver_rejects": item_rejects,
    "silver_orphans": orphan_customers,
    "silver_orphans_all": all_orphans,
    "silver_clean_items": clean_items,
    "silver_clean_items_summary": clean_items_summary,
    "customer_version_at_order": customer_version_at_order,
    "gold_incremental": gold_incremental,
    "stream_event_dedup": stream_event_dedup,
    "stream_late_events": stream_late_events,
    "stream_payment_status": stream_payment_status,
}
