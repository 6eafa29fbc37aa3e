"""P, J, A, W, L, U, F: the relational constructs, on the feeds and the driver's tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from gridmart import functions as G
from gridmart.operators import chunks, current, joins, scd2, slices
from gridmart.plans import intermediate, marts, staging

from . import domain
from .domain import warehouse
from .oracle import sk
from .registry import add


def raw(spark, sf, name):
    return domain.RawFeeds(spark, sf)[name]


def tab(name):
    return lambda spark, sf: domain.table(spark, sf, name)


orders, lineitem, events, customer = tab("orders"), tab("lineitem"), tab("events"), tab("customer")
part, supplier, nation, region = tab("part"), tab("supplier"), tab("nation"), tab("region")


def money(column):
    return F.col(column).cast("decimal(12,2)")


# --- projections, filters, predicates ---------------------------------------------------

add("p1_cast_projection", lambda s, d: staging.typed(raw(s, d, "invoices"), "invoices").select(
        "invoice_id", "invoice_date", "due_date", "total_amount", "updated_at"),
    "SELECT invoice_id, invoice_date, due_date, total_amount, updated_at FROM raw_invoices", "total_amount")
add("p2_delete_op_filter", lambda s, d: raw(s, d, "payments").filter(F.col("_op") != "DELETE").select("payment_id", "_op"),
    "SELECT payment_id, _op FROM raw_payments WHERE _op <> 'DELETE'")
add("p3_soft_delete_filter", lambda s, d: current.saas_filtered(raw(s, d, "contacts")).select("contact_id", "_sync_id"),
    "SELECT contact_id, _sync_id FROM raw_contacts WHERE NOT _is_deleted")
add("p4_event_type_filter", lambda s, d: raw(s, d, "telemetry_events").filter(F.col("event_type") == "device_status")
    .select("device_id", "event_timestamp"),
    "SELECT device_id, event_timestamp FROM telemetry WHERE event_type = 'device_status'")
add("p5_not_null_filter", lambda s, d: warehouse(s, d)["stg_crm__cases"].filter(F.col("contact_id").isNotNull())
    .select("case_id", "contact_id"),
    "SELECT case_id, contact_id FROM stg_crm__cases WHERE contact_id IS NOT NULL")
add("p6_current_version_filter", lambda s, d: marts.current(marts.dim_contract(scd2.scd2_from_log(
        raw(s, d, "contracts"), "contract_id"))).select("contract_id", "valid_from", "is_current"),
    "SELECT contract_id, valid_from, TRUE AS is_current FROM versions WHERE valid_to IS NULL")
add("p7_ordered_case", lambda s, d: warehouse(s, d)["int_device__lifecycle"].select("device_id", "lifecycle_state"),
    "SELECT device_id, lifecycle_state FROM int_device__lifecycle")
add("p8_case_without_else", lambda s, d: orders(s, d).select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("closed_at")),
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS closed_at FROM orders")
add("p9_null_is_false", lambda s, d: warehouse(s, d)["fct_payments"].select("payment_id", "is_late_payment"),
    "SELECT payment_id, is_late_payment FROM fct_payments")
add("p10_in_lists", lambda s, d: raw(s, d, "contracts").select(
        "contract_id", "status", F.col("status").isin(*marts.STARTED).alias("started"),
        (~F.col("status").isin("active", "renewed")).alias("ended")),
    """SELECT contract_id, status, status IN ('active', 'renewed', 'cancelled', 'expired') AS started,
    status NOT IN ('active', 'renewed') AS ended FROM raw_contracts""")
add("p11_contains_ignoring_case", lambda s, d: customer(s, d).filter(
        G.contains_ignoring_case(F.col("c_name"), "#00000001") | G.contains_ignoring_case(F.col("c_mktsegment"), "house"))
    .select("c_custkey", "c_name"),
    """SELECT c_custkey, c_name FROM customer
WHERE contains(lower(c_name), '#00000001') OR contains(lower(c_mktsegment), 'house')""")
add("p12_range_filters", lambda s, d: lineitem(s, d).filter(
        ((F.col("l_discount") < 0.02) | (F.col("l_quantity") >= 48)) & (F.col("l_tax") <= 0.05))
    .select("l_orderkey", "l_linenumber", "l_discount", "l_quantity"),
    """SELECT l_orderkey, l_linenumber, l_discount, l_quantity FROM lineitem
WHERE (l_discount < 0.02 OR l_quantity >= 48) AND l_tax <= 0.05""")
add("p13_point_lookup", lambda s, d: orders(s, d).filter(F.col("o_custkey") == F.lit("7").cast("bigint"))
    .select("o_orderkey", "o_custkey"),
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = 7")

# --- joins ------------------------------------------------------------------------------

add("j1_inner_join", lambda s, d: lineitem(s, d).select("l_orderkey", "l_linenumber", "l_quantity").join(
        orders(s, d).select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    .groupBy("o_custkey").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity")),
    """SELECT o_custkey, count(*) AS lines, sum(l_quantity) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
add("j2_star_lookup", lambda s, d: warehouse(s, d)["fct_contract_lifecycle"].select(
        "contract_id", "customer_sk", "household_sk", "product_sk", "contract_sk", "start_date_key"),
    "SELECT contract_id, customer_sk, household_sk, product_sk, contract_sk, start_date_key FROM fct_contract_lifecycle")


def j3(s, d):
    ordered = orders(s, d).groupBy(F.col("o_custkey").alias("key"), F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("orders"))
    billed = lineitem(s, d).groupBy(F.col("l_suppkey").alias("key"), F.to_date("l_shipdate").alias("day")).agg(
        F.count("*").alias("lines"))
    return joins.full_outer(ordered, billed, ["key", "day"])


add("j3_full_outer_join", j3, """
SELECT coalesce(o.key, l.key) AS key, coalesce(o.day, l.day) AS day, orders, lines
FROM (SELECT o_custkey AS key, CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1, 2) o
FULL JOIN (SELECT l_suppkey AS key, CAST(l_shipdate AS DATE) AS day, count(*) AS lines FROM lineitem GROUP BY 1, 2) l
    ON o.key = l.key AND o.day = l.day""")


def j4(s, d):
    newest = current.latest_per_key(orders(s, d), ["o_custkey"], current.newest_first("o_orderdate", "o_orderkey"))
    return joins.lookup(customer(s, d).select("c_custkey"), newest, "c_custkey", "o_custkey", {"o_orderkey": "newest_order"})


add("j4_left_join_first_row", j4, """
SELECT c_custkey, o_orderkey AS newest_order FROM customer LEFT JOIN (SELECT *, row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) ON c_custkey = o_custkey AND rn = 1""")
add("j5_computed_key_join", lambda s, d: joins.lookup(
        events(s, d).select("event_id", "ts"), warehouse(s, d)["dim_date"], F.to_date("ts"), "full_date",
        {"date_key": "date_key", "week_number_iso": "week"}, small=True),
    "SELECT event_id, ts, date_key, week_number_iso AS week FROM events LEFT JOIN dim_date ON CAST(ts AS DATE) = full_date")
add("j6_mixed_type_join", lambda s, d: joins.lookup(
        raw(s, d, "telemetry_events").select("device_id", "event_timestamp", "event_type"),
        warehouse(s, d)["stg_oltp__devices"].withColumn("text_id", F.col("device_id").cast("string")),
        "device_id", "text_id", {"device_type": "device_type"}),
    """SELECT t.device_id, t.event_timestamp, t.event_type, d.device_type FROM telemetry t
LEFT JOIN stg_oltp__devices d ON t.device_id = CAST(d.device_id AS VARCHAR)""")


def j7(s, d):
    days = warehouse(s, d)["dim_date"]
    rows = warehouse(s, d)["stg_oltp__invoices"].select("invoice_id", "invoice_date", "due_date")
    rows = joins.lookup(rows, days, "invoice_date", "full_date", {"date_key": "invoice_date_key"}, small=True)
    return joins.lookup(rows, days, "due_date", "full_date", {"date_key": "due_date_key", "is_weekend": "due_on_weekend"}, small=True)


add("j7_role_playing_dimension", j7, """
SELECT i.invoice_id, i.invoice_date, i.due_date, a.date_key AS invoice_date_key, b.date_key AS due_date_key,
    b.is_weekend AS due_on_weekend
FROM stg_oltp__invoices i LEFT JOIN dim_date a ON i.invoice_date = a.full_date LEFT JOIN dim_date b ON i.due_date = b.full_date""")


def j8(s, d):
    by_order = orders(s, d).groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.sum(money("o_totalprice")).alias("total"))
    return customer(s, d).select("c_custkey").join(by_order, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("total", F.lit(0)).alias("total"))


add("j8_aggregate_then_join", j8, """
SELECT c_custkey, coalesce(n, 0) AS orders, coalesce(t, 0) AS total FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS t FROM orders GROUP BY 1)
    ON c_custkey = o_custkey""", "total")
add("j9_deduplicated_lookup", lambda s, d: joins.lookup(
        orders(s, d).select("o_orderkey"),
        joins.one_per_key(lineitem(s, d).withColumn("line_sk", sk_line()), "l_orderkey", "line_sk"),
        "o_orderkey", "l_orderkey", {"line_sk": "line_sk"}),
    f"""SELECT o_orderkey, line_sk FROM orders LEFT JOIN (
    SELECT l_orderkey, min({sk('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey')}) AS line_sk FROM lineitem GROUP BY 1)
    ON o_orderkey = l_orderkey""")


def sk_line():
    return G.surrogate_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def j10(s, d):
    parts = lineitem(s, d).select("l_orderkey", "l_partkey").distinct()
    return parts.join(orders(s, d).select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "l_partkey").distinct()


add("j10_bridge_distinct_pairs", j10,
    "SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey")


def versions(s, d):
    return scd2.scd2_from_log(raw(s, d, "contracts"), "contract_id")


def broken_versions(s, d):
    return versions(s, d).select(
        "contract_id", "valid_from", (F.col("valid_from") + F.expr("INTERVAL '400' DAY")).alias("valid_to"))


# Versions in their order; a later one overlaps an earlier one that has not ended at its start.
OVERLAPS = """
SELECT earlier.contract_id, earlier.valid_from AS a_valid_from, earlier.valid_to AS a_valid_to,
    later.valid_from AS b_valid_from, later.valid_to AS b_valid_to
FROM (SELECT *, dense_rank() OVER (PARTITION BY contract_id ORDER BY valid_from) AS n FROM {0}) later
JOIN (SELECT *, dense_rank() OVER (PARTITION BY contract_id ORDER BY valid_from) AS n FROM {0}) earlier USING (contract_id)
WHERE later.n > earlier.n AND coalesce(earlier.valid_to, TIMESTAMP 'infinity') > later.valid_from"""
add("j11_interval_overlap_pairs", lambda s, d: scd2.scd2_overlaps(broken_versions(s, d), "contract_id"),
    OVERLAPS.format("broken_versions"))
add("j11_overlapping_versions", lambda s, d: scd2.scd2_overlapping_versions(broken_versions(s, d), "contract_id"),
    """SELECT contract_id, valid_from, earlier_valid_to FROM (SELECT *, max(valid_to) OVER (PARTITION BY contract_id
    ORDER BY valid_from ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier_valid_to FROM broken_versions)
WHERE earlier_valid_to > valid_from""")
add("j12_null_aware_anti_join", lambda s, d: joins.not_in(
        customer(s, d).select("c_custkey"), "c_custkey", events(s, d), "user_id"),
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
add("j12_not_in_with_null_parent", lambda s, d: joins.not_in(
        customer(s, d).select("c_custkey"), "c_custkey",
        events(s, d).select(F.nullif("user_id", F.lit(0)).alias("user_id")), "user_id"),
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT nullif(user_id, 0) FROM events)")

# --- aggregations -----------------------------------------------------------------------

add("a1_count", lambda s, d: events(s, d).groupBy("event_type").agg(F.count("*").alias("row_count")),
    "SELECT event_type, count(*) AS row_count FROM events GROUP BY 1")
add("a2_sum_decimal", lambda s, d: lineitem(s, d).groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(money("l_extendedprice")).alias("total")),
    "SELECT l_returnflag, l_linestatus, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS total FROM lineitem GROUP BY 1, 2",
    "total")
add("a3_min_max", lambda s, d: lineitem(s, d).groupBy("l_suppkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.max("l_quantity").alias("most")),
    "SELECT l_suppkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, max(l_quantity) AS most FROM lineitem GROUP BY 1")
add("a4_avg", lambda s, d: orders(s, d).groupBy("o_orderpriority").agg(
        F.round(F.sum(money("o_totalprice")).cast("double") / F.count("*"), 6).alias("mean")),
    """SELECT o_orderpriority, round(CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*), 6) AS mean
FROM orders GROUP BY 1""")
add("a5_conditional_count", lambda s, d: orders(s, d).groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("closed"),
        F.count(F.when(F.col("o_totalprice") > 200000, 1)).alias("large")),
    """SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS closed,
    count(CASE WHEN o_totalprice > 200000 THEN 1 END) AS large FROM orders GROUP BY 1""")
add("a6_count_distinct", lambda s, d: lineitem(s, d).groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("parts")),
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
add("a7_count_distinct_pairs_having", lambda s, d: lineitem(s, d).groupBy("l_orderkey").agg(
        F.count_distinct(F.concat(F.col("l_linenumber").cast("string"), F.lit("|"), F.nullif("l_returnflag", F.lit("N")))).alias("pairs"))
    .filter("pairs > 1"),
    """SELECT l_orderkey, count(DISTINCT l_linenumber || '|' || nullif(l_returnflag, 'N')) AS pairs
FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber || '|' || nullif(l_returnflag, 'N')) > 1""")
add("a8_group_by_expression", lambda s, d: events(s, d).groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("row_count"), F.max("value").alias("peak")),
    "SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS row_count, max(value) AS peak FROM events GROUP BY 1, 2")
add("a9_having", lambda s, d: lineitem(s, d).groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies"))
    .filter("copies >= 3"),
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 3")


def a10(s, d):
    newest = events(s, d).agg(F.max("ts").alias("m"))
    return events(s, d).filter(F.col("ts") > newest.scalar() - F.expr("INTERVAL '1' DAY")).select("event_id", "ts")


add("a10_scalar_aggregate_subquery", a10,
    "SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY")
add("a11_distinct", lambda s, d: lineitem(s, d).select("l_orderkey", "l_linenumber").distinct(),
    "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")

# --- windows ----------------------------------------------------------------------------

add("w1_latest_row_per_key", lambda s, d: current.cdc_current(raw(s, d, "customers"), "customer_id").select(
        "customer_id", "status", "_source_ts", "_op"),
    """SELECT customer_id, status, _source_ts, _op FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
    ORDER BY _source_ts DESC, _loaded_at DESC, _connector_batch_id DESC) AS rn FROM raw_customers WHERE _op <> 'DELETE')
WHERE rn = 1""")
add("w1_latest_row_deletes_dropped", lambda s, d: current.cdc_current(
        raw(s, d, "customers"), "customer_id", drop_deleted=True).select("customer_id", "status", "_source_ts", "_op"),
    """SELECT customer_id, status, _source_ts, _op FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
    ORDER BY _source_ts DESC, _loaded_at DESC, _connector_batch_id DESC) AS rn FROM raw_customers)
WHERE rn = 1 AND _op <> 'DELETE'""")
add("w2_latest_row_nulls_last", lambda s, d: current.saas_current(raw(s, d, "accounts"), "account_id").select(
        "account_id", "account_name", "last_modified_date"),
    "SELECT account_id, account_name, last_modified_date FROM stg_crm__accounts")
add("w2_dedup_lineitem", lambda s, d: current.latest_per_key(
        lineitem(s, d).filter(F.col("l_returnflag") != "R"), ["l_orderkey", "l_linenumber"],
        current.newest_first("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")),
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
    l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem WHERE l_returnflag <> 'R')
WHERE rn = 1""")
add("w3_event_dedup", lambda s, d: staging.telemetry_model(raw(s, d, "telemetry_events"), "energy_readings").select(
        "device_id", "event_timestamp", "kwh_reading", "_loaded_at"),
    "SELECT device_id, event_timestamp, kwh_reading, _loaded_at FROM stg_iot__energy_readings", "kwh_reading")
add("w4_latest_by_business_date", lambda s, d: current.latest_effective(raw(s, d, "product_catalog_updates"), "product_id")
    .select("product_id", "list_price", "effective_date"),
    "SELECT product_id, list_price, effective_date FROM stg_partner__product_catalog", "list_price")
add("w5_best_match_rank", lambda s, d: intermediate.best_contact_per_email(warehouse(s, d)["stg_crm__contacts"]).select(
        "email", "contact_id"),
    """SELECT email, contact_id FROM (SELECT *, row_number() OVER (PARTITION BY lower(email)
    ORDER BY last_modified_date DESC NULLS LAST, created_date DESC NULLS LAST, contact_id DESC) AS rn
    FROM stg_crm__contacts) WHERE rn = 1""")
add("w6_partition_weight", lambda s, d: joins.equal_weights(
        lineitem(s, d).select("l_orderkey", "l_suppkey").distinct(), "l_orderkey"),
    """SELECT l_orderkey, l_suppkey, CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY l_orderkey) AS allocation_pct
FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)""")


def w7(s, d):
    rows = lineitem(s, d).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return slices.occurrence_ordinal(
        rows, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice"])


add("w7_occurrence_ordinal", w7, """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_quantity, l_extendedprice) AS occurrence FROM lineitem""")
add("w8_latest_event_per_device", lambda s, d: current.latest_per_key(
        events(s, d), ["user_id"], current.newest_first("ts", "event_id")),
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
FROM events) WHERE rn = 1""")
add("w9_lookup_rank_guard", lambda s, d: joins.one_per_key(
        lineitem(s, d).select("l_partkey", "l_suppkey"), "l_partkey", "l_suppkey"),
    "SELECT l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1")

# --- sorts, limits, set operations ------------------------------------------------------

add("l1_sort", lambda s, d: orders(s, d).select("o_orderkey", "o_orderdate").orderBy(
        F.col("o_orderdate").desc_nulls_last(), "o_orderkey"),
    "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey")
add("l2_sort_limit", lambda s, d: orders(s, d).select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(
        F.col("o_orderdate").desc_nulls_last(), "o_orderkey").limit(25),
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
add("l3_limit", lambda s, d: customer(s, d).filter("c_acctbal < 0").select("c_custkey", "c_name").orderBy("c_custkey").limit(20),
    "SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 20")
add("l4_top_n_by_metric", lambda s, d: orders(s, d).groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total"))
    .orderBy(F.col("total").desc(), "o_custkey").limit(10),
    """SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders GROUP BY 1
ORDER BY total DESC, o_custkey LIMIT 10""", "total")


def u1(s, d):
    wh = warehouse(s, d)
    return marts.all_events(*[wh[f"stg_iot__{m}"] for m in (
        "energy_readings", "temperature_readings", "device_status", "alert_events")])


add("u1_union_all_streams", u1, "SELECT * FROM all_events", "reading_value")

# --- scalar functions -------------------------------------------------------------------

add("f1_lower", lambda s, d: raw(s, d, "customers").select("customer_id", "_source_ts", F.lower("email").alias("email")),
    "SELECT customer_id, _source_ts, lower(email) AS email FROM raw_customers")


def f2(s, d):
    name = F.concat_ws("-", F.upper("p_name"), "p_brand")
    return part(s, d).select("p_partkey", G.title_case(name).alias("name"))


add("f2_title_case", f2, """
SELECT p_partkey, upper(substr(a, 1, 1)) || lower(substr(a, 2)) || ' ' || upper(substr(b, 1, 1)) || lower(substr(b, 2))
    || '-' || upper(substr(p_brand, 1, 1)) || lower(substr(p_brand, 2)) AS name
FROM (SELECT *, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)""")
add("f3_concat", lambda s, d: nation(s, d).join(region(s, d), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat("n_name", F.lit(" / "), F.nullif("r_name", F.lit("ASIA"))).alias("place")),
    "SELECT n_name || ' / ' || nullif(r_name, 'ASIA') AS place FROM nation JOIN region ON n_regionkey = r_regionkey")
add("f4_coalesce", lambda s, d: raw(s, d, "invoice_line_items").select(
        "line_item_id", "_connector_batch_id", (F.col("amount") - F.coalesce("tax_amount", F.lit(0))).alias("net_amount")),
    """SELECT line_item_id, _connector_batch_id, amount - coalesce(tax_amount, 0) AS net_amount FROM raw_invoice_line_items""",
    "net_amount")
add("f5_nullif", lambda s, d: lineitem(s, d).select(
        "l_orderkey", "l_linenumber", F.try_divide(F.col("l_quantity"), F.nullif("l_tax", F.lit(0.0))).alias("ratio")),
    "SELECT l_orderkey, l_linenumber, l_quantity / nullif(l_tax, 0) AS ratio FROM lineitem")
add("f6_greatest", lambda s, d: orders(s, d).select("o_orderkey", F.greatest(
        F.to_date("o_orderdate").cast("timestamp_ntz"), F.lit("1998-01-01 12:00:00").cast("timestamp_ntz")).alias("latest")),
    "SELECT o_orderkey, greatest(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), TIMESTAMP '1998-01-01 12:00:00') AS latest FROM orders")
add("f7_arithmetic", lambda s, d: customer(s, d).select("c_custkey", F.abs(money("c_acctbal") * 2 - 100).alias("distance")),
    "SELECT c_custkey, abs(CAST(c_acctbal AS DECIMAL(12,2)) * 2 - 100) AS distance FROM customer", "distance")
add("f8_casts", lambda s, d: lineitem(s, d).select(
        F.col("l_orderkey").cast("string").alias("key_text"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").cast("date").alias("day"), money("l_extendedprice").alias("price"),
        F.col("l_returnflag").try_cast("int").alias("not_a_number")),
    """SELECT CAST(l_orderkey AS VARCHAR) AS key_text, CAST(l_quantity AS INTEGER) AS quantity, CAST(l_shipdate AS DATE) AS day,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price, TRY_CAST(l_returnflag AS INTEGER) AS not_a_number FROM lineitem""", "price")
add("f9_date", lambda s, d: events(s, d).select("event_id", F.to_date("ts").alias("day")),
    "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
add("f10_hour_minute", lambda s, d: events(s, d).select(
        "event_id", G.clock_key(F.col("ts")).alias("clock_key"), G.minute_of_day(F.col("ts")).alias("minute_of_day")),
    "SELECT event_id, hour(ts) * 100 + minute(ts) AS clock_key, hour(ts) * 60 + minute(ts) AS minute_of_day FROM events")
add("f11_date_add", lambda s, d: orders(s, d).select("o_orderkey", F.date_add(F.to_date("o_orderdate"), 1).alias("next_day"),
        F.date_sub(F.to_date("o_orderdate"), 7).alias("week_before")),
    """SELECT o_orderkey, CAST(o_orderdate + INTERVAL 1 DAY AS DATE) AS next_day,
    CAST(o_orderdate - INTERVAL 7 DAY AS DATE) AS week_before FROM orders""")
add("f12_date_diff", lambda s, d: events(s, d).select("event_id", *[
        G.boundaries_between(u, F.lit("2024-01-10 00:59:30").cast("timestamp_ntz"), F.col("ts")).alias(f"{u}s")
        for u in ("minute", "hour", "day")]),
    "SELECT event_id, " + ", ".join(
        f"date_diff('{u}', TIMESTAMP '2024-01-10 00:59:30', ts) AS {u}s" for u in ("minute", "hour", "day")) + " FROM events")
add("f13_as_of", lambda s, d: warehouse(s, d)["fct_contract_lifecycle"].select("contract_id", "contract_duration_days"),
    "SELECT contract_id, contract_duration_days FROM fct_contract_lifecycle")
add("f14_to_text", lambda s, d: events(s, d).select("event_id", F.col("value").cast("decimal(12,4)").cast("string").alias("value_text"),
        F.col("ts").cast("string").alias("ts_text")),
    "SELECT event_id, CAST(CAST(value AS DECIMAL(12,4)) AS VARCHAR) AS value_text, CAST(ts AS VARCHAR) AS ts_text FROM events")


def f15(s, d):
    rows = raw(s, d, "telemetry_events")
    return rows.select("device_id", "event_timestamp", "_loaded_at", *[
        G.payload_field(rows, "event_data", f"$.payload.{f}", t).alias(f)
        for f, t in (("kwh_reading", "decimal(12,4)"), ("status", "string"), ("battery_level", "int"), ("severity", "int"))])


add("f15_payload_path", f15, """
SELECT device_id, event_timestamp, _loaded_at,
    CASE event_type WHEN 'energy_reading' THEN CAST(reading AS DECIMAL(12,4)) END AS kwh_reading,
    CASE WHEN event_type <> 'device_status' THEN NULL WHEN cause = 'click' THEN 'online' WHEN k < 50 THEN 'offline'
        ELSE 'degraded' END AS status,
    CASE WHEN event_type = 'device_status' AND k >= 10 THEN k END AS battery_level, CAST(NULL AS INTEGER) AS severity
FROM telemetry""", "kwh_reading")
add("f15_payload_path_on_text", lambda s, d: events(s, d).select(
        "event_id", G.payload_field(events(s, d), "props", "$.k", "int").alias("k"),
        G.payload_field(events(s, d), "props", "$.absent", "int").alias("absent")),
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS INTEGER) AS absent FROM events")
add("f16_parse_json", lambda s, d: events(s, d).select(
        "event_id", F.schema_of_variant(F.parse_json("props")).alias("shape")),
    "SELECT event_id, 'OBJECT<k: BIGINT>' AS shape FROM events")
add("f17_surrogate_key", lambda s, d: lineitem(s, d).select("l_orderkey", "l_linenumber", G.surrogate_key(
        "l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")), money("l_extendedprice"), F.to_date("l_shipdate")).alias("line_sk")),
    f"""SELECT l_orderkey, l_linenumber, {sk('l_orderkey', 'l_linenumber', "nullif(l_returnflag, 'N')",
        'CAST(l_extendedprice AS DECIMAL(12,2))', 'CAST(l_shipdate AS DATE)')} AS line_sk FROM lineitem""")
add("f18_calendar_parts", lambda s, d: orders(s, d).select("o_orderkey", F.date_format("o_orderdate", "EEEE").alias("day_name"),
        F.date_format("o_orderdate", "MMMM").alias("month_name"), F.weekofyear("o_orderdate").alias("iso_week"),
        F.quarter("o_orderdate").alias("quarter")),
    """SELECT o_orderkey, dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name, week(o_orderdate) AS iso_week,
    quarter(o_orderdate) AS quarter FROM orders""")

# --- versions and text ------------------------------------------------------------------

add("sn2_scd2_from_log", lambda s, d: versions(s, d).select("contract_id", "status", "monthly_amount", "valid_from", "valid_to"),
    "SELECT contract_id, status, monthly_amount, valid_from, valid_to FROM versions", "monthly_amount")
add("sn2_version_at_event", lambda s, d: scd2.as_of_version(
        warehouse(s, d)["stg_oltp__payments"].select("payment_id", F.col("customer_id"), F.col("payment_date").cast("timestamp_ntz").alias("paid")),
        versions(s, d).select("customer_id", F.col("status").alias("contract_status"), "valid_from", "valid_to"),
        "customer_id", "paid", ["contract_status"]).select("payment_id", "contract_status"),
    """SELECT payment_id, v.status AS contract_status FROM stg_oltp__payments p LEFT JOIN versions v
    ON p.customer_id = v.customer_id AND v.valid_from <= p.payment_date AND (v.valid_to IS NULL OR p.payment_date < v.valid_to)""")
add("x1_chunk_documents", lambda s, d: chunks.chunk_documents(tab("documents")(s, d)).withColumn(
        "chunk_md5", F.md5("chunk_text")).drop("chunk_text"),
    """WITH w AS (SELECT doc_id, [x for x in regexp_split_to_array(text, '\\s+') if x <> ''] AS words FROM documents),
c AS (SELECT doc_id, words, unnest(range(0, greatest(len(words) - 50, 1), 462)) AS s FROM w WHERE len(words) > 0)
SELECT doc_id, CAST(s // 462 AS INTEGER) AS chunk_index, least(len(words) - s, 512) AS word_count,
    md5(array_to_string(words[s + 1:s + 512], ' ')) AS chunk_md5 FROM c""")
TOKEN_SQL = r"[\x09-\x0D\x20]*(?:[\p{L}\p{M}]+|\p{N}|[^\x09-\x0D\x20\p{L}\p{M}\p{N}])"
add("x1_chunk_tokens", lambda s, d: chunks.chunk_tokens(tab("documents")(s, d)).withColumn(
        "chunk_md5", F.md5("chunk_text")).drop("chunk_text"),
    f"""WITH w AS (SELECT doc_id, regexp_extract_all(text, '{TOKEN_SQL}') AS tokens FROM documents),
c AS (SELECT doc_id, tokens, unnest(range(0, greatest(len(tokens) - 50, 1), 462)) AS s FROM w WHERE len(tokens) > 0)
SELECT doc_id, CAST(s // 462 AS INTEGER) AS chunk_index, least(len(tokens) - s, 512) AS token_count,
    md5(ltrim(array_to_string(tokens[s + 1:s + 512], ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')) AS chunk_md5 FROM c""")
