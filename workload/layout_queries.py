"""The same answers from tables laid out for them, and metrics from daily sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmart.operators import sketches
from gridmart.plans import serving
from gridmart.session import scratch_path
from gridmart.sources import layouts

from . import domain
from .registry import add

BUCKETS = 8


def bucketed(spark, sf, name, key):
    rows = domain.table(spark, sf, name)
    return layouts.write_bucketed(rows, scratch_path(spark, f"bucketed-{name}"), key, BUCKETS)


def j1(spark, sf):
    lines, orders = bucketed(spark, sf, "lineitem", "l_orderkey"), bucketed(spark, sf, "orders", "o_orderkey")
    met = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return met.select("l_orderkey", "l_linenumber", "o_custkey", "o_orderdate")


add("j1_bucketed_join", j1,
    "SELECT l_orderkey, l_linenumber, o_custkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey")


def p13(spark, sf):
    orders = domain.table(spark, sf, "orders")
    table = layouts.write_lookup(orders, scratch_path(spark, "lookup"), "o_custkey", ["o_orderkey"])
    return table.filter("o_custkey = 7 OR o_orderkey = 12").select("o_orderkey", "o_custkey")


add("p13_lookup_in_sorted_files", p13, "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = 7 OR o_orderkey = 12")


def v3(spark, sf):
    wh = domain.stored_marts(spark, sf)
    return serving.recent_invoices(wh["fct_invoices"], wh["dim_customer"], "7", rows=1_000, point=True)


add("v3_recent_invoices_by_key", v3, """
SELECT invoice_id, line_description, quantity, amount, tax_amount, net_amount, invoice_status, revenue_classification
FROM fct_invoices WHERE customer_sk IN (SELECT customer_sk FROM dim_customer WHERE is_current AND customer_id = 7)
ORDER BY invoice_date_key DESC NULLS LAST, line_item_id LIMIT 1000""", "quantity amount tax_amount net_amount")


def s17(spark, sf):
    lines = domain.table(spark, sf, "lineitem")
    table = layouts.write_zordered(lines, scratch_path(spark, "zorder"), ["l_shipdate", "l_suppkey"])
    return table.filter("l_suppkey < 4 AND l_shipdate >= '1995-01-01'").select("l_orderkey", "l_linenumber", "l_suppkey")


add("s17_zordered_write", s17, """
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey < 4 AND l_shipdate >= TIMESTAMP '1995-01-01'""")

# Sketches answer approximately; each query says whether its answer lies within the bound around the
# exact one, which stands beside it.


def a6(spark, sf):
    orders = domain.table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    kinds = [sketches.Distinct("customers", "o_custkey")]
    path = scratch_path(spark, "daily")
    for half in (0, 1):  # two loads, which share days
        table = sketches.append_daily(orders.filter(F.col("o_orderkey") % 2 == half), path, ["day"], kinds)
    years = sketches.merged(table.withColumn("year", F.year("day")), ["year"], kinds)
    exact = orders.groupBy(F.year("day").alias("year")).agg(F.count_distinct("o_custkey").alias("customers_exact"))
    near = F.abs(sketches.distinct_count("customers") - F.col("customers_exact")) <= 0.03 * F.col("customers_exact") + 1
    return years.join(exact, "year").select("year", "rows", "customers_exact", near.alias("within_bound"))


add("a6_distinct_from_daily_sketches", a6, """
SELECT year(o_orderdate) AS year, count(*) AS rows, count(DISTINCT o_custkey) AS customers_exact, TRUE AS within_bound
FROM orders GROUP BY 1""")


def m8(spark, sf):
    tickets = domain.warehouse(spark, sf)["fct_service_ticket_lifecycle"].select(
        "opened_date_key", F.floor(F.col("opened_date_key") / 10000).alias("year"),
        F.col("time_to_first_response_hours").cast("double").alias("hours"))
    kinds = [sketches.Quantiles("response", "hours")]
    by_day = sketches.daily(tickets, ["opened_date_key", "year"], kinds)
    years = sketches.merged(by_day, ["year"], kinds).withColumn("median", sketches.quantile("response", 0.5))
    met = tickets.join(years.select(F.col("year").alias("_year"), "median"), F.col("year").eqNullSafe(F.col("_year")))
    below, upto = F.count_if(F.col("hours") < F.col("median")), F.count_if(F.col("hours") <= F.col("median"))
    n = F.count("hours")
    near = (n == 0) | ((below <= 0.52 * n) & (upto >= 0.48 * n))
    return met.groupBy("year").agg(n.alias("tickets"), near.alias("within_bound"))


add("m8_median_from_daily_sketches", m8, """
SELECT opened_date_key // 10000 AS year, count(time_to_first_response_hours) AS tickets, TRUE AS within_bound
FROM fct_service_ticket_lifecycle GROUP BY 1""")


def l4(spark, sf):
    lines = domain.table(spark, sf, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    kinds = [sketches.Top("suppliers", "l_suppkey")]
    years = sketches.daily(lines, ["day"], kinds).withColumn("year", F.year("day"))
    best = sketches.merged(years, ["year"], kinds).select("year", F.posexplode(sketches.top("suppliers", 5)).alias("at", "s"))
    return best.select("year", (F.col("at") + 1).alias("place"), F.col("s.count").alias("lines"))


add("l4_top_from_daily_sketches", l4, """
SELECT year, place, lines FROM (SELECT year(l_shipdate) AS year, count(*) AS lines,
    row_number() OVER (PARTITION BY year(l_shipdate) ORDER BY count(*) DESC) AS place
    FROM lineitem GROUP BY l_suppkey, 1) WHERE place <= 5""")
