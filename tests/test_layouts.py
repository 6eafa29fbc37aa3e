"""What layouts save: exchanges that are not planned, rows that are not read."""

import re
import time

import pytest
from pyspark.sql import functions as F

from gridmart.functions import surrogate_key
from gridmart.operators import sketches
from gridmart.plans import marts, semantic, serving, warehouse
from gridmart.plans.warehouse import Warehouse
from gridmart.sources import layouts, sinks
from workload import domain, quality_queries
from workload.model_queries import star


def executed(df):
    """The result's rows, the plan's text, and the rows and files its scans read."""
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    return found, plan.toString(), sum(metric(s, "numOutputRows") for s in scans(plan)), sum(
        metric(s, "numFiles") for s in scans(plan))


def scans(plan):
    name = plan.getClass().getSimpleName()
    if name == "FileSourceScanExec":
        return [plan]
    below = plan.plan() if name.endswith("QueryStageExec") else None
    nodes = [below] if below else [plan.children().apply(i) for i in range(plan.children().size())]
    return [s for n in nodes for s in scans(n)]


def metric(scan, name):
    return scan.metrics().apply(name).value()


@pytest.fixture(scope="module")
def numbers(spark):
    hashed = F.xxhash64("id")
    return spark.range(400_000).select(
        F.pmod(hashed, F.lit(20_000)).alias("k"), F.col("id").alias("line"), F.md5(F.col("id").cast("string")).alias("name"))


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString())


def test_bucketed_tables_join_without_an_exchange(spark, numbers, tmp_path, rows):
    left = layouts.write_bucketed(numbers, str(tmp_path / "l"), "k", 8)
    right = layouts.write_bucketed(numbers.filter("line < 1000"), str(tmp_path / "r"), "k", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = left.join(right.select(F.col("k").alias("j"), F.col("line").alias("other")), F.col("k") == F.col("j"))
        plain = numbers.join(
            numbers.filter("line < 1000").select(F.col("k").alias("j"), F.col("line").alias("other")), F.col("k") == F.col("j"))
        assert len(exchanges(met)) == 0 and len(exchanges(plain)) == 2
        assert met.count() == plain.count()
        again = layouts.open_bucketed(spark, str(tmp_path / "l"), "k", 8)
        assert again.schema.simpleString() == left.schema.simpleString() and not exchanges(again.groupBy("k").count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_bucket_is_left_to_run_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layouts, "HOT_ROWS", 1000)
    monkeypatch.setattr(layouts, "HOT_SHARE", 4)
    df = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"))
    table = layouts.write_bucketed(df, str(tmp_path / "t"), "k", 16)
    assert exchanges(table.groupBy("k").count()) and table.count() == 10_000


def test_payments_meet_their_invoice_without_an_exchange(spark, sf_dir, tmp_path, rows):
    stored = domain.warehouse(spark, sf_dir, store=str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = stored["fct_payments"]
        plan = facts._jdf.queryExecution().executedPlan().toString()
        assert "invoice_id" in plan and not re.search(r"hashpartitioning\(invoice_id", plan)
        lines = stored["fct_invoices"]._jdf.queryExecution().executedPlan().toString()
        # the header comes to the lines, the lines stay
        assert len(re.findall(r"hashpartitioning\(invoice_id", lines)) <= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(facts) == rows(domain.warehouse(spark, sf_dir)["fct_payments"])


def test_point_lookups_read_few_rows(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("parquet.page.row.count.limit", "1000")
    try:
        table = layouts.write_lookup(numbers.coalesce(4), path, "k", ["name"], group_bytes=1 << 16, distinct=5_000)
    finally:
        spark.conf.unset("parquet.page.row.count.limit")
    found, _, read, _ = executed(table.filter("k = 77"))
    assert sorted(r.line for r in found) == sorted(r.line for r in numbers.filter("k = 77").collect())
    assert read <= 4_000
    name = numbers.filter("line = 12345").first().name
    found, _, read, _ = executed(table.filter(F.col("name") == name))
    assert [r.line for r in found] == [12345] and read <= 8_000
    assert executed(numbers.filter("k = 77"))[0] != []


def test_point_lookups_of_marts(spark, sf_dir, tmp_path, rows):
    wh = domain.warehouse(spark, sf_dir)
    written = domain.warehouse(spark, sf_dir).build(str(tmp_path))
    who = wh["fct_invoices"].join(wh["dim_customer"], "customer_sk").select("customer_id").first()[0]
    lazy = serving.recent_invoices(wh["fct_invoices"], wh["dim_customer"], who)
    point = serving.recent_invoices(written["fct_invoices"], written["dim_customer"], who, point=True)
    assert rows(point) == rows(lazy) and rows(point)
    assert "In(customer_sk" in point._jdf.queryExecution().executedPlan().toString() or "EqualTo(customer_sk" in (
        point._jdf.queryExecution().executedPlan().toString())


def test_zorder_skips_on_every_column(spark, tmp_path):
    grid = spark.range(400_000).select(
        (F.col("id") % 1000).alias("a"), F.concat(F.lit("d"), F.lpad((F.col("id") / 1000).cast("int").cast("string"), 5, "0")).alias("b"))
    table = layouts.write_zordered(grid.repartition(4), str(tmp_path / "z"), ["a", "b"], group_bytes=1 << 14)
    for condition in ("a between 100 and 110", "b between 'd00100' and 'd00105'"):
        found, _, read, _ = executed(table.filter(condition))
        assert len(found) == grid.filter(condition).count() and read < 120_000
    both = executed(table.filter("a < 50 and b < 'd00020'"))
    assert len(both[0]) == 1000 and both[2] < 30_000


def test_zorder_of_odd_columns(spark, tmp_path, rows):
    data = [(None, None), (1, "x"), (1, None), (None, "y"), (5, "x")] * 3
    df = spark.createDataFrame(data, "a int, b string")
    assert rows(layouts.write_zordered(df, str(tmp_path / "z"), ["a", "b"])) == rows(df)
    none = df.filter("a > 9")
    assert layouts.write_zordered(none, str(tmp_path / "n"), ["a", "b"]).count() == 0


def test_a_filtered_calendar_reads_its_months(spark, sf_dir):
    tables = star(spark, sf_dir)
    year = tables["invoices"].agg(F.min("invoice_date_key")).first()[0] // 10000
    question = semantic.revenue_by_category(tables, year, 2)
    plan = question._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    _, _, _, files = executed(question)
    every = executed(semantic.semantic_query(semantic.CONTRACT_REVENUE, tables, ["total_revenue"], ["category"]))[3]
    assert files < every / 3


def test_a_filtered_dimension_becomes_a_bloom_filter(spark, sf_dir):
    """Beyond the size from which Spark thinks it worth while, the fact is filtered before its shuffle."""
    tables = star(spark, sf_dir)
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        question = semantic.average_invoice(tables, "monthly")
        assert "might_contain" in question._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


KINDS = [sketches.Distinct("d", "k"), sketches.Quantiles("q", "v"), sketches.Top("t", "s")]


def test_daily_sketches_merge_within_their_bounds(spark, tmp_path):
    rows = spark.range(200_000).select(
        (F.col("id") % 30).alias("day"), F.pmod(F.xxhash64("id"), F.lit(50_000)).alias("k"),
        (F.col("id") % 10_007).cast("int").alias("v"), (F.floor(F.log2(F.col("id") + 1))).alias("s"))
    for part in (0, 1, 2):
        table = sketches.append_daily(rows.filter(F.col("v") % 3 == part), str(tmp_path / "t"), ["day"], KINDS)
    assert table.count() == 90
    whole = sketches.merged(table.withColumn("all", F.lit(1)), ["all"], KINDS).select(
        "rows", sketches.distinct_count("d"), sketches.quantile("q", 0.9), sketches.top("t", 2)).first()
    exact = rows.agg(F.count_distinct("k")).first()[0]
    assert whole[0] == 200_000 and abs(whole[1] - exact) < 0.03 * exact
    assert abs(whole[2] - 0.9 * 10_007) < 0.02 * 10_007
    assert [(t["item"], t["count"]) for t in whole[3]] == [
        (r.s, r["count"]) for r in rows.groupBy("s").count().orderBy(F.desc("count")).limit(2).collect()]


def test_sketches_of_nothing(spark):
    rows = spark.createDataFrame([(1, None, None, None)], "day int, k long, v int, s string")
    found = sketches.daily(rows, ["day"], KINDS).select(
        "rows", sketches.distinct_count("d"), sketches.quantile("q", 0.5), F.size(sketches.top("t", 3))).first()
    assert tuple(found)[:3] == (1, 0, None)
    assert sketches.daily(rows.filter("day > 1"), ["day"], KINDS).count() == 0


def test_a_key_is_made_where_its_month_is(spark, tmp_path, rows):
    df = spark.range(50).select(F.md5(F.col("id").cast("string")).alias("k_sk"), (F.col("id") + 20240100).alias("day"), "id")
    table = layouts.write_by_month(df, str(tmp_path / "t"), "day", "k_sk", {"k_sk": F.md5(F.col("id").cast("string"))})
    assert rows(table, *df.columns) == rows(df)


def test_a_question_builds_only_what_it_names(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(domain, "_MARTS", {})
    semantic.late_payments_by_method(star(spark, sf_dir), 1998, 1).collect()
    built = set(domain.stored_marts(spark, sf_dir)._models)
    assert "fct_payments" in built
    assert not built & {"fct_invoices", "stg_oltp__invoice_line_items", "dim_product"}


def test_staging_of_one_reader_is_not_written(spark, sf_dir, tmp_path, rows, monkeypatch):
    written = []
    monkeypatch.setattr(domain, "_MARTS", {})
    monkeypatch.setattr(Warehouse, "_write", lambda wh, name, model, path: written.append(name) or model)
    wh = domain.stored_marts(spark, sf_dir)
    assert "invoices" in star(spark, sf_dir) and rows(wh["fct_payments"]) == rows(
        domain.warehouse(spark, sf_dir)["fct_payments"])
    wh["fct_invoices"]
    assert {"fct_invoices", "fct_payments", "stg_oltp__invoices"} <= set(written)
    assert not {"stg_oltp__invoice_line_items", "stg_oltp__payments"} & set(written)


def test_keys_of_facts_are_made_in_their_folder(spark, sf_dir, rows, monkeypatch):
    """No key of 32 digits is sent there, and the rows are those of the lazy model."""
    sent = {}

    def write(df, path, date_key, *rest):
        sent[date_key] = df.columns
        return layouts.write_by_month(df, path, date_key, *rest)

    monkeypatch.setattr(domain, "_MARTS", {})
    monkeypatch.setattr(warehouse, "write_by_month", write)
    stored, lazy = domain.stored_marts(spark, sf_dir), domain.warehouse(spark, sf_dir)
    for name in ("fct_invoices", "fct_payments"):
        assert rows(stored.mart(name)) == rows(lazy.mart(name))
    assert set(sent) == {"invoice_date_key", "payment_date_key"}
    assert not [c for columns in sent.values() for c in columns if c.endswith("_sk") or c == "net_amount"]


def test_facts_of_unknown_parents_have_no_keys(spark, rows):
    """A key is that of the dimension's row, so without one there is none; a version's start may be unknown."""
    def frame(data, schema):
        return spark.createDataFrame(data, schema)

    customers = marts.dim_customer(frame([(1, None, None)], "customer_id bigint, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
        .select("*", *[F.lit("x").alias(c) for c in (
            "email", "first_name", "last_name", "phone", "address", "postal_code", "municipality", "region", "country", "segment", "status")]))
    homes = frame([(5, "h5")], "household_id bigint, household_sk string")
    deals = frame([], "contract_id bigint, contract_sk string, valid_from timestamp_ntz, is_current boolean")
    days = frame([], "full_date date, date_key int")
    invoices = frame([(1, 5, 7, None)], "invoice_id bigint, household_id bigint, contract_id bigint, due_date date")
    payments = frame(
        [(10, 1, 1, None, None, "card", "done"), (11, 2, None, None, None, "card", "done")],
        "payment_id bigint, invoice_id bigint, customer_id bigint, payment_date date, payment_amount decimal(12,2), payment_method string, status string")
    want = customers.first()["customer_sk"]
    for in_buckets in (False, True):
        found = marts.fct_payments(payments, invoices, customers, homes, deals, days, in_buckets=in_buckets)
        known = frame([(5,)], "k bigint").select(surrogate_key("k")).first()[0]
        assert rows(found, "payment_id", "customer_sk", "household_sk", "contract_sk", "is_late_payment") == [
            (10, want, known, None, False), (11, None, None, None, False)]


def test_invoices_stored_without_their_lines_are_not_bucketed(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(domain, "_MARTS", {})
    monkeypatch.setattr(warehouse, "write_bucketed", lambda *_: pytest.fail("nothing meets these buckets"))
    assert domain.stored_marts(spark, sf_dir)["stg_oltp__invoices"].count() > 0


def shuffled(spark):
    """Shuffle files on disk and their bytes."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in map(files.apply, range(files.size())) if f.getName().startswith("shuffle")}


def test_a_write_gives_back_its_shuffle_files(spark, numbers, tmp_path):
    """Else the disk of a build holds those of every table written so far."""
    rows = numbers.withColumn("day", F.lit(20240101)).repartition(3, "line")
    kept = spark.conf.get(sinks.CLEANUP)
    for write in (
        lambda: sinks.write_table(rows, str(tmp_path / "a")),
        lambda: sinks.write_clustered(rows, str(tmp_path / "b"), "line"),
        lambda: layouts.write_lookup(rows, str(tmp_path / "c"), "line"),
        lambda: layouts.write_by_month(rows, str(tmp_path / "d"), "day"),
        lambda: layouts.write_bucketed(rows, str(tmp_path / "e"), "line", 4),
    ):
        before, deadline = shuffled(spark), time.time() + 10
        table = write()
        while (left := sum(n for f, n in shuffled(spark).items() if f not in before)) > 1e6 and time.time() < deadline:
            time.sleep(0.2)
        assert left < 1e6 and table.count() == 400_000
    assert spark.conf.get(sinks.CLEANUP) == kept


def test_marts_built_in_turn_leave_no_shuffle_files(spark, sf_dir, monkeypatch):
    """What lies on disk while one is built is its own, not what all before it have sent."""
    monkeypatch.setattr(domain, "_MARTS", {})
    before, deadline = shuffled(spark), time.time() + 10
    quality_queries.d13(spark, sf_dir)
    while (left := sum(n for f, n in shuffled(spark).items() if f not in before)) > 1e4 and time.time() < deadline:
        time.sleep(0.2)
    assert left <= 1e4
