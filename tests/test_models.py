"""Given rows and expected rows of the models, and the rules their quirks call for."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridmart.functions import boundaries_between, surrogate_key, title_case
from gridmart.operators.chunks import chunk_documents, chunk_tokens
from gridmart.operators.joins import not_in
from gridmart.plans import intermediate, marts, serving, staging
from gridmart.sources.calendar import date_dimension, dates_over, time_dimension
from workload import domain, model_queries, registry


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_revenue_class_and_net_amount(spark, rows):
    money = "decimal(12,2)"
    lines = frame(spark, [
        (1, 1, 101, "a", 1, Decimal("1299.00"), Decimal("1299.00"), Decimal("324.75")),
        (2, 1, 201, "b", 1, Decimal("500.00"), Decimal("500.00"), Decimal("125.00")),
        (3, 1, 999, "c", 1, Decimal("10.00"), Decimal("10.00"), None),
        (4, 7, 101, "no invoice", 1, Decimal("10.00"), Decimal("10.00"), None),
    ], f"line_item_id bigint, invoice_id bigint, product_id bigint, description string, quantity bigint, unit_price {money}, amount {money}, tax_amount {money}")
    invoices = frame(spark, [(1, 1001, 2001, 3001, date(2025, 1, 31), date(2025, 2, 28), "issued")],
        "invoice_id bigint, customer_id bigint, household_id bigint, contract_id bigint, invoice_date date, due_date date, status string")
    products = frame(spark, [(101, "x", "device", "premium"), (201, "y", "service", "standard")],
        "product_id bigint, product_name string, category string, pricing_tier string")
    contracts = frame(spark, [(3001, 1, "residential_energy")], "contract_id bigint, tariff_plan_id bigint, contract_type string")
    enriched = intermediate.invoice_enriched(lines, invoices, products, contracts)
    assert rows(enriched, "line_item_id", "revenue_classification", "net_amount") == [
        (1, "hardware_revenue", Decimal("974.25")),
        (2, "service_revenue", Decimal("375.00")),
        (3, "other_revenue", Decimal("10.00")),
    ]


def people(spark):
    customers = frame(spark, [(1001, "Anna@nordic.example"), (1002, "lars@nordic.example"), (1003, "anna@nordic.example"), (1004, None)],
        "customer_id bigint, email string")
    for name in ("first_name", "last_name", "phone", "address", "postal_code", "municipality", "region", "country", "segment", "status"):
        customers = customers.withColumn(name, F.lit(None).cast("string"))
    customers = customers.withColumn("created_at", F.lit(None).cast("timestamp_ntz")).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    contacts = frame(spark, [
        ("CON-1", "ACC-1", "ANNA@nordic.example", date(2025, 1, 1), date(2025, 1, 5)),
        ("CON-2", "ACC-2", "anna@nordic.example", date(2025, 1, 1), None),
        ("CON-3", "ACC-1", "nobody@nordic.example", date(2025, 1, 1), None),
        ("CON-4", "ACC-1", None, date(2025, 1, 1), None),
    ], "contact_id string, account_id string, email string, created_date date, last_modified_date date")
    contacts = contacts.withColumns({c: F.lit(None).cast("string") for c in ("title", "department")})
    accounts = frame(spark, [("ACC-1", "Jensen Household")], "account_id string, account_name string")
    return customers, contacts, accounts


def test_entity_match(spark, rows):
    profile = intermediate.unified_profile(*people(spark))
    assert rows(profile, "customer_id", "match_status", "crm_contact_id", "crm_account_name") == [
        (1001, "matched", "CON-1", "Jensen Household"),
        (1002, "oltp_only", None, None),
        (1003, "matched", "CON-1", "Jensen Household"),
        (1004, "oltp_only", None, None),
    ]


def test_entity_match_can_keep_contacts_without_customer(spark, rows):
    profile = intermediate.unified_profile(*people(spark), keep_crm_only=True)
    assert rows(profile.filter("customer_id IS NULL"), "crm_contact_id", "match_status") == [("CON-3", "crm_only")]


def test_daily_telemetry(spark, rows):
    def moment(hour):
        return datetime(2025, 2, 1, hour)

    energy = frame(spark, [("4001", moment(8), Decimal("5.2")), ("4001", moment(12), Decimal("8.7")), ("4001", moment(18), Decimal("3.1"))],
        "device_id string, event_timestamp timestamp_ntz, kwh_reading decimal(12,4)")
    temperature = frame(spark, [("4001", moment(8), Decimal("20.5")), ("4001", moment(18), Decimal("22.1")), ("4002", moment(1), Decimal("5"))],
        "device_id string, event_timestamp timestamp_ntz, temperature_celsius decimal(6,2)")
    daily = intermediate.telemetry_daily(energy, temperature)
    as_numbers = daily.select("device_id", "reading_date", *[F.col(c).cast("double") for c in ("total_kwh", "peak_kwh", "avg_temperature")], "total_reading_count")
    assert rows(as_numbers) == [
        ("4001", date(2025, 2, 1), 17.0, 8.7, 21.3, 5),
        ("4002", date(2025, 2, 1), None, None, 5.0, 1),
    ]


@pytest.mark.parametrize(
    "master, heartbeat, seen, installed, state",
    [
        ("decommissioned", "online", 31, True, "decommissioned"),
        ("active", "offline", 28, True, "decommissioned"),
        ("active", "offline", 31, True, "inactive"),
        ("active", "degraded", 1, True, "degraded"),
        ("inactive", "online", 1, True, "active"),
        ("active", None, 1, True, "active"),
        ("active", None, 1, False, "provisioned"),
    ],
)
def test_lifecycle_state(spark, rows, master, heartbeat, seen, installed, state):
    devices = frame(spark, [(1, "s", 2, "t", "m", "o", "1", date(2025, 1, 1) if installed else None, master, None, None)],
        "device_id bigint, device_serial string, household_id bigint, device_type string, manufacturer string, model string, "
        "firmware_version string, installed_at date, status string, created_at timestamp_ntz, updated_at timestamp_ntz")
    stamps = [("1", heartbeat, datetime(2025, 1, seen, 12), datetime(2025, 1, seen, 13)), ("not a number", "online", datetime(2025, 1, 1), datetime(2025, 1, 1))]
    status = frame(spark, stamps if heartbeat else stamps[1:],
        "device_id string, status string, event_timestamp timestamp_ntz, _loaded_at timestamp_ntz")
    lifecycle = intermediate.device_lifecycle(devices, status, F.lit("2025-02-01 00:00:00").cast("timestamp_ntz"))
    assert rows(lifecycle, "device_id", "lifecycle_state") == [(1, state)]


def test_one_geography_per_area_and_country(spark, rows):
    customers = frame(spark, [("1", "M", "R2", "DK"), ("1", "M", "R1", "DK"), ("1", "M", "R3", "SE"), (None, "M", "R", "DK"), ("3", None, "R", "DK")],
        "postal_code string, municipality string, region string, country string")
    households = frame(spark, [("1", "M", "DK"), ("2", "N", "DK"), ("3", None, "DK")], "postal_code string, municipality string, country string")
    dim = marts.dim_geography(customers, households)
    assert rows(dim, "postal_code", "municipality", "region", "country") == [
        ("1", "M", "R1", "DK"), ("1", "M", "R3", "SE"), ("2", "N", None, "DK"), ("3", None, "R", "DK"),
    ]
    assert dim.select("geography_sk").distinct().count() == 4


def test_telemetry_keys_of_clock_and_minute(spark, rows):
    events = frame(spark, [("1", datetime(2025, 1, 1, 13, 5), "device_status", None), ("x", datetime(2030, 1, 1, 0, 59), "alert_event", Decimal("1"))],
        "device_id string, event_timestamp timestamp_ntz, event_type string, reading_value decimal(12,4)")
    devices = frame(spark, [(1, "sk1", 9)], "device_id bigint, device_sk string, household_id bigint")
    households = frame(spark, [(9, "hk9")], "household_id bigint, household_sk string")
    dims = (devices, households, date_dimension(spark, "2024-01-01", "2026-12-31"), time_dimension(spark))
    columns = ("device_id", "device_sk", "household_sk", "date_key", "time_key")
    assert rows(marts.fct_device_telemetry(events, *dims), *columns) == [
        ("1", "sk1", "hk9", 20250101, 1305), ("x", None, None, None, 59),
    ]
    by_minute = marts.fct_device_telemetry(events, *dims, time_of="minute")
    assert rows(by_minute, "device_id", "time_key") == [("1", None), ("x", 59)]


def test_repeated_events_get_keys_of_their_own(spark):
    events = frame(spark, [("1", datetime(2025, 1, 1), "device_status", None)] * 3,
        "device_id string, event_timestamp timestamp_ntz, event_type string, reading_value decimal(12,4)")
    devices = frame(spark, [], "device_id bigint, device_sk string, household_id bigint")
    households = frame(spark, [], "household_id bigint, household_sk string")
    fact = marts.fct_device_telemetry(
        events, devices, households, date_dimension(spark, "2024-01-01", "2026-12-31"), time_dimension(spark), unique_events=False)
    assert fact.select("telemetry_sk").distinct().count() == 3


def test_unknown_devices_keep_distinct_daily_keys(spark):
    daily = frame(spark, [("a", date(2025, 1, 1)), ("b", date(2025, 1, 1))], "device_id string, reading_date date")
    daily = daily.withColumns({c: F.lit(None).cast("double") for c in ("total_kwh", "peak_kwh", "avg_temperature", "total_reading_count")})
    devices = frame(spark, [], "device_id bigint, device_sk string, household_id bigint")
    households = frame(spark, [], "household_id bigint, household_sk string, customer_id bigint")
    customers = frame(spark, [], "customer_id bigint, customer_sk string, is_current boolean")
    fact = marts.fct_energy_usage_daily(daily, devices, households, customers, date_dimension(spark, "2024-01-01", "2026-12-31"))
    assert fact.select("energy_usage_daily_sk").distinct().count() == 2


def test_weights_of_a_ticket_sum_to_one(spark, rows):
    tickets = frame(spark, [("T1", "C1"), ("T2", None), ("T3", "C9")], "ticket_id string, contact_id string")
    profile = frame(spark, [("C1", 1), ("C1", 2), ("C1", 3), (None, 4)], "crm_contact_id string, customer_id bigint")
    customers = frame(spark, [(1, "s1", True), (2, "s2", True), (3, "s3", False)], "customer_id bigint, customer_sk string, is_current boolean")
    bridge = marts.bridge_service_ticket_customer(tickets, profile, customers)
    assert rows(bridge, "ticket_id", "customer_id", "allocation_pct") == [("T1", 1, 0.5), ("T1", 2, 0.5)]


def test_surrogate_keys_tell_null_from_empty(spark):
    df = frame(spark, [("a", None), ("a", ""), (None, "a"), ("", "a")], "x string, y string")
    keys = df.select(surrogate_key("x", "y").alias("k"))
    assert keys.distinct().count() == 4 and keys.filter("k IS NULL").count() == 0


def test_hour_boundaries(spark):
    df = frame(spark, [(datetime(2025, 1, 1, 0, 59), datetime(2025, 1, 1, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    units = [boundaries_between(u, F.col("a"), F.col("b")) for u in ("minute", "hour", "day")]
    assert tuple(df.select(*units).first()) == (2, 1, 0)


@pytest.mark.parametrize("text, expected", [
    ("jean-luc O'BRIEN", "Jean-Luc O'brien"), ("anna  maria", "Anna  Maria"), ("ÅSE.østergård", "Åse.Østergård"),
    ("a/b(c)", "A/B(C)"), ("", ""), (None, None),
])
def test_title_case(spark, text, expected):
    assert frame(spark, [(text,)], "t string").select(title_case(F.col("t"))).first()[0] == expected


def test_not_in_is_empty_once_the_parent_has_a_null(spark, rows):
    child = frame(spark, [(1,), (2,), (None,)], "k bigint")
    assert rows(not_in(child, "k", frame(spark, [(1,)], "p bigint"), "p")) == [(2,)]
    assert rows(not_in(child, "k", frame(spark, [(1,), (None,)], "p bigint"), "p")) == []
    assert rows(not_in(child, "k", frame(spark, [], "p bigint"), "p")) == [(1,), (2,)]


def test_chunks_cover_whole_texts_and_overlap(spark):
    counts = [0, 1, 50, 51, 512, 513, 974, 975, 3000]
    docs = frame(spark, [(n, " \n".join(f"w{i}" for i in range(n))) for n in counts], "doc_id bigint, text string")
    chunks = {}
    for key, index, n, text in chunk_documents(docs).orderBy("doc_id", "chunk_index").collect():
        words = text.split(" ")
        assert len(words) == n <= 512
        chunks.setdefault(key, []).append(words)
    assert 0 not in chunks
    for n in counts[1:]:
        parts = chunks[n]
        whole = parts[0] + [w for p in parts[1:] for w in p[50:]]
        assert whole == [f"w{i}" for i in range(n)]
        assert all(a[-50:] == b[:50] for a, b in zip(parts, parts[1:]))
    with pytest.raises(ValueError):
        chunk_documents(docs, size=10, overlap=10)


def test_search_takes_wildcards_literally(spark, rows):
    profile = frame(spark, [(2, "a_b@x", "Ann", "Lee"), (1, "axb@x", "A%n", "Lee")], "customer_id bigint, email string, first_name string, last_name string")
    profile = profile.withColumns({c: F.lit(0) for c in (
        "segment", "region", "country", "status", "total_contracts", "active_contracts", "active_device_count",
        "lifetime_invoice_total", "total_service_tickets")})
    assert rows(serving.customer_search(profile, "A_B"), "customer_id") == [(2,)]
    assert rows(serving.customer_search(profile, "a%N l"), "customer_id") == [(1,)]
    assert [r[0] for r in serving.customer_search(profile, "LEE", rows=1).collect()] == [1]


def test_calendar(spark, rows):
    facts = spark.createDataFrame([(date(2024, 5, 5), None), (date(2026, 1, 1), None)], "a date, b timestamp_ntz")
    nothing = facts.filter("false")
    assert dates_over([(nothing, "a"), (facts, "b")]).count() == 0
    covering = dates_over([(facts, "a"), (facts, "b"), (nothing, "a")])
    days = date_dimension(spark, "2024-01-01", "2026-12-31")
    assert covering.exceptAll(days).count() == 0 and covering.count() == days.count()
    assert days.count() == 1096
    assert rows(days.filter("date_key = 20241230"), "day_of_week", "week_number_iso", "is_weekend", "fiscal_quarter") == [("Monday", 1, False, 4)]
    assert days.filter("is_danish_public_holiday").count() == 15
    minutes = time_dimension(spark)
    assert minutes.count() == 1440
    assert minutes.filter("is_business_hour").count() == 9 * 60
    assert rows(minutes.filter("time_key = 1759"), "time_of_day_band") == [("afternoon",)]


def test_every_cdc_table_has_a_key():
    assert len(staging.CDC_KEYS) == 11 and len(staging.SAAS_KEYS) == 8 and len(staging.TELEMETRY_MODELS) == 4


def test_token_chunks_are_cuts_of_the_text(spark):
    texts = ["Ein  Wort,\n(noch 12)", "日本語のテキスト" * 9, "a" * 2000, "x" + "!" * 99, " \t\n", "", None, "é😀 ́"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {}
    for r in chunk_tokens(docs, size=10, overlap=3).orderBy("doc_id", "chunk_index").collect():
        assert 0 < r.token_count <= 10 and r.chunk_text in texts[r.doc_id] and r.chunk_text == r.chunk_text.strip()
        found.setdefault(r.doc_id, []).append((r.token_count, r.chunk_text))
    assert set(found) == {0, 1, 2, 3, 7}
    assert found[0] == [(8, "Ein  Wort,\n(noch 12)")] and found[2] == [(1, "a" * 2000)]
    assert [n for n, _ in found[3]] == [10] * 13 + [9] and found[3][0][1] == "x" + "!" * 9


def test_the_profile_stores_what_it_reads_more_than_once(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(model_queries, "scratch_path", lambda spark, purpose: str(tmp_path))
    profile = registry.SPARK["c24_customer_360"](spark, sf_dir)
    stored = {"int_customer__unified_profile", "int_service__ticket_enriched", "stg_crm__contacts"}
    assert {p.name for p in (tmp_path / "shared").iterdir()} == stored
    plain = domain.warehouse(spark, sf_dir)["customer_360"]
    assert profile.exceptAll(plain).count() == plain.exceptAll(profile).count() == 0
    wh = domain.warehouse(spark, sf_dir)
    assert wh.read_often("bridge_service_ticket_customer") == {"stg_crm__contacts"}
    assert "stg_iot__all_events" in wh.read_often("fct_energy_usage_daily")
