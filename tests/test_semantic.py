"""Names, synonyms, filters and two facts in one question."""

from decimal import Decimal

import pytest

from gridmart.plans.semantic import CONTRACT_REVENUE as MODEL
from gridmart.plans.semantic import OPERATIONS, semantic_query


@pytest.fixture(scope="module")
def star(spark):
    money = "decimal(12,2)"
    return {
        "invoices": spark.createDataFrame(
            [("l1", "c1", "k1", "p1", 1, Decimal(10), 1), ("l2", "c1", "k1", "p1", 1, Decimal(30), 1), ("l3", "c2", "k1", None, 2, Decimal(5), 1), ("l4", None, None, None, None, None, 1)],
            f"invoice_line_sk string, customer_sk string, contract_sk string, product_sk string, invoice_date_key int, amount {money}, quantity bigint"),
        "payments": spark.createDataFrame(
            [("a", "c1", "k1", 1, Decimal(7), True, "card"), ("b", "c3", "k1", 1, Decimal(8), False, "card")],
            f"payment_sk string, customer_sk string, contract_sk string, payment_date_key int, payment_amount {money}, is_late_payment boolean, payment_method string"),
        "customers": spark.createDataFrame([("c1", 1, "home"), ("c2", 2, "office"), ("c3", 3, "farm")], "customer_sk string, customer_id bigint, segment string"),
        "contracts": spark.createDataFrame([("k1", "energy")], "contract_sk string, contract_type string"),
        "products": spark.createDataFrame([("p1", "device")], "product_sk string, category string"),
        "dates": spark.createDataFrame([(1, 2024), (2, 2025)], "date_key int, year int"),
    }


def ask(star, *args, **kwargs):
    return semantic_query(MODEL, star, *args, **kwargs)


def test_metrics_win_over_facts():
    assert MODEL.metric("revenue").name == "total_revenue"
    assert MODEL.metric("Sales Amount").name == "revenue_amount"
    assert MODEL.metric("payments.late_payment_count").kind == "count_if"
    assert MODEL.dimension("contracts.STATUS").table == "contracts"
    for lookup in (MODEL.metric, MODEL.dimension):
        with pytest.raises(ValueError, match="unknown"):
            lookup("profit")


def test_facts_without_a_parent_are_kept(star, rows):
    assert rows(ask(star, ["revenue", "invoice_count", "mean invoice amount"], ["customer type"])) == [
        (None, None, 1, None), ("home", Decimal(40), 2, 20.0), ("office", Decimal(5), 1, 5.0),
    ]


def test_filters_drop_facts_without_a_parent(star, rows):
    found = ask(star, ["revenue"], ["segment"], {"yr": lambda c: c == 2024})
    assert rows(found) == [("home", Decimal(40))]


def test_two_facts_do_not_multiply(star, rows):
    found = ask(star, ["revenue", "cash collected", "late payments"], ["segment"])
    assert rows(found, "segment", "total_revenue", "total_payments", "late_payment_count") == [
        (None, None, None, None), ("farm", None, Decimal(8), 0), ("home", Decimal(40), Decimal(7), 1), ("office", Decimal(5), None, None),
    ]


def test_totals_without_dimensions(star, rows):
    assert rows(ask(star, ["revenue", "total_payments"])) == [(Decimal(45), Decimal(15))]


def test_order_and_limit(star):
    found = ask(star, ["revenue"], ["customer_id"], order_by="total sales", limit=1).collect()
    assert [tuple(r) for r in found] == [(1, Decimal(40))]


def test_unrelated_dimension_is_refused(star):
    with pytest.raises(ValueError, match="no relationship from payments to products"):
        ask(star, ["total_payments"], ["category"])


def test_filtered_keys_meet_the_fact_before_anything_is_summed(star):
    """The calendar's keys are sent to the scan; a table that only filters is not joined again."""
    found = ask(star, ["revenue"], ["segment"], {"yr": lambda c: c == 2024})
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    semi = next(i for i, line in enumerate(plan) if "LeftSemi" in line)
    assert "BroadcastHashJoin" in plan[semi]
    first_sum = max(i for i, line in enumerate(plan) if "partial_sum" in line)
    assert first_sum < semi and not any("Exchange" in line for line in plan[first_sum:semi])
    assert sum("date_key" in line and "Join" in line for line in plan) == 1


def test_ratios_and_conditions(spark, rows):
    profiles = spark.createDataFrame(
        [("home", "active", 1, 2), ("home", "gone", 0, 2), ("farm", "active", 0, 0)],
        "segment string, status string, active_device_count bigint, total_device_count bigint")
    found = semantic_query(OPERATIONS, {"profiles": profiles}, ["active_customer_count", "device_uptime_rate"], ["customer_segment"])
    assert rows(found) == [("farm", 1, None), ("home", 1, 0.25)]


def test_facts_shrink_before_they_meet_a_dimension(star):
    plan = ask(star, ["revenue"], ["segment"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate")


def test_a_filtered_dimension_that_is_asked_for_is_joined_once(spark, star, rows):
    """Its filter and its columns come in one join, and no fact's own key travels to be counted."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ask(star, ["invoice_count", "revenue"], ["segment", "category"], {"segment": lambda c: c == "home"})
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert rows(found, "segment", "category", "invoice_count", "total_revenue") == rows(
            ask(star, ["invoice_count", "revenue"], ["segment", "category"]).filter("segment = 'home'"),
            "segment", "category", "invoice_count", "total_revenue")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2 and "LeftSemi" not in plan
    assert not [line for line in plan.splitlines() if "Project [" in line and "invoice_line_sk" in line and "isnotnull" not in line]


def test_calendar_columns_replace_days_before_the_fact_travels(star):
    plan = ask(star, ["revenue"], ["segment", "yr"])._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not any("Exchange" in line and "date_key" in line and "Broadcast" not in line for line in plan)
