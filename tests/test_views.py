"""Properties that hold between views, and views over empty tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import small
from mercata.functions import labels
from mercata.plans import analyses, catalog, checks, mart, overview
from mercata.plans.workspace import Workspace
from mercata.schemas import TABLES

LOW = {
    "vw_category_growth": {"start": small.FIRST.replace(year=2019), "min_orders": 2},
    "vw_seller_scorecard": {"min_orders": 2},
    "vw_delivery_route": {"min_orders": 1},
}


@pytest.fixture(scope="module")
def tables(spark):
    w = Workspace(spark, small.source(spark), small.PLAN)
    return {n: w[n] for n in catalog.BASE_TABLES}


def total(df, column="revenue"):
    return df.agg(F.sum(column)).first()[0]


def test_revenue_is_the_same_in_every_view(tables):
    want = total(tables["fct_order_items"], "item_revenue")
    for name in ("vw_daily_kpi", "vw_category_contribution", "vw_state_revenue", "vw_category_segment",
                 "vw_category_perf", "vw_seller_concentration", "vw_seller_detail"):
        assert total(catalog.view(tables, name)) == want, name
    assert total(catalog.view(tables, "vw_detail_items"), "item_revenue") == want


def test_shares_add_up(tables):
    rows = catalog.view(tables, "vw_category_segment").groupBy("category_en").agg(
        F.sum("pct_within_category").alias("s"), F.count("*").alias("n")).collect()
    assert all(abs(r.s - 100) <= Decimal("0.005") * r.n for r in rows)
    contribution = catalog.view(tables, "vw_category_contribution")
    assert contribution.agg(F.max("pct_cumulative")).first()[0] == 100
    curve = catalog.view(tables, "vw_seller_concentration").agg(
        F.max("pct_sellers_cumulative"), F.max("pct_revenue_cumulative"), F.min("revenue")).first()
    assert tuple(curve) == (100, 100, 0)  # a seller without sales is on the curve


def test_customer_summary(tables):
    rows = {r.customer_type: r for r in catalog.view(tables, "vw_customer_summary").collect()}
    assert rows["One-time"].avg_orders_per_customer == 1
    assert rows["Repeat"].avg_orders_per_customer > 1


def test_every_view_by_name_and_by_sql(spark, tables):
    catalog.register_views(tables, **LOW)
    for name in catalog.VIEWS:
        want = catalog.view(tables, name, **LOW.get(name, {}))
        got = spark.sql(f"select * from {name}")
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name
    assert spark.sql("select category_en from vw_category_contribution order by revenue desc limit 2").count() == 2
    assert catalog.view(tables, "vw_detail_items", limit=3).count() == 3


def test_thresholds_are_arguments(tables):
    assert catalog.view(tables, "vw_seller_scorecard", min_orders=10**6).isEmpty()
    few = catalog.view(tables, "vw_category_contribution", top=1)
    assert few.where("category_display = 'Others'").count() == few.count() - 1
    assert few.where("category_sorted = '99. Others'").count() == few.count() - 1


def test_ranks_of_three_digits_sort_as_text(spark):
    ranks = spark.range(1, 131).select(F.col("id").alias("r"), F.lit("x").alias("n"))
    got = [r[0] for r in ranks.orderBy("r").select(labels.top_sort_label("r", "n", 120)).collect()]
    assert got == sorted(got) and got[99] == "100. x" and got[-1] == "999. Others"


def test_empty_tables(spark):
    empty = {n: spark.createDataFrame([], TABLES[n].ddl.replace(" not null", "")) for n in catalog.BASE_TABLES}
    for name in catalog.VIEWS:
        rows = catalog.view(empty, name).collect()
        assert len(rows) == (1 if name == "vw_pipeline_health" else 0), name
    health = catalog.view(empty, "vw_pipeline_health").first()
    assert health.so_batch_da_chay == 0 and health.batch_gan_nhat is None
    assert analyses.totals(empty["fct_order_items"]).first().orders == 0


def test_filtering_before_aggregating_restores_shares(tables):
    items = tables["fct_order_items"]
    wanted = {"seller_state": ["S0", "S1"]}
    whole = overview.vw_category_contribution(items)
    part = analyses.recomputed(overview.vw_category_contribution, [items], wanted)
    assert part.agg(F.max("pct_cumulative")).first()[0] == 100
    assert total(part) < total(whole)
    with pytest.raises(ValueError):
        analyses.filtered(items, product_id="p1")
    with pytest.raises(ValueError):
        analyses.order_weighted(items, tables["fct_orders"], ["product_id"])


def test_an_order_counts_once_per_combination(tables):
    detail = catalog.view(tables, "vw_detail_items")
    by_status = analyses.order_weighted(detail, tables["fct_orders"], ["order_status"])
    orders_with_items = tables["fct_order_items"].select("order_id").distinct().count()
    assert total(by_status, "orders") == orders_with_items
    one = analyses.review_weight_bias(detail, tables["fct_orders"]).first()
    plain = tables["fct_orders"].agg(F.avg("review_score")).first()[0]
    assert float(one.avg_by_order) == pytest.approx(plain, abs=1e-4)


def test_main_payment_and_latest_review(spark):
    payments = spark.createDataFrame(
        [("o1", 2, "voucher", 1, Decimal(5), "b"), ("o1", 1, "boleto", 3, Decimal(5), "b"),
         ("o1", 3, "debit_card", 1, Decimal(4), "b")],
        "order_id string, payment_sequential smallint, payment_type string, payment_installments smallint, "
        "payment_value decimal(12,2), batch_id string")
    r = mart.payments_per_order(payments).first()
    assert (r.payment_type_main, r.payment_value, r.max_installments) == ("boleto", 14, 3)
    reviews = spark.createDataFrame(
        [("o1", "r1", 5, None), ("o1", "r2", 2, "2020-01-01 00:00:00"), ("o2", "r3", 1, None), ("o2", "r4", 3, None)],
        "order_id string, review_id string, review_score smallint, t string",
    ).withColumn("review_creation_date", F.col("t").cast("timestamp_ntz"))
    got = {r.order_id: r.review_score for r in mart.reviews_per_order(reviews).collect()}
    assert got == {"o1": 2, "o2": 3}


def test_lateness_is_to_the_second_and_delay_in_days(spark):
    orders = spark.createDataFrame(
        [("delivered", "2020-01-11 08:00:00"), ("delivered", None), ("shipped", "2020-01-11 08:00:00")],
        "order_status string, t string").select(
        "order_status", F.col("t").cast("timestamp_ntz").alias("order_delivered_customer_date"),
        F.lit("2020-01-11 00:00:00").cast("timestamp_ntz").alias("order_estimated_delivery_date"),
        F.lit("2020-01-01 23:00:00").cast("timestamp_ntz").alias("order_purchase_timestamp"))
    from mercata.functions import labels
    got = orders.select(labels.delivery_days(), labels.delay_days(), labels.is_late()).collect()
    assert [tuple(r) for r in got] == [(10, 0, True), (None, None, None), (None, None, None)]


def test_checks(spark, tables):
    items = tables["fct_order_items"]
    checks.require_clean(items)
    with pytest.raises(checks.CheckFailed, match="prices_below_zero"):
        checks.require_clean(items.withColumn("price", F.lit(-1)))
    assert checks.repeated_keys(items, "fct_order_items").isEmpty()
    assert checks.repeated_keys(items.unionAll(items), "fct_order_items").count() == items.count()
    assert checks.repeated_keys(items.unionAll(items), "fct_order_items", limit=10).count() == 10
    assert checks.orphan_count(items, tables["fct_orders"]).first().orphans == 0
