"""Cleaning and quarantine on literal rows, one case each."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercata.plans import staging
from mercata.schemas import INPUT_COLUMNS, MALFORMED, RAW, TABLES

AT = dt.datetime(2020, 1, 2)
GOOD_TIME = "2020-01-01 10:00:00"


def raw(spark, name, rows, batch="b1", at=AT):
    """Rows given as dicts over an otherwise valid row."""
    valid = {
        "orders": dict.fromkeys(INPUT_COLUMNS["orders"].split(), GOOD_TIME)
        | {"order_id": "o1", "customer_id": "c1", "order_status": "delivered"},
        "order_items": {"order_id": "o1", "order_item_id": "1", "product_id": "p", "seller_id": "s",
                        "shipping_limit_date": GOOD_TIME, "price": "10.00", "freight_value": "1.00"},
        "order_payments": {"order_id": "o1", "payment_sequential": "1", "payment_type": "boleto",
                           "payment_installments": "2", "payment_value": "5.00"},
        "order_reviews": {"review_id": "r1", "order_id": "o1", "review_score": "4", "review_comment_title": None,
                          "review_comment_message": None, "review_creation_date": GOOD_TIME,
                          "review_answer_timestamp": GOOD_TIME},
    }[name]
    table = RAW[f"raw_{name}"]
    full = [{**valid, "batch_id": batch, "ingested_at": at, **r} for r in rows]
    return spark.createDataFrame([tuple(r.get(c) for c in table.columns) for r in full], table.ddl)


@pytest.fixture(scope="module")
def parents(spark):
    return staging.stage_orders(raw(spark, "orders", [{}])).clean.persist()


def outcome(staged):
    return staged.clean.count(), [r.reject_reason for r in staged.rejects.collect()]


ORDER_CASES = [
    ({}, 1, None, None),
    ({"order_id": None}, 0, "missing_order_id", "missing_order_id"),
    ({"order_id": "   "}, 0, "missing_order_id", "missing_order_id"),
    ({"customer_id": ""}, 0, "missing_customer_id", "missing_customer_id"),
    ({"order_purchase_timestamp": "01/31/2020 10:00"}, 0, "invalid_timestamp", "invalid_timestamp"),
    ({"order_purchase_timestamp": "2018-13-45 99:99:99"}, 0, "invalid_timestamp", "invalid_timestamp"),
    ({"order_purchase_timestamp": GOOD_TIME + "\n"}, 0, "invalid_timestamp", "invalid_timestamp"),
    ({"order_purchase_timestamp": None}, 0, None, "missing_timestamp"),
    ({"order_status": None}, 0, "missing_status", "missing_status"),
    ({"order_approved_at": "soon"}, 1, None, None),
]
ITEM_CASES = [
    ({}, 1, None, None),
    ({"price": None}, 0, "orphan_row", "missing_price"),
    ({"price": ""}, 0, "price_not_numeric", "price_not_numeric"),
    ({"price": "N/A"}, 0, "price_not_numeric", "price_not_numeric"),
    ({"price": "-1"}, 0, "negative_price", "negative_price"),
    ({"price": "-0"}, 0, None, "price_not_numeric"),
    ({"price": "99999999999"}, 0, "price_out_of_range", "price_out_of_range"),
    ({"freight_value": None}, 0, "missing_freight", "missing_freight"),
    ({"freight_value": "  "}, 0, "missing_freight", "missing_freight"),
    ({"freight_value": "free"}, 0, "freight_not_numeric", "freight_not_numeric"),
    ({"freight_value": "-0.01"}, 0, "negative_freight", "negative_freight"),
    ({"order_item_id": "x"}, 0, None, "invalid_order_item_id"),
    ({"order_item_id": None}, 0, None, "invalid_order_item_id"),
    ({"order_item_id": "99999"}, 0, "invalid_order_item_id", "invalid_order_item_id"),
    ({"order_id": "nobody"}, 0, "orphan_row", "orphan_row"),
    ({"order_id": " o1 "}, 1, None, None),
    ({"product_id": None}, 0, "missing_product_id", "missing_product_id"),
    ({"price": "N/A", "freight_value": None}, 0, "price_not_numeric", "price_not_numeric"),
]
PAYMENT_CASES = [
    ({}, 1, None, None),
    ({"payment_value": None}, 0, "orphan_row", "missing_payment"),
    ({"payment_value": "five"}, 0, "payment_not_numeric", "payment_not_numeric"),
    ({"payment_value": "-5"}, 0, "negative_payment", "negative_payment"),
    ({"payment_value": "-0"}, 0, None, "payment_not_numeric"),
    ({"payment_sequential": "x"}, 0, None, "invalid_payment_sequential"),
    ({"payment_installments": "x"}, 1, None, None),
    ({"payment_installments": "99999"}, 0, "invalid_installments", "invalid_installments"),
    ({"payment_type": None}, 0, "missing_payment_type", "missing_payment_type"),
    ({"order_id": "nobody"}, 0, "orphan_row", "orphan_row"),
]
REVIEW_CASES = [
    ({}, 1, None, None),
    ({"review_score": None}, 0, "orphan_row", "missing_review_score"),
    ({"review_score": "0"}, 0, "review_out_of_range", "review_out_of_range"),
    ({"review_score": "7"}, 0, "review_out_of_range", "review_out_of_range"),
    ({"review_score": "-1"}, 0, "review_out_of_range", "review_out_of_range"),
    ({"review_score": "99999999999"}, 0, "review_out_of_range", "review_out_of_range"),
    ({"review_score": "x"}, 0, "review_not_numeric", "review_not_numeric"),
    ({"review_id": None}, 0, None, "missing_review_id"),
    ({"order_id": "nobody"}, 0, "orphan_row", "orphan_row"),
]
CHILDREN = {"order_items": ITEM_CASES, "order_payments": PAYMENT_CASES, "order_reviews": REVIEW_CASES}


def check_cases(spark, name, cases, policy, stage):
    """All cases in one go: each row is a batch of its own."""
    rows = [{**c[0], "batch_id": f"b{i:02d}"} for i, c in enumerate(cases)]
    # Each case stands alone, so keys must not meet: number the ones that could.
    staged = stage(raw(spark, name, rows))
    loaded = {r.batch_id for r in staged.clean.select("batch_id").collect()}
    refused = {r.batch_id: r.reject_reason for r in staged.rejects.collect()}
    for i, (change, loads, reference, complete) in enumerate(cases):
        wanted = reference if policy == "reference" else complete
        assert refused.get(f"b{i:02d}") == wanted, (change, policy)
        if not loads:
            assert f"b{i:02d}" not in loaded, change
    return loaded


@pytest.mark.parametrize("policy", staging.POLICIES)
def test_order_reasons(spark, policy):
    check_cases(spark, "orders", ORDER_CASES, policy, lambda r: staging.stage_orders(r, policy=policy))


@pytest.mark.parametrize("policy", staging.POLICIES)
@pytest.mark.parametrize("name", CHILDREN)
def test_child_reasons(spark, parents, name, policy):
    check_cases(
        spark, name, CHILDREN[name], policy, lambda r: staging.CHILD_STAGERS[name](r, parents, policy=policy)
    )


def test_values_are_cleaned(spark, parents):
    order = staging.stage_orders(
        raw(spark, "orders", [{"order_id": " o9 ", "order_status": "  DELIVERED ", "order_approved_at": "x"}])
    ).clean.first()
    assert (order.order_id, order.order_status, order.order_approved_at) == ("o9", "delivered", None)
    assert order.order_purchase_timestamp == dt.datetime(2020, 1, 1, 10)
    payment = staging.stage_order_payments(
        raw(spark, "order_payments", [{"payment_type": "BOLETO ", "payment_installments": "x"}]), parents
    ).clean.first()
    assert (payment.payment_type, payment.payment_installments) == ("boleto", 0)
    review = staging.stage_order_reviews(
        raw(spark, "order_reviews", [{"review_comment_title": "  ", "review_comment_message": " a\nb "}]), parents
    ).clean.first()
    assert (review.review_comment_title, review.review_comment_message) == (None, "a\nb")
    item = staging.stage_order_items(raw(spark, "order_items", [{"price": "1.005"}]), parents).clean.first()
    assert item.price == Decimal("1.01")


def test_the_payload_keeps_the_raw_row(spark, parents):
    staged = staging.stage_order_items(raw(spark, "order_items", [{"price": "N/A", "freight_value": None}]), parents)
    row = staged.rejects.first()
    payload = json.loads(row.raw_payload)
    assert row.source_table == "raw.raw_order_items"
    assert list(payload) == [c for c in RAW["raw_order_items"].columns if c != MALFORMED]
    assert payload["price"] == "N/A" and payload["freight_value"] is None


def test_one_row_per_key_within_and_across_batches(spark):
    rows = [
        {"order_status": "shipped", "batch_id": "b2", "ingested_at": AT + dt.timedelta(days=1)},
        {"order_status": "delivered", "customer_id": "c2"},
        {"order_status": "delivered", "customer_id": "c1"},
        {"order_status": "canceled", "order_purchase_timestamp": "bad"},
    ]
    staged = staging.stage_orders(raw(spark, "orders", rows))
    kept = staged.clean.collect()
    assert [(r.customer_id, r.batch_id) for r in kept] == [("c1", "b1")]
    assert staged.rejects.count() == 1  # a broken copy beside a clean one: one reject, one load


def test_what_is_staged_already_wins(spark, parents):
    rows = [{"order_status": "canceled", "batch_id": "b2"}, {"order_id": "o2", "batch_id": "b2"}]
    staged = staging.stage_orders(raw(spark, "orders", rows), existing=parents)
    assert [r.order_id for r in staged.clean.collect()] == ["o2"]


def test_a_parent_must_come_no_later(spark, parents):
    early = raw(spark, "order_items", [{}], at=AT - dt.timedelta(days=1))
    assert outcome(staging.stage_order_items(early, parents)) == (0, ["orphan_row"])


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        staging.stage_orders(raw(spark, "orders", [{}]), policy="other")


def stamped(spark, name, rows):
    spec = RAW[f"raw_{name}"]
    return spark.createDataFrame([(*r, None, "seed", AT) for r in rows], spec.ddl)


def test_static_tables(spark):
    products = staging.stage_products(stamped(spark, "products", [
        ("p1", "  TOYS ", "12.5", "225.0", "1", "x", "2.0", "3.0", "4.0"),
        ("p2", "  ", None, None, None, None, None, None, None),
        (" ", "toys", "1", "1", "1", "1", "1", "1", "1"),
        ("p1", "zzz", "1", "1", "1", "1", "1", "1", "1"),
    ]))
    rows = {r.product_id: r for r in products.collect()}
    assert set(rows) == {"p1", "p2"}
    assert rows["p1"].product_category_name == "toys"
    assert (rows["p1"].product_name_lenght, rows["p1"].product_description_lenght) == (13, 225)
    assert rows["p1"].product_weight_g is None
    assert rows["p2"].product_category_name == "sem_categoria"

    people = staging.stage_customers(stamped(spark, "customers", [
        ("c1", "u1", "01", " Rio ", "rj"), ("c2", "u2", "01", "x", "SPX"), ("c3", None, "01", "x", "SP"),
    ]))
    assert [(r.customer_id, r.customer_city, r.customer_state) for r in people.orderBy("customer_id").collect()] == [
        ("c1", "rio", "RJ"), ("c2", "x", None)]

    sellers = staging.stage_sellers(stamped(spark, "sellers", [("s1", "01", None, None), (None, "01", "x", "SP")]))
    assert [(r.seller_id, r.seller_state) for r in sellers.collect()] == [("s1", None)]

    names = staging.stage_category_translation(stamped(spark, "category_translation", [
        (" Brinquedos", "TOYS "), ("brinquedos", "zzz"), (None, "x")]))
    assert [tuple(r) for r in names.collect()] == [("brinquedos", "toys")]


def test_staged_types(spark, parents):
    assert [f.dataType for f in parents.schema] == [f.dataType for f in TABLES["stg_orders"].schema]


def test_extreme_values_that_fit_a_column_do_not_break_the_mart(spark):
    from mercata.plans import analyses, mart

    at = "2020-01-01 00:00:00"
    orders = spark.createDataFrame(
        [("o1", "c1", "delivered", at, at, at, "9999-12-31 00:00:00", at, "b", at)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
        "order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, "
        "order_estimated_delivery_date string, batch_id string, t string",
    ).withColumn("ingested_at", F.col("t").cast("timestamp")).drop("t")
    stg_orders = staging.stage_orders(orders).clean
    most = "9999999999.99"
    items = spark.createDataFrame(
        [("o1", str(n), "p1", "s1", None, most, most, "b", at) for n in range(1, 4)],
        "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date string, "
        "price string, freight_value string, batch_id string, t string",
    ).withColumn("ingested_at", F.col("t").cast("timestamp")).drop("t")
    stg_items = staging.stage_order_items(items, stg_orders).clean
    people = spark.createDataFrame(
        [("c1", "u1", "1", "x", "SP")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
    )
    product = spark.createDataFrame([("p1", "a", 1, 32000, 32000, 32000, 1)],
        "product_id string, product_category_name string, product_weight_g int, product_length_cm smallint, "
        "product_height_cm smallint, product_width_cm smallint, product_photos_qty smallint")
    words = spark.createDataFrame([], "product_category_name string, product_category_name_english string")
    dim_product = mart.build_dim_product(product, words)
    assert dim_product.first().product_volume_cm3 == 32000**3
    sellers = spark.createDataFrame([("s1", "x", "SP")], "seller_id string, seller_city string, seller_state string")
    facts = mart.build_fct_order_items(stg_items, stg_orders, people, dim_product, sellers)
    assert str(facts.first().item_revenue) == "19999999999.98"
    customers = mart.build_dim_customer(stg_orders, stg_items, people)
    none = {n: spark.createDataFrame([], TABLES[n].ddl.replace(" not null", "")) for n in ("stg_order_payments", "stg_order_reviews")}
    fact = mart.build_fct_orders(stg_orders, people, stg_items, *none.values(), customers).first()
    assert fact.delivery_days == 2914634 and str(fact.order_revenue) == "59999999999.94"
    many = spark.range(1).select(F.lit(3_000_000_000 * 4).alias("review_score"))
    assert analyses.review_weight_bias(many, many).first().bias_pct == 0
