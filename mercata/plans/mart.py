"""Dimensions and the two facts, built from staging.

The item fact has one row per item and the order fact one per order. Joining the first
to the second repeats order values, so each child table is brought to one row per order
before it is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.functions import labels
from mercata.functions.measures import cents, from_cents
from mercata.schemas import conform

# Columns of an order that only the order fact has.
ORDER_DATES = ("order_delivered_customer_date", "order_estimated_delivery_date", "batch_id")


def build_dim_product(stg_products: DataFrame, stg_translation: DataFrame) -> DataFrame:
    named = stg_products.join(stg_translation, "product_category_name", "left")
    return conform(
        named.select(
            "product_id",
            F.col("product_category_name").alias("category_pt"),
            F.coalesce("product_category_name_english", "product_category_name").alias("category_en"),
            "product_weight_g",
            labels.volume_cm3().alias("product_volume_cm3"),
            F.col("product_photos_qty").alias("photos_qty"),
        ),
        "dim_product",
    )


def build_dim_seller(stg_sellers: DataFrame) -> DataFrame:
    return conform(stg_sellers, "dim_seller")


def _smallest_of_first_batch(column: str) -> Column:
    """Smallest known value among the rows that came first; null if none of those has one."""
    first = F.min(F.struct("ingested_at", F.col(column).isNull(), column))
    return first[column].alias(column)


def build_dim_customer(stg_orders: DataFrame, stg_items: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """One row per person over all their orders, canceled ones included.

    City and state are those of the batch that first brought an order of the person;
    later batches do not change them.
    """
    spent = stg_items.groupBy("order_id").agg(F.sum(cents(labels.item_revenue())).alias("_spent"))
    # One row per order, as customer_id and order_id are keys: counting rows counts orders.
    bought = (
        stg_orders.select("order_id", "customer_id", "order_purchase_timestamp", "ingested_at")
        .join(
            stg_customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state"),
            "customer_id",
        )
        .join(spent, "order_id", "left")
    )
    return conform(
        bought.groupBy("customer_unique_id").agg(
            _smallest_of_first_batch("customer_city"),
            _smallest_of_first_batch("customer_state"),
            F.to_date(F.min("order_purchase_timestamp")).alias("first_order_date"),
            F.count(F.lit(1)).alias("total_orders"),
            F.coalesce(from_cents(F.sum("_spent")), F.lit(0)).alias("total_spent"),
        ),
        "dim_customer",
    )


def bought_orders(stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Orders of known customers, with the person behind each; customers are looked up once for all that needs them."""
    people = stg_customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    kept = ("order_id", "customer_id", "order_status", "order_purchase_timestamp", *ORDER_DATES, "ingested_at")
    return stg_orders.select(*kept).join(people, "customer_id")


def person_batches(
    stg_orders: DataFrame, stg_items: DataFrame, parents: DataFrame, stg_customers: DataFrame
) -> DataFrame:
    """What each batch brought of each person: orders, spending and firsts. Sums of these rows are the person's totals.

    ``parents`` has the orders of all items; spending counts for the batch that brought the item.
    """
    people = stg_customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    bought = stg_orders.select("order_id", "customer_id", "order_purchase_timestamp", "ingested_at", "batch_id").join(people, "customer_id")
    owners = parents.select("order_id", "customer_id").join(people.select("customer_id", "customer_unique_id"), "customer_id")
    return person_batches_of(bought, stg_items, owners)


def person_batches_of(bought: DataFrame, stg_items: DataFrame, owners: DataFrame) -> DataFrame:
    """The same, where the persons behind the batches' orders (``bought``) and behind those of the items are known."""
    orders = bought.groupBy("customer_unique_id", "batch_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.min("order_purchase_timestamp").alias("first_bought"),
        F.min("ingested_at").alias("first_seen"),
        _smallest_of_first_batch("customer_city").alias("city"),
        _smallest_of_first_batch("customer_state").alias("state"),
        F.min("order_id").alias("an_order"),
    )
    # One row per order and batch before people are looked up.
    spent = stg_items.groupBy("order_id", "batch_id").agg(F.sum(cents(labels.item_revenue())).alias("cents"))
    spent = spent.join(owners.select("order_id", "customer_unique_id"), "order_id")
    spent = spent.groupBy("customer_unique_id", "batch_id").agg(F.sum("cents").alias("cents"))
    joined = orders.join(spent, ["customer_unique_id", "batch_id"], "full_outer")
    return conform(joined.withColumn("orders", F.coalesce("orders", F.lit(0))), "person_batches")


def dim_customer_of(histories: DataFrame) -> DataFrame:
    """One row per person with an order, from all rows of ``person_batches`` that the person has."""
    ordered = F.col("orders") > 0

    def first(column: str) -> Column:
        row = F.struct("first_seen", F.col(column).isNull(), column)
        return F.min(F.when(ordered, row))[column]

    totals = histories.groupBy("customer_unique_id").agg(
        first("city").alias("customer_city"),
        first("state").alias("customer_state"),
        F.to_date(F.min("first_bought")).alias("first_order_date"),
        F.sum("orders").alias("total_orders"),
        F.coalesce(from_cents(F.sum("cents")), F.lit(0)).alias("total_spent"),
    )
    return conform(totals.where("total_orders > 0"), "dim_customer")


def only_other_orders(histories: DataFrame, known: DataFrame, batch_id: str) -> DataFrame:
    """order_id and is_repeat of people who have exactly one order outside the batch."""
    outside = histories.where(F.col("batch_id") != batch_id).groupBy("customer_unique_id").agg(
        F.sum("orders").alias("n"), F.min("an_order").alias("order_id")
    )
    single = outside.where("n = 1").join(known.select("customer_unique_id", "total_orders"), "customer_unique_id")
    return single.select("order_id", (F.col("total_orders") > 1).alias("is_repeat"))


def refreshed_orders(facts: DataFrame, scores: DataFrame, flagged: DataFrame) -> DataFrame:
    """Order facts with the review scores and repeat flags of the moment; all else stays as first loaded."""
    told = facts.drop("review_score").join(scores, "order_id", "left").join(flagged, "order_id", "left")
    flag = F.coalesce("is_repeat", "is_repeat_customer")
    return conform(told.withColumn("is_repeat_customer", flag), "fct_orders")


def _sold_orders(stg_orders: DataFrame, people: DataFrame, *columns: str) -> DataFrame:
    """Orders that count as sales, with what ``people`` tells of the customer_id behind them."""
    sold = stg_orders.where(labels.is_kept_status())
    return sold.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", *columns
    ).join(people, "customer_id")


def build_fct_order_items(
    stg_items: DataFrame,
    stg_orders: DataFrame,
    stg_customers: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
) -> DataFrame:
    """The item fact. A row never changes once its batch has been loaded.

    The dimensions are not broadcast by hint: they grow with the catalog, and Spark
    broadcasts them by itself as long as they are small. They are joined first: where
    items are shuffled by product and seller, they do not carry the order's columns yet.
    """
    people = stg_customers.select("customer_id", "customer_unique_id", "customer_state", "customer_city")
    return item_facts(with_dimensions(stg_items, dim_product, dim_seller), _sold_orders(stg_orders, people))


def with_dimensions(stg_items: DataFrame, dim_product: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """Items with the category of the product and the place of the seller."""
    items = stg_items.drop("ingested_at", "shipping_limit_date")
    named = items.join(dim_product.select("product_id", "category_pt", "category_en"), "product_id", "left")
    return named.join(dim_seller, "seller_id", "left")


def item_facts(items: DataFrame, sold: DataFrame) -> DataFrame:
    """The item fact from items ``with_dimensions``; ``sold`` has the orders that count as sales, with their persons."""
    told = ("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    sold = sold.select(*told, "customer_unique_id", "customer_state", "customer_city")
    facts = (
        items.join(sold, "order_id")
        .withColumn("order_purchase_date", F.to_date("order_purchase_timestamp"))
        .withColumn("item_revenue", labels.item_revenue())
        .withColumn("category_pt", F.coalesce("category_pt", F.lit(labels.NO_CATEGORY_PT)))
        .withColumn("category_en", F.coalesce("category_en", F.lit(labels.NO_CATEGORY_EN)))
        .withColumn("price_segment", labels.price_segment())
        .withColumn("is_cross_state", labels.is_cross_state())
        .withColumn("freight_ratio", labels.freight_ratio())
        .withColumn("loaded_at", F.current_timestamp())
    )
    return conform(facts, "fct_order_items")


def payments_per_order(stg_payments: DataFrame) -> DataFrame:
    """Paid sum, most installments, and the type of the largest payment of an order.

    Equal payments are settled by the lowest payment number.
    """
    largest = F.struct("payment_value", -F.col("payment_sequential").cast("int"))
    return stg_payments.groupBy("order_id", "batch_id").agg(
        from_cents(F.sum(cents("payment_value"))).alias("payment_value"),
        F.max("payment_installments").alias("max_installments"),
        F.max_by("payment_type", largest).alias("payment_type_main"),
    )


def reviews_per_order(stg_reviews: DataFrame) -> DataFrame:
    """Score of the latest review; undated ones come last, equal dates go to the higher review id."""
    latest = F.struct("review_creation_date", "review_id")
    return stg_reviews.groupBy("order_id").agg(F.max_by("review_score", latest).alias("review_score"))


def items_per_order(stg_items: DataFrame) -> DataFrame:
    return stg_items.groupBy("order_id", "batch_id").agg(
        F.count(F.lit(1)).alias("item_count"), from_cents(F.sum(cents(labels.item_revenue()))).alias("order_revenue")
    )


def repeat_people(dim_customer: DataFrame) -> DataFrame:
    """People with more than one order: a small part of the dimension."""
    return dim_customer.where("total_orders > 1").select(
        "customer_unique_id", F.lit(True).alias("is_repeat_customer")
    )


def build_fct_orders(
    stg_orders: DataFrame,
    stg_customers: DataFrame,
    stg_items: DataFrame,
    stg_payments: DataFrame,
    stg_reviews: DataFrame,
    dim_customer: DataFrame,
) -> DataFrame:
    """The order fact.

    Item and payment values are fixed when the order is first loaded, so only children
    of the order's own batch count; the review score and the repeat flag follow every
    later batch.
    """
    # The flag joins the two ids of a customer, not the wide order rows.
    people = (
        stg_customers.select("customer_id", "customer_unique_id")
        .join(repeat_people(dim_customer), "customer_unique_id", "left")
        .withColumn("is_repeat_customer", F.coalesce("is_repeat_customer", F.lit(False)))
    )
    return order_facts(_sold_orders(stg_orders, people, *ORDER_DATES), stg_items, stg_payments, stg_reviews)


def with_repeat_flag(bought: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """``bought_orders`` with the repeat flag. Only ids meet the people, not the wide order rows."""
    repeat = bought.select("order_id", "customer_unique_id").join(repeat_people(dim_customer), "customer_unique_id")
    flagged = bought.join(repeat.select("order_id", "is_repeat_customer"), "order_id", "left")
    return flagged.withColumn("is_repeat_customer", F.coalesce("is_repeat_customer", F.lit(False)))


def order_facts(sold: DataFrame, stg_items: DataFrame, stg_payments: DataFrame, stg_reviews: DataFrame) -> DataFrame:
    """The order fact, where the persons behind the orders are known: ``sold`` has the orders that count as sales."""
    # What is joined by the order alone comes first: the orders then stay where they are for the joins by order and batch.
    facts = (
        sold.join(reviews_per_order(stg_reviews), "order_id", "left")
        .join(items_per_order(stg_items), ["order_id", "batch_id"], "left")
        .join(payments_per_order(stg_payments), ["order_id", "batch_id"], "left")
        .withColumn("order_purchase_date", F.to_date("order_purchase_timestamp"))
        .withColumn("delivery_days", labels.delivery_days())
        .withColumn("delay_days", labels.delay_days())
        .withColumn("is_late", labels.is_late())
        .withColumn("item_count", F.coalesce("item_count", F.lit(0)))
        .withColumn("order_revenue", F.coalesce("order_revenue", F.lit(0)))
        .withColumn("loaded_at", F.current_timestamp())
    )
    return conform(facts, "fct_orders")
