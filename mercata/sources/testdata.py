"""The TPC-H-like test tables in the shape of the eight raw input files.

Every column is text, as in a CSV. Money is computed in whole cents and then printed,
so no float reaches the jobs. Rows that CSV readers and cleaning steps must cope with
are part of the mapping: repeated item keys, blank and untranslated categories,
over-long states, missing sizes, texts with line breaks and quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.sources.batches import path_exists, size_of

# The share of an order's total put on each of its payments, in percent.
PAYMENT_SPLIT = (60, 40)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
SELLERS_PER_SUPPLIER = 20


def _text(prefix: str, number: str) -> Column:
    return F.expr(f"concat('{prefix}', {number})")


def _cents(expression: str) -> Column:
    return F.expr(f"concat(({expression}) div 100, '.', lpad(({expression}) % 100, 2, '0'))")


def _stamp(expression: str) -> Column:
    return F.expr(f"date_format({expression}, 'yyyy-MM-dd HH:mm:ss')")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, split as its files are."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the tables that grow and are mapped."""
    paths = [f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem", "customer", "part", "supplier")]
    return sum(size_of(spark, path) for path in paths if path_exists(spark, path))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = """
        case o_orderstatus
          when 'F' then 'delivered'
          when 'O' then if(o_orderkey % 2 = 0, 'delivered', 'shipped')
          else case o_orderkey % 10 when 0 then 'canceled' when 1 then 'unavailable' else 'processing' end
        end"""
    bought = "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)"
    arrived = "o_orderdate + make_dt_interval((o_orderkey * 7) % 41, 23, 59, 59)"
    return (
        read_table(spark, sf_dir, "orders")
        .withColumn("order_status", F.expr(status))
        .select(
            _text("o", "o_orderkey").alias("order_id"),
            _text("c", "o_orderkey").alias("customer_id"),
            "order_status",
            _stamp(bought).alias("order_purchase_timestamp"),
            F.when(F.expr("o_orderkey % 50 <> 3"), _stamp("o_orderdate + interval 1 day")).alias(
                "order_approved_at"
            ),
            F.when(
                F.expr("order_status in ('delivered', 'shipped')"), _stamp("o_orderdate + interval 2 days")
            ).alias("order_delivered_carrier_date"),
            F.when(F.expr("order_status = 'delivered'"), _stamp(arrived)).alias(
                "order_delivered_customer_date"
            ),
            _stamp("o_orderdate + interval 20 days").alias("order_estimated_delivery_date"),
        )
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = "cast(round(l_extendedprice * 100) as bigint) div 400"
    freight = f"({price}) * cast(round(l_tax * 100) as bigint) div 100"
    seller = f"l_suppkey * {SELLERS_PER_SUPPLIER} + l_partkey % {SELLERS_PER_SUPPLIER}"
    return read_table(spark, sf_dir, "lineitem").select(
        _text("o", "l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        _text("p", "l_partkey").alias("product_id"),
        _text("s", seller).alias("seller_id"),
        _stamp("l_shipdate").alias("shipping_limit_date"),
        _cents(price).alias("price"),
        _cents(freight).alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = ", ".join(f"'{t}'" for t in PAYMENT_TYPES)
    total = "cast(round(o_totalprice * 100) as bigint)"
    share = f"{total} * if(seq = 1, {PAYMENT_SPLIT[0]}, {PAYMENT_SPLIT[1]}) div 100"
    return (
        read_table(spark, sf_dir, "orders")
        .select("*", F.expr("explode(sequence(1, 1 + o_orderkey % 2))").alias("seq"))
        .select(
            _text("o", "o_orderkey").alias("order_id"),
            F.expr("cast(seq as string)").alias("payment_sequential"),
            F.expr(f"element_at(array({types}), cast((o_orderkey + seq) % 4 as int) + 1)").alias(
                "payment_type"
            ),
            F.expr("cast(1 + o_orderkey % 10 as string)").alias("payment_installments"),
            _cents(share).alias("payment_value"),
        )
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read_table(spark, sf_dir, "orders")
        .where("o_orderkey % 20 <> 0")
        .select("*", F.expr("explode(sequence(1, if(o_orderkey % 50 = 1, 2, 1)))").alias("nth"))
        .select(
            F.expr("concat('r', o_orderkey, if(nth = 2, 'b', ''))").alias("review_id"),
            _text("o", "o_orderkey").alias("order_id"),
            F.expr("cast(1 + (o_orderkey * 3 + (nth - 1) * 2) % 5 as string)").alias("review_score"),
            F.expr("if(o_orderkey % 4 = 0, concat('title ', o_orderkey), null)").alias(
                "review_comment_title"
            ),
            F.expr("concat('fine, \"as told\"', chr(10), 'order ', o_orderkey)").alias(
                "review_comment_message"
            ),
            F.when(
                F.expr("not (nth = 2 and o_orderkey % 100 = 51)"),
                _stamp("o_orderdate + make_dt_interval(42 + (nth - 1) * 8)"),
            ).alias("review_creation_date"),
            _stamp("o_orderdate + interval 55 days").alias("review_answer_timestamp"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        _text("p", "p_partkey").alias("product_id"),
        F.expr("if(p_partkey % 50 = 0, ' ', concat(lower(p_brand), '_pt'))").alias("product_category_name"),
        F.expr("concat(p_size, if(p_partkey % 13 = 0, '.5', '.0'))").alias("product_name_lenght"),
        F.expr("concat(length(p_name), '.0')").alias("product_description_lenght"),
        F.expr("concat(p_partkey % 7, '.0')").alias("product_photos_qty"),
        F.expr("concat(p_size * 100, '.0')").alias("product_weight_g"),
        F.expr("concat(p_size, '.0')").alias("product_length_cm"),
        F.expr("concat(p_size + 1, '.0')").alias("product_height_cm"),
        F.expr("if(p_partkey % 41 = 0, 'n/a', concat(p_size + 2, '.0'))").alias("product_width_cm"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer_id per order; every third order belongs to a shared person."""
    people = (
        read_table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey")
        .join(
            read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
            F.expr("o_custkey = c_custkey"),
        )
        .join(
            read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
            F.expr("c_nationkey = n_nationkey"),
        )
    )
    return people.select(
        _text("c", "o_orderkey").alias("customer_id"),
        F.expr("if(o_orderkey % 3 = 0, concat('u', o_custkey), concat('x', o_orderkey))").alias(
            "customer_unique_id"
        ),
        F.expr("lpad(cast(o_orderkey % 100000 as string), 5, '0')").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.expr("if(o_orderkey % 97 = 5, 'SPX', lpad(cast(c_nationkey as string), 2, '0'))").alias(
            "customer_state"
        ),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty sellers per supplier and one more that never sells."""
    return (
        read_table(spark, sf_dir, "supplier")
        .join(read_table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
        .select(
            "*", F.expr(f"explode(sequence(0, {SELLERS_PER_SUPPLIER}))").alias("nth")
        )
        .select(
            F.expr(
                f"if(nth = {SELLERS_PER_SUPPLIER}, concat('s', s_suppkey, 'z'), "
                f"concat('s', s_suppkey * {SELLERS_PER_SUPPLIER} + nth))"
            ).alias("seller_id"),
            F.expr("lpad(cast(s_suppkey % 100000 as string), 5, '0')").alias("seller_zip_code_prefix"),
            F.expr("concat(' ', n_name, ' ')").alias("seller_city"),
            F.expr(
                f"if(nth = {SELLERS_PER_SUPPLIER} and s_suppkey % 5 = 0, 'SPX', "
                "lpad(cast(s_nationkey as string), 2, '0'))"
            ).alias("seller_state"),
        )
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read_table(spark, sf_dir, "part")
        .select("p_brand")
        .distinct()
        .where("p_brand not in ('Brand#1', 'Brand#2')")
        .select(
            F.expr("concat(lower(p_brand), '_pt')").alias("product_category_name"),
            F.expr("concat(p_brand, '_EN')").alias("product_category_name_english"),
        )
    )


SOURCES = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "customers": customers,
    "sellers": sellers,
    "category_translation": category_translation,
}

