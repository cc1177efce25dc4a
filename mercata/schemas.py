"""Column lists, types and keys of every table, as Spark DDL.

Raw tables hold text only, so that any broken value can be loaded and then
quarantined. Money is ``decimal(12,2)`` from staging on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STAMP = "batch_id string not null, ingested_at timestamp not null"


@dataclass(frozen=True)
class Table:
    """One table: its layer, DDL, key and whether it is split by batch."""

    layer: str
    ddl: str
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    by_batch: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _text(columns: str) -> str:
    return ", ".join(f"{name} string" for name in columns.split())


# The eight input files. File names and header columns.
INPUT_COLUMNS = {
    "orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at "
    "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "order_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "order_reviews": "review_id order_id review_score review_comment_title review_comment_message "
    "review_creation_date review_answer_timestamp",
    "products": "product_id product_category_name product_name_lenght product_description_lenght "
    "product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm",
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "category_translation": "product_category_name product_category_name_english",
}

# The whole line, where it has more or fewer fields than the file has columns.
MALFORMED = "malformed"

DYNAMIC_INPUTS = ("orders", "order_items", "order_payments", "order_reviews")
STATIC_INPUTS = ("products", "customers", "sellers", "category_translation")

INPUT_DDL = {name: _text(cols) for name, cols in INPUT_COLUMNS.items()}

RAW = {
    f"raw_{name}": Table("raw", f"{_text(cols)}, {MALFORMED} string, {STAMP}", by_batch=True)
    for name, cols in INPUT_COLUMNS.items()
}

STAGING = {
    "stg_orders": Table(
        "staging",
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
        f"order_estimated_delivery_date timestamp_ntz, {STAMP}",
        key=("order_id",),
        not_null=("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
        by_batch=True,
    ),
    "stg_order_items": Table(
        "staging",
        "order_id string, order_item_id smallint, product_id string, seller_id string, "
        f"shipping_limit_date timestamp_ntz, price decimal(12,2), freight_value decimal(12,2), {STAMP}",
        key=("order_id", "order_item_id"),
        not_null=("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
        by_batch=True,
    ),
    "stg_order_payments": Table(
        "staging",
        "order_id string, payment_sequential smallint, payment_type string, "
        f"payment_installments smallint, payment_value decimal(12,2), {STAMP}",
        key=("order_id", "payment_sequential"),
        not_null=("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
        by_batch=True,
    ),
    "stg_order_reviews": Table(
        "staging",
        "review_id string, order_id string, review_score smallint, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp_ntz, "
        f"review_answer_timestamp timestamp_ntz, {STAMP}",
        key=("review_id", "order_id"),
        not_null=("review_id", "order_id", "review_score"),
        by_batch=True,
    ),
    "stg_products": Table(
        "staging",
        "product_id string, product_category_name string, product_name_lenght smallint, "
        "product_description_lenght int, product_photos_qty smallint, product_weight_g int, "
        f"product_length_cm smallint, product_height_cm smallint, product_width_cm smallint, {STAMP}",
        key=("product_id",),
        not_null=("product_id", "product_category_name"),
    ),
    "stg_customers": Table(
        "staging",
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        f"customer_city string, customer_state string, {STAMP}",
        key=("customer_id",),
        not_null=("customer_id", "customer_unique_id"),
    ),
    "stg_sellers": Table(
        "staging",
        f"seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string, {STAMP}",
        key=("seller_id",),
        not_null=("seller_id",),
    ),
    "stg_category_translation": Table(
        "staging",
        "product_category_name string, product_category_name_english string",
        key=("product_category_name",),
        not_null=("product_category_name", "product_category_name_english"),
    ),
}

MART = {
    "dim_product": Table(
        "mart",
        "product_id string, category_pt string, category_en string, product_weight_g int, "
        "product_volume_cm3 bigint, photos_qty smallint",
        key=("product_id",),
        not_null=("product_id", "category_pt", "category_en"),
    ),
    "dim_seller": Table(
        "mart",
        "seller_id string, seller_city string, seller_state string",
        key=("seller_id",),
        not_null=("seller_id",),
    ),
    "dim_customer": Table(
        "mart",
        "customer_unique_id string, customer_city string, customer_state string, "
        "first_order_date date, total_orders bigint, total_spent decimal(18,2)",
        key=("customer_unique_id",),
        not_null=("customer_unique_id",),
    ),
    "fct_order_items": Table(
        "mart",
        "order_id string, order_item_id smallint, product_id string, seller_id string, "
        "customer_id string, customer_unique_id string, order_purchase_timestamp timestamp_ntz, "
        "order_purchase_date date, price decimal(12,2), freight_value decimal(12,2), "
        "item_revenue decimal(14,2), order_status string, category_pt string, category_en string, "
        "customer_state string, customer_city string, seller_state string, seller_city string, "
        "price_segment string, is_cross_state boolean, freight_ratio decimal(6,4), "
        "batch_id string, loaded_at timestamp",
        key=("order_id", "order_item_id"),
        not_null=(
            "order_id", "order_item_id", "product_id", "seller_id", "customer_id", "customer_unique_id",
            "order_purchase_date", "price", "freight_value", "item_revenue", "order_status",
            "category_pt", "category_en", "price_segment", "is_cross_state",
        ),
        by_batch=True,
    ),
    "fct_orders": Table(
        "mart",
        "order_id string, customer_id string, customer_unique_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, order_purchase_date date, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz, "
        "delivery_days int, delay_days int, is_late boolean, item_count bigint, "
        "order_revenue decimal(18,2), payment_value decimal(18,2), payment_type_main string, "
        "max_installments smallint, review_score smallint, is_repeat_customer boolean, "
        "batch_id string, loaded_at timestamp",
        key=("order_id",),
        not_null=("order_id", "customer_id", "customer_unique_id", "order_status", "is_repeat_customer"),
    ),
}

# What a batch looks up in history, laid out by key; derived from staging, and rebuilt with the mart.
STATE = {
    "order_keys": Table("state", STAGING["stg_orders"].ddl, key=("order_id",)),
    "order_items_keys": Table("state", "order_id string, order_item_id smallint, batch_id string"),
    "order_payments_keys": Table("state", "order_id string, payment_sequential smallint, batch_id string"),
    "order_reviews_keys": Table(
        "state",
        "order_id string, review_id string, review_score smallint, review_creation_date timestamp_ntz, batch_id string",
    ),
    "customer_keys": Table("state", STAGING["stg_customers"].ddl, key=("customer_id",)),
    # What each batch adds to a person: sums and firsts, so that no history is counted again.
    "person_batches": Table(
        "state",
        "customer_unique_id string, batch_id string, orders bigint, cents decimal(38,0), first_bought timestamp_ntz, "
        "first_seen timestamp, city string, state string, an_order string",
        key=("customer_unique_id", "batch_id"),
    ),
}

# Tables in buckets of a key: the column that is hashed.
KEYED = {
    "fct_orders": "order_id",
    "dim_customer": "customer_unique_id",
    "order_keys": "order_id",
    "order_items_keys": "order_id",
    "order_payments_keys": "order_id",
    "order_reviews_keys": "order_id",
    "customer_keys": "customer_id",
    "person_batches": "customer_unique_id",
}

OPS = {
    "load_audit": Table(
        "ops",
        "batch_id string, table_name string, run_time timestamp, rows_in bigint, rows_dup bigint, "
        "rows_rejected bigint, rows_loaded bigint, duration_sec decimal(8,2), note string",
        key=("batch_id", "table_name"),
        by_batch=True,
    ),
    "rejected_rows": Table(
        "ops",
        "batch_id string, source_table string, reject_reason string, raw_payload string, rejected_at timestamp",
        by_batch=True,
    ),
}

TABLES: dict[str, Table] = {**RAW, **STAGING, **MART, **STATE, **OPS}


def conform(df, table: str):
    """Project ``df`` onto the declared columns and types of ``table``."""
    from pyspark.sql import functions as F

    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table].schema])
