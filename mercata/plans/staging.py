"""From raw text to typed, clean and unique rows; whatever cannot be loaded is quarantined.

Each function takes raw rows of one or of many batches. Within the rows given, a key is
loaded from the earliest batch that holds a loadable row of it, and a child row needs a
parent loaded no later than itself. Staging a whole history in one job thus gives the same
tables as staging its batches one after the other.

``policy="reference"`` keeps two known gaps: a row whose purchase timestamp, item number,
payment number or review id is missing or malformed is neither loaded nor quarantined, and
a missing price or score is quarantined as ``orphan_row``. ``policy="complete"`` gives each
of them its own reason. Values of the right shape that no column could hold are quarantined
under both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.functions import labels, parsing as p
from mercata.operators.keyed import insert_if_absent, keep_first, narrow_to_keys
from mercata.schemas import MALFORMED, TABLES, conform

POLICIES = ("reference", "complete")


Hold = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Staged:
    """Outcome of staging one input."""

    clean: DataFrame
    rejects: DataFrame


class _Rules:
    """Ordered reject reasons; the first that holds is given.

    Rows of the right shape are told apart first: only they are tested for values no
    column could hold, and no other test is spent on them.
    """

    def __init__(self, policy: str, shaped: Column):
        if policy not in POLICIES:
            raise ValueError(f"policy must be one of {POLICIES}")
        self.complete = policy == "complete"
        self.shaped = shaped
        self.unfit: list[tuple[Column, str]] = []
        self.broken: list[tuple[Column, str]] = []

    def add(self, condition: Column, reason: str, only_complete: bool = False) -> "_Rules":
        if self.complete or not only_complete:
            self.broken.append((condition, reason))
        return self

    def add_unfit(self, condition: Column, reason: str) -> "_Rules":
        self.unfit.append((condition, reason))
        return self

    @staticmethod
    def _chain(steps: list[tuple[Column, str]]) -> Column:
        reason = F.lit(None).cast("string")
        for condition, name in reversed(steps):
            reason = F.when(condition, F.lit(name)).otherwise(reason)
        return reason

    def judge(self, raw: DataFrame) -> DataFrame:
        """Add the reason, if any, and whether the row can be loaded."""
        reason = F.when(self.shaped, self._chain(self.unfit)).otherwise(self._chain(self.broken))
        if MALFORMED in raw.columns:
            reason = F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed_line")).otherwise(reason)
        return raw.withColumn("_reason", reason).withColumn(
            "_loadable", F.col("_reason").isNull() & self.shaped
        )


def _finish(
    judged: DataFrame,
    raw: DataFrame,
    parsed: dict[str, Column],
    table: str,
    source_table: str,
    existing: DataFrame | None,
    doubtful: DataFrame | None = None,
) -> Staged:
    """Split judged rows: rejects as they came, loadable ones made unique and then parsed.

    Rejects come from ``doubtful`` where it is given: judged rows that include all that have a reason.
    """
    spec = TABLES[table]
    sent = [c for c in raw.columns if c != MALFORMED]
    text = [c for c in sent if c not in ("batch_id", "ingested_at")]
    # The raw text settles which of several copies in one batch is kept.
    order = ["ingested_at", "batch_id", *text]
    loadable = judged.where("_loadable").select(*raw.columns)
    first = keep_first(loadable, [parsed[k] for k in spec.key], order)
    unique = conform(first.select([parsed.get(c, F.col(c)).alias(c) for c in spec.columns]), table)
    if existing is not None:
        unique = insert_if_absent(unique, existing, spec.key).select(*spec.columns)
    payload = F.to_json(F.struct(*sent), {"ignoreNullFields": "false"})
    if MALFORMED in raw.columns:
        line = F.to_json(F.struct(F.col(MALFORMED).alias("line"), "batch_id", "ingested_at"))
        payload = F.when(F.col(MALFORMED).isNotNull(), line).otherwise(payload)
    rejects = (judged if doubtful is None else doubtful).where("_reason is not null").select(
        "batch_id",
        F.lit(f"raw.{source_table}").alias("source_table"),
        F.col("_reason").alias("reject_reason"),
        payload.alias("raw_payload"),
        F.current_timestamp().alias("rejected_at"),
    )
    return Staged(unique, rejects)


def _fits(column: str, kind: str) -> Column:
    """Text that is known to be a plain number, as ``kind``; null when it does not fit."""
    return F.col(column).try_cast(kind)


MONEY = "decimal(12,2)"


def stage_orders(raw: DataFrame, existing: DataFrame | None = None, policy: str = "reference", hold: Hold | None = None) -> Staged:
    bought = F.col("order_purchase_timestamp")
    dated = bought.rlike(p.ISO_TIMESTAMP)
    shaped = ~p.is_blank("order_id") & ~p.is_blank("customer_id") & F.coalesce(dated, F.lit(False))
    rules = (
        _Rules(policy, shaped)
        .add_unfit(bought.try_cast("timestamp_ntz").isNull(), "invalid_timestamp")
        .add_unfit(F.col("order_status").isNull(), "missing_status")
        .add(p.is_blank("order_id"), "missing_order_id")
        .add(p.is_blank("customer_id"), "missing_customer_id")
        .add(~dated, "invalid_timestamp")
        .add(bought.isNull(), "missing_timestamp", only_complete=True)
    )
    optional = (
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    parsed = {
        "order_id": F.trim("order_id"),
        "customer_id": F.trim("customer_id"),
        "order_status": p.lower_trim("order_status"),
        "order_purchase_timestamp": bought.try_cast("timestamp_ntz"),
        **{c: p.iso_timestamp(c) for c in optional},
    }
    judged = rules.judge(raw) if hold is None else hold(rules.judge(raw))
    return _finish(judged, raw, parsed, "stg_orders", "raw_orders", existing)


def _with_parent(raw: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Mark rows whose order had been loaded by the time they came in."""
    parents = stg_orders.select(
        F.col("order_id").alias("_parent"), F.col("ingested_at").alias("_parent_at")
    )
    found = raw.join(parents, F.trim("order_id") == F.col("_parent"), "left")
    known = F.coalesce(F.col("_parent_at") <= F.col("ingested_at"), F.lit(False))
    return found.withColumn("_has_parent", known).drop("_parent", "_parent_at")


def _doubtful(rules: _Rules, raw: DataFrame, stg_orders: DataFrame, hold: Hold) -> DataFrame:
    """All rows that may be refused, judged: those refused whatever their order, and those without one.

    Of the others only the order ids and times are compared with the orders, each once, so few rows are shuffled.
    """
    alone = rules.judge(raw.withColumn("_has_parent", F.lit(True))).withColumn("_order", F.trim("order_id"))
    # Of all rows: those refused in any case need not be judged to be left out here.
    told = raw.select(F.trim("order_id").alias("_order"), F.col("ingested_at").alias("_at")).distinct()
    parents = stg_orders.select(F.col("order_id").alias("_parent"), F.col("ingested_at").alias("_parent_at"))
    known = F.coalesce(F.col("_parent_at") <= F.col("_at"), F.lit(False))
    orphans = told.join(parents, F.col("_order") == F.col("_parent"), "left").where(~known).select("_order", "_at")
    lost = hold(orphans.distinct()).select(
        F.col("_order").alias("_lost_order"), F.col("_at").alias("_lost_at"), F.lit(True).alias("_lost")
    )
    same = F.col("_order").eqNullSafe(F.col("_lost_order")) & F.col("ingested_at").eqNullSafe(F.col("_lost_at"))
    found = alone.join(lost, same, "left").where(~F.col("_loadable") | F.col("_lost").isNotNull())
    rows = hold(found.select(*raw.columns))
    near = narrow_to_keys(stg_orders, rows.select(F.trim("order_id").alias("order_id")), ["order_id"])
    return rules.judge(_with_parent(rows, near))


def _finish_child(
    rules: _Rules,
    raw: DataFrame,
    stg_orders: DataFrame,
    parsed: dict[str, Column],
    table: str,
    source_table: str,
    existing: DataFrame | None,
    hold: Hold | None,
) -> Staged:
    """Judge child rows with their orders and split them.

    Clean rows share one shuffle for their orders and their keys. Rejects would need another of all rows; with
    ``hold``, which writes a table and reads it back, only the rows in doubt meet the orders again.
    """
    judged = rules.judge(_with_parent(raw, stg_orders))
    doubtful = None if hold is None else _doubtful(rules, raw, stg_orders, hold)
    return _finish(judged, raw, parsed, table, source_table, existing, doubtful)


def stage_order_items(
    raw: DataFrame, stg_orders: DataFrame, existing: DataFrame | None = None, policy: str = "reference",
    hold: Hold | None = None,
) -> Staged:
    has_parent = F.col("_has_parent")
    number, price, freight = F.col("order_item_id"), F.col("price"), F.col("freight_value")
    shaped = F.coalesce(
        has_parent
        & number.rlike(p.UNSIGNED_INTEGER)
        & price.rlike(p.UNSIGNED_NUMBER)
        & freight.rlike(p.UNSIGNED_NUMBER),
        F.lit(False),
    )
    rules = (
        _Rules(policy, shaped)
        .add_unfit(_fits("order_item_id", "smallint").isNull(), "invalid_order_item_id")
        .add_unfit(_fits("price", MONEY).isNull(), "price_out_of_range")
        .add_unfit(_fits("freight_value", MONEY).isNull(), "freight_out_of_range")
        .add_unfit(F.col("product_id").isNull(), "missing_product_id")
        .add_unfit(F.col("seller_id").isNull(), "missing_seller_id")
        .add(price.isNull(), "missing_price", only_complete=True)
        .add(~price.rlike(p.SIGNED_NUMBER), "price_not_numeric")
        .add(p.below_zero("price"), "negative_price")
        .add(p.is_blank("freight_value"), "missing_freight")
        .add(~freight.rlike(p.SIGNED_NUMBER), "freight_not_numeric")
        .add(p.below_zero("freight_value"), "negative_freight")
        .add(price.isNull() | ~has_parent, "orphan_row")
        .add(number.isNull() | ~number.rlike(p.UNSIGNED_INTEGER), "invalid_order_item_id", only_complete=True)
        .add(~price.rlike(p.UNSIGNED_NUMBER), "price_not_numeric", only_complete=True)
        .add(~freight.rlike(p.UNSIGNED_NUMBER), "freight_not_numeric", only_complete=True)
    )
    parsed = {
        "order_id": F.trim("order_id"),
        "order_item_id": _fits("order_item_id", "smallint"),
        "product_id": F.trim("product_id"),
        "seller_id": F.trim("seller_id"),
        "shipping_limit_date": p.iso_timestamp("shipping_limit_date"),
        "price": _fits("price", MONEY),
        "freight_value": _fits("freight_value", MONEY),
    }
    return _finish_child(rules, raw, stg_orders, parsed, "stg_order_items", "raw_order_items", existing, hold)


def stage_order_payments(
    raw: DataFrame, stg_orders: DataFrame, existing: DataFrame | None = None, policy: str = "reference",
    hold: Hold | None = None,
) -> Staged:
    has_parent = F.col("_has_parent")
    value, number = F.col("payment_value"), F.col("payment_sequential")
    shaped = F.coalesce(
        has_parent & number.rlike(p.UNSIGNED_INTEGER) & value.rlike(p.UNSIGNED_NUMBER), F.lit(False)
    )
    counted = F.col("payment_installments").rlike(p.UNSIGNED_INTEGER)
    installments = F.when(counted, _fits("payment_installments", "smallint")).otherwise(F.lit(0))
    rules = (
        _Rules(policy, shaped)
        .add_unfit(_fits("payment_sequential", "smallint").isNull(), "invalid_payment_sequential")
        .add_unfit(_fits("payment_value", MONEY).isNull(), "payment_out_of_range")
        .add_unfit(F.col("payment_type").isNull(), "missing_payment_type")
        .add_unfit(installments.isNull(), "invalid_installments")
        .add(value.isNull(), "missing_payment", only_complete=True)
        .add(~value.rlike(p.SIGNED_NUMBER), "payment_not_numeric")
        .add(p.below_zero("payment_value"), "negative_payment")
        .add(value.isNull() | ~has_parent, "orphan_row")
        .add(
            number.isNull() | ~number.rlike(p.UNSIGNED_INTEGER), "invalid_payment_sequential", only_complete=True
        )
        .add(~value.rlike(p.UNSIGNED_NUMBER), "payment_not_numeric", only_complete=True)
    )
    parsed = {
        "order_id": F.trim("order_id"),
        "payment_sequential": _fits("payment_sequential", "smallint"),
        "payment_type": p.lower_trim("payment_type"),
        "payment_installments": installments,
        "payment_value": _fits("payment_value", MONEY),
    }
    return _finish_child(rules, raw, stg_orders, parsed, "stg_order_payments", "raw_order_payments", existing, hold)


def stage_order_reviews(
    raw: DataFrame, stg_orders: DataFrame, existing: DataFrame | None = None, policy: str = "reference",
    hold: Hold | None = None,
) -> Staged:
    has_parent = F.col("_has_parent")
    score = F.col("review_score")
    # Digits too many for a number are out of range as well.
    in_range = F.coalesce(_fits("review_score", "int").between(1, 5), F.lit(False))
    shaped = F.coalesce(
        has_parent & ~p.is_blank("review_id") & score.rlike(p.UNSIGNED_INTEGER) & in_range, F.lit(False)
    )
    rules = (
        _Rules(policy, shaped)
        .add(score.isNull(), "missing_review_score", only_complete=True)
        .add(~score.rlike(p.SIGNED_INTEGER), "review_not_numeric")
        .add(~in_range & score.isNotNull(), "review_out_of_range")
        .add(score.isNull() | ~has_parent, "orphan_row")
        .add(p.is_blank("review_id"), "missing_review_id", only_complete=True)
    )
    parsed = {
        "review_id": F.trim("review_id"),
        "order_id": F.trim("order_id"),
        "review_score": _fits("review_score", "smallint"),
        "review_comment_title": p.blank_to_null("review_comment_title"),
        "review_comment_message": p.blank_to_null("review_comment_message"),
        "review_creation_date": p.iso_timestamp("review_creation_date"),
        "review_answer_timestamp": p.iso_timestamp("review_answer_timestamp"),
    }
    return _finish_child(rules, raw, stg_orders, parsed, "stg_order_reviews", "raw_order_reviews", existing, hold)


def _first_by_key(df: DataFrame, table: str) -> DataFrame:
    spec = TABLES[table]
    others = [c for c in df.columns if c not in (*spec.key, "batch_id", "ingested_at")]
    stamps = [c for c in ("ingested_at", "batch_id") if c in df.columns]
    return conform(keep_first(df, spec.key, [*stamps, *others]), table)


def stage_category_translation(raw: DataFrame) -> DataFrame:
    """Rows without a name are skipped; so are those without an English one, which no table could hold."""
    named = raw.where(
        F.col("product_category_name").isNotNull() & F.col("product_category_name_english").isNotNull()
    )
    return _first_by_key(
        named.select(
            p.lower_trim("product_category_name").alias("product_category_name"),
            p.lower_trim("product_category_name_english").alias("product_category_name_english"),
        ),
        "stg_category_translation",
    )


def stage_sellers(raw: DataFrame) -> DataFrame:
    return _first_by_key(
        raw.where(~p.is_blank("seller_id")).select(
            F.trim("seller_id").alias("seller_id"),
            F.trim("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
            p.lower_trim("seller_city").alias("seller_city"),
            p.state_code("seller_state").alias("seller_state"),
            "batch_id",
            "ingested_at",
        ),
        "stg_sellers",
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    kept = raw.where(~p.is_blank("customer_id") & F.col("customer_unique_id").isNotNull())
    return _first_by_key(
        kept.select(
            F.trim("customer_id").alias("customer_id"),
            F.trim("customer_unique_id").alias("customer_unique_id"),
            F.trim("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
            p.lower_trim("customer_city").alias("customer_city"),
            p.state_code("customer_state").alias("customer_state"),
            "batch_id",
            "ingested_at",
        ),
        "stg_customers",
    )


def stage_products(raw: DataFrame) -> DataFrame:
    category = F.coalesce(F.lower(p.blank_to_null("product_category_name")), F.lit(labels.NO_CATEGORY_PT))
    numbers = [f for f in TABLES["stg_products"].schema if f.dataType.typeName() in ("short", "integer")]
    return _first_by_key(
        raw.where(~p.is_blank("product_id")).select(
            F.trim("product_id").alias("product_id"),
            category.alias("product_category_name"),
            *[p.rounded_number(f.name, f.dataType.simpleString()).alias(f.name) for f in numbers],
            "batch_id",
            "ingested_at",
        ),
        "stg_products",
    )


def _well_formed(stage: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Lines of a static file that have too many or too few fields stay in the raw table."""
    return lambda raw: stage(raw.where(F.col(MALFORMED).isNull()) if MALFORMED in raw.columns else raw)


STATIC_STAGERS = {
    "products": _well_formed(stage_products),
    "customers": _well_formed(stage_customers),
    "sellers": _well_formed(stage_sellers),
    "category_translation": _well_formed(stage_category_translation),
}
CHILD_STAGERS = {
    "order_items": stage_order_items,
    "order_payments": stage_order_payments,
    "order_reviews": stage_order_reviews,
}
