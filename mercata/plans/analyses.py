"""Stand-alone analyses on the facts and views."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.functions import labels
from mercata.functions.measures import cents, from_cents, pct, ratio, rounded_ratio
from mercata.operators import order_metrics as om

# The shared filter dimensions of the reports.
FILTER_DIMENSIONS = (
    "order_purchase_date",
    "category_en",
    "price_segment",
    "customer_state",
    "seller_state",
    "order_status",
    "payment_type_main",
)


def concentration_cuts(concentration: DataFrame) -> DataFrame:
    """One row: revenue share of the top 10 % and 20 % of sellers and of the bottom half."""

    def upto(share: int) -> Column:
        return F.max(F.when(F.col("pct_sellers_cumulative") <= share, F.col("pct_revenue_cumulative")))

    return concentration.agg(
        F.round(upto(10), 2).alias("top_10_pct"),
        F.round(upto(20), 2).alias("top_20_pct"),
        F.round(100 - upto(50), 2).alias("bottom_50_pct"),
    )


def totals(items: DataFrame) -> DataFrame:
    per_order = items.groupBy("order_id").agg(
        F.sum(cents("item_revenue")).alias("_revenue"), F.count(F.lit(1)).alias("_rows")
    )
    return per_order.agg(
        from_cents(F.sum("_revenue")).alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("_rows").alias("item_rows"),
    )


def entity_counts(items: DataFrame, dim_product: DataFrame, dim_seller: DataFrame) -> DataFrame:
    buyers = items.groupBy("customer_unique_id").agg(F.lit(1).alias("_one"))
    return buyers.agg(F.count(F.lit(1)).alias("customers")).select(
        "customers",
        dim_product.agg(F.count(F.lit(1))).scalar().alias("products"),
        dim_seller.agg(F.count(F.lit(1))).scalar().alias("sellers"),
    )


def top_categories(contribution: DataFrame, k: int = 5) -> DataFrame:
    return (
        contribution.select("category_en", "revenue", "pct_of_total")
        .orderBy(F.col("revenue").desc(), "category_en")
        .limit(k)
    )


def segment_share(items: DataFrame) -> DataFrame:
    revenue = from_cents(F.sum(cents("item_revenue")))
    total = items.agg(revenue).scalar()
    return (
        items.groupBy("price_segment")
        .agg(F.count(F.lit(1)).alias("items_sold"), revenue.alias("revenue"))
        .withColumn("pct_revenue", pct("revenue", total))
    )


def on_time_overall(orders: DataFrame) -> DataFrame:
    delivered = F.col("order_status") == labels.DELIVERED
    return orders.agg(F.count_if(delivered).alias("delivered_orders"), *om.punctuality_sums()).select(
        "delivered_orders", om.on_time_pct().alias("on_time_rate")
    )


def route_type_delivery(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders and delivery days across and within states.

    An order counts once for each of its state pairs in the mean, and once per route
    type in the count.
    """
    pairs = items.groupBy("order_id", "customer_state", "seller_state").agg(
        F.first("is_cross_state").alias("is_cross_state")
    )
    per_order = pairs.groupBy("is_cross_state", "order_id").agg(F.count(F.lit(1)).alias("_pairs"))
    timed = per_order.join(orders.select(*om.ORDER_LABELS), "order_id")
    days = F.when(F.col("order_status") == labels.DELIVERED, F.col("delivery_days"))
    return (
        timed.groupBy("is_cross_state")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(days * F.col("_pairs")).alias("_sum"),
            F.sum(F.when(days.isNotNull(), F.col("_pairs"))).alias("_n"),
        )
        .select(
            labels.route_type().alias("route_type"),
            "orders",
            rounded_ratio("_sum", "_n").alias("avg_delivery_days"),
        )
    )


def customer_share(customer_summary: DataFrame) -> DataFrame:
    total = customer_summary.agg(F.sum("customers")).scalar()
    return customer_summary.select("customer_type", "customers", pct("customers", total).alias("pct_customers"))


def reject_reasons(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("so_dong"))


def review_weight_bias(detail: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean review weighted by items against one vote per order, and the relative gap in percent."""
    by_item = detail.agg(F.sum("review_score").alias("_s"), F.count("review_score").alias("_n"))
    by_order = orders.agg(F.sum("review_score").alias("_so"), F.count("review_score").alias("_no"))
    # Both have one row.
    both = by_item.select(
        "_s",
        "_n",
        by_order.select("_so").scalar().alias("_so"),
        by_order.select("_no").scalar().alias("_no"),
    )
    # Products of two sums outgrow long integers.
    s, n, so, no = (F.col(c).cast("decimal(18,0)") for c in ("_s", "_n", "_so", "_no"))
    gap = (s * no - so * n).cast("double") / F.nullif((so * n).cast("double"), F.lit(0.0))
    return both.select(
        F.round(ratio("_s", "_n"), 4).alias("avg_by_item"),
        F.round(ratio("_so", "_no"), 4).alias("avg_by_order"),
        F.round(gap * 100, 2).alias("bias_pct"),
    )


def filtered(df: DataFrame, **wanted) -> DataFrame:
    """Keep rows that match every named dimension: one value, a list, or a (low, high) pair."""
    for name, value in wanted.items():
        if name not in FILTER_DIMENSIONS:
            raise ValueError(f"{name} is not a filter dimension")
        if isinstance(value, tuple):
            df = df.where(F.col(name).between(F.lit(value[0]), F.lit(value[1])))
        elif isinstance(value, list):
            df = df.where(F.col(name).isin(value))
        else:
            df = df.where(F.col(name) == F.lit(value))
    return df


def recomputed(view: Callable[..., DataFrame], facts: Sequence[DataFrame], wanted: dict, **options) -> DataFrame:
    """A view over filtered facts, so its shares add up to 100 again.

    Filtering the finished view instead would keep shares of the unfiltered total.
    """
    kept = [filtered(f, **{k: v for k, v in wanted.items() if k in f.columns}) for f in facts]
    return view(*kept, **options)


def order_weighted(detail: DataFrame, orders: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Order-grain metrics under any of the filter dimensions, each order counted once per combination."""
    unknown = [d for d in dims if d not in FILTER_DIMENSIONS]
    if unknown:
        raise ValueError(f"not filter dimensions: {unknown}")
    return om.order_metrics_by(detail.select(*dims, "order_id", "item_revenue"), orders, list(dims))
