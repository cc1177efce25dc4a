"""Business columns derived from one row; every threshold is an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and default thresholds that reports rely on.
EXCLUDED_STATUSES = ("canceled", "unavailable")
DELIVERED = "delivered"
NO_CATEGORY_PT = "sem_categoria"
NO_CATEGORY_EN = "no_category"
SEGMENT_LIMITS = ((50, "Budget"), (150, "Mid-range"))
TOP_SEGMENT = "Premium"
DELIVERY_BUCKETS = ((7, "1. 0-7d"), (14, "2. 8-14d"), (21, "3. 15-21d"), (30, "4. 22-30d"))
LAST_DELIVERY_BUCKET = "5. 30d+"
DELAY_BUCKETS = (
    (-8, "1. Early >7d"),
    (-1, "2. Early 1-7d"),
    (0, "3. On time"),
    (7, "4. Late 1-7d"),
    (15, "5. Late 8-15d"),
)
LAST_DELAY_BUCKET = "6. Late >15d"


def stepped(value: Column, steps, last) -> Column:
    """First label whose inclusive upper bound holds ``value``, else ``last``."""
    chain = F
    for bound, label in steps:
        chain = chain.when(value <= bound, F.lit(label))
    return chain.otherwise(F.lit(last))


def _ordinals(steps):
    return [(bound, position) for position, (bound, _) in enumerate(steps, start=1)]


def is_kept_status(status: str = "order_status") -> Column:
    """Orders that count as sales."""
    return ~F.col(status).isin(*EXCLUDED_STATUSES)


def price_segment(price: str = "price", limits=SEGMENT_LIMITS, top: str = TOP_SEGMENT) -> Column:
    chain = F
    for limit, label in limits:
        chain = chain.when(F.col(price) < limit, F.lit(label))
    return chain.otherwise(F.lit(top))


def is_cross_state(buyer: str = "customer_state", seller: str = "seller_state") -> Column:
    return ~F.col(buyer).eqNullSafe(F.col(seller))


def item_revenue(price: str = "price", freight: str = "freight_value") -> Column:
    return (F.col(price) + F.col(freight)).cast("decimal(14,2)")


def freight_ratio(price: str = "price", freight: str = "freight_value") -> Column:
    total = F.col(price) + F.col(freight)
    # The null branch also keeps the division away from a zero total under ANSI rules.
    share = F.col(freight) / F.when(total > 0, total)
    return F.round(share, 4).cast("decimal(6,4)")


def volume_cm3() -> Column:
    side = [F.col(f"product_{s}_cm").cast("bigint") for s in ("length", "height", "width")]
    return side[0] * side[1] * side[2]


def _when_delivered(value: Column) -> Column:
    arrived = F.col("order_delivered_customer_date").isNotNull()
    return F.when((F.col("order_status") == DELIVERED) & arrived, value)


def delivery_days() -> Column:
    days = F.datediff("order_delivered_customer_date", "order_purchase_timestamp")
    return _when_delivered(days)


def delay_days() -> Column:
    days = F.datediff("order_delivered_customer_date", "order_estimated_delivery_date")
    return _when_delivered(days)


def is_late() -> Column:
    """Compared to the second, while ``delay_days`` counts whole days."""
    return _when_delivered(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"))


def delivery_bucket(days: str = "delivery_days") -> Column:
    return stepped(F.col(days), DELIVERY_BUCKETS, LAST_DELIVERY_BUCKET)


def delivery_bucket_order(days: str = "delivery_days") -> Column:
    return stepped(F.col(days), _ordinals(DELIVERY_BUCKETS), len(DELIVERY_BUCKETS) + 1)


def delay_bucket(days: str = "delay_days") -> Column:
    return stepped(F.col(days), DELAY_BUCKETS, LAST_DELAY_BUCKET)


def delay_bucket_order(days: str = "delay_days") -> Column:
    return stepped(F.col(days), _ordinals(DELAY_BUCKETS), len(DELAY_BUCKETS) + 1)


def route_type(crosses: str = "is_cross_state") -> Column:
    return F.when(F.col(crosses), "Cross-state").otherwise("Same-state")


def customer_type(repeats: str = "is_repeat_customer") -> Column:
    return F.when(F.col(repeats), "Repeat").otherwise("One-time")


def quadrant(volume: Column, volume_mid: Column, price: Column, price_mid: Column) -> Column:
    """Position of a category against both medians."""
    busy, dear = volume >= volume_mid, price >= price_mid
    return (
        F.when(busy & dear, "Core")
        .when(busy & ~dear, "Mass")
        .when(~busy & dear, "Premium")
        .otherwise("Underperform")
    )


def seller_segment(
    revenue: Column,
    revenue_mid: Column,
    review: Column,
    on_time: Column,
    good_review: float = 4.0,
    good_on_time: float = 0.90,
) -> Column:
    """Star, Risky, Emerging or Underperform; an unknown review is never a good one."""
    big = revenue > revenue_mid
    liked = F.coalesce(review >= F.lit(str(good_review)).cast("decimal(6,4)"), F.lit(False))
    punctual = F.coalesce(on_time >= F.lit(str(good_on_time)).cast("decimal(6,4)"), F.lit(False))
    return (
        F.when(big & liked & punctual, "Star")
        .when(big, "Risky")
        .when(liked, "Emerging")
        .otherwise("Underperform")
    )


def top_label(rank: str, name: str, top: int = 15) -> Column:
    return F.when(F.col(rank) <= top, F.col(name)).otherwise("Others")


def top_sort_label(rank: str, name: str, top: int = 15) -> Column:
    """Sorts as text in the order of ranks: they are padded to the width of ``top``, two digits at least."""
    width = max(2, len(str(top)))
    numbered = F.concat(F.lpad(F.col(rank).cast("string"), width, "0"), F.lit(". "), F.col(name))
    return F.when(F.col(rank) <= top, numbered).otherwise("9" * width + ". Others")
