"""Cut a source into a seed and daily batches, with repeatable faults.

All days are made in one pass: each row carries the day of its batch, and samples are
drawn per day. A batch depends only on its day and the source, so making it again
gives the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.functions.parsing import UNSIGNED_NUMBER
from mercata.operators.sampling import hash_choice, with_sample_flags
from mercata.schemas import DYNAMIC_INPUTS, STATIC_INPUTS
from mercata.session import SENT_KEYS, cut_lineage, sent, side_by_side
from mercata.sources.batches import BATCH_PREFIX, write_csv

DAY = "batch_day"
SEED = "seed"
# Row identity of each input, used to draw samples.
IDENTITY = {
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
    "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": ("review_id", "order_id"),
    "products": ("product_id",),
}
BAD_SCORES = ("0", "7", "-1")  # and an empty one


@dataclass(frozen=True)
class Plan:
    """First and last day of the batches, and the share of rows touched by each fault."""

    first_day: dt.date = dt.date(2018, 8, 1)
    last_day: dt.date = dt.date(2018, 8, 31)
    resend: float = 0.15
    timestamp: float = 0.05
    status: float = 0.03
    price: float = 0.04
    review: float = 0.04
    payment: float = 0.03
    category: float = 0.02


def scenario_of(plan: Plan, day: Column) -> Column:
    """Clean on the first day, duplicate on the second, dirty on the third, then both."""
    nth = F.datediff(day, F.lit(plan.first_day)) + 1
    return (
        F.when(nth <= 1, "clean").when(nth == 2, "duplicate").when(nth == 3, "dirty").otherwise("mixed")
    )


def _is(plan: Plan, *names: str) -> Column:
    return scenario_of(plan, F.col(DAY)).isin(*names)


def order_day(orders: DataFrame) -> DataFrame:
    """Add the purchase day; a timestamp that cannot be read has none."""
    day = F.col("order_purchase_timestamp").try_cast("timestamp_ntz").cast("date")
    return orders.withColumn("order_day", day)


def children_of(child: DataFrame, parents: DataFrame, n: int = SENT_KEYS + 1) -> DataFrame:
    """Child rows of the given orders, once for each batch the order is part of. ``n`` is the number of ``parents``, if known."""
    return child.join(sent(parents.select("order_id", DAY).distinct(), n), "order_id")


def _of_orders(child: DataFrame, ids: DataFrame) -> DataFrame:
    """Child rows whose order is in ``ids``.

    Ids meet first, each once: those without an order are mostly few, and then no child row is shuffled to be left out.
    """
    others = child.select("order_id").distinct().join(ids, "order_id", "left_anti")
    others = cut_lineage(others, "other-orders")
    n = others.count()
    if n > SENT_KEYS:
        return child.join(ids, "order_id", "left_semi").select(*child.columns)
    named = child.where(F.col("order_id").isNotNull())
    return named.join(sent(others, n), "order_id", "left_anti").select(*child.columns)


def _flagged(df: DataFrame, name: str, plan: Plan, **rates: float) -> DataFrame:
    """Add a flag per fault; rows of days without faults are never marked."""
    marked = with_sample_flags(df, DAY, IDENTITY[name], rates)
    faulty = _is(plan, "dirty", "mixed")
    return marked.withColumns({f"is_{fault}": F.col(f"is_{fault}") & faulty for fault in rates})


def _break_orders(df: DataFrame, plan: Plan) -> DataFrame:
    df = _flagged(df, "orders", plan, timestamp=plan.timestamp, status=plan.status)
    bought = F.col("order_purchase_timestamp")
    us_style = F.date_format(bought.try_cast("timestamp_ntz"), "MM/dd/yyyy HH:mm")
    loud = F.concat(F.lit("  "), F.upper("order_status"), F.lit(" "))
    return df.withColumn(
        "order_purchase_timestamp", F.when(F.col("is_timestamp"), F.coalesce(us_style, bought)).otherwise(bought)
    ).withColumn("order_status", F.when(F.col("is_status"), loud).otherwise(F.col("order_status")))


def _break_items(df: DataFrame, plan: Plan) -> DataFrame:
    df = _flagged(df, "order_items", plan, price=plan.price)
    kind = F.when(F.col("is_price"), hash_choice((DAY, *IDENTITY["order_items"]), "price_kind", 3))
    df = df.withColumn("_kind", kind)
    numeric = F.col("price").rlike(UNSIGNED_NUMBER)
    new_price = (
        F.when((F.col("_kind") == 0) & numeric, F.concat(F.lit("-"), F.col("price")))
        .when(F.col("_kind") == 2, F.lit("N/A"))
        .otherwise(F.col("price"))
    )
    new_freight = F.when(F.col("_kind") == 1, F.lit(None)).otherwise(F.col("freight_value"))
    return df.withColumn("price", new_price).withColumn("freight_value", new_freight)


def _break_reviews(df: DataFrame, plan: Plan) -> DataFrame:
    df = _flagged(df, "order_reviews", plan, review=plan.review)
    pick = hash_choice((DAY, *IDENTITY["order_reviews"]), "review_kind", len(BAD_SCORES) + 1)
    # The position past the last score gives null: the empty field.
    bad = F.get(F.array(*[F.lit(s) for s in BAD_SCORES]), pick)
    return df.withColumn("review_score", F.when(F.col("is_review"), bad).otherwise(F.col("review_score")))


def _break_payments(df: DataFrame, plan: Plan) -> DataFrame:
    df = _flagged(df, "order_payments", plan, payment=plan.payment)
    loud = F.concat(F.upper("payment_type"), F.lit(" "))
    return df.withColumn(
        "payment_type", F.when(F.col("is_payment"), loud).otherwise(F.col("payment_type"))
    )


def daily_batches(source: Mapping[str, DataFrame], plan: Plan = Plan()) -> dict[str, DataFrame]:
    """The four dynamic inputs of every day, each row with its ``batch_day``."""
    columns = {name: source[name].columns for name in DYNAMIC_INPUTS}
    dated = order_day(source["orders"])
    inside = F.col("order_day").between(F.lit(plan.first_day), F.lit(plan.last_day))
    # The source may be worked out where it is read: the days are, once.
    today = cut_lineage(dated.where(inside).withColumn(DAY, F.col("order_day")).drop("order_day"), "batch-days")

    drawn = with_sample_flags(today, DAY, IDENTITY["orders"], {"resend": plan.resend})
    resent = (
        drawn.where("is_resend")
        .drop("is_resend")
        .withColumn(DAY, F.date_add(DAY, 1))
        .where(_is(plan, "duplicate", "mixed") & (F.col(DAY) <= F.lit(plan.last_day)))
    )
    # Written once: every child joins to the orders, and each sample reads its rows repeatedly.
    orders = cut_lineage(today.unionByName(resent), "batch-orders")
    n = orders.count()

    def children(name: str) -> Callable[[], DataFrame]:
        return lambda: cut_lineage(children_of(source[name], orders, n), f"batch-{name}")

    items, payments, reviews = side_by_side(
        orders.sparkSession, children("order_items"), children("order_payments"), children("order_reviews")
    )
    broken = {
        "orders": _break_orders(orders, plan),
        "order_items": _break_items(items, plan),
        "order_payments": _break_payments(payments, plan),
        "order_reviews": _break_reviews(reviews, plan),
    }
    return {name: df.select(*columns[name], DAY) for name, df in broken.items()}


def seed_batch(
    source: Mapping[str, DataFrame], plan: Plan = Plan(), names: Iterable[str] = (*DYNAMIC_INPUTS, *STATIC_INPUTS)
) -> dict[str, DataFrame]:
    """Inputs up to the day before the first batch."""
    orders = order_day(source["orders"]).where(F.col("order_day") < F.lit(plan.first_day)).drop("order_day")
    seed = {}
    for name in names:
        if name == "orders":
            seed[name] = orders
        elif name in DYNAMIC_INPUTS:
            seed[name] = _of_orders(source[name], orders.select("order_id"))
        else:
            seed[name] = _break_categories(source[name], plan) if name == "products" else source[name]
    return seed


def _break_categories(products: DataFrame, plan: Plan) -> DataFrame:
    marked = with_sample_flags(
        products.withColumn("_all", F.lit(SEED)), "_all", IDENTITY["products"], {"category": plan.category}
    )
    name = F.col("product_category_name")
    loud = F.concat(F.lit(" "), F.upper(name), F.lit("  "))
    return marked.withColumn(
        "product_category_name", F.when(F.col("is_category") & (name != ""), loud).otherwise(name)
    ).select(*products.columns)


def batch_id_of(day: Column) -> Column:
    return F.concat(F.lit(BATCH_PREFIX), F.date_format(day, "yyyyMMdd"))


def write_seed(source: Mapping[str, DataFrame], out: str, plan: Plan = Plan()) -> None:
    def write(name: str) -> None:
        write_csv(seed_batch(source, plan, [name])[name], out, name, "gzip")

    side_by_side(source["orders"].sparkSession, *[partial(write, name) for name in (*DYNAMIC_INPUTS, *STATIC_INPUTS)])


def write_day(source: Mapping[str, DataFrame], out: str, day: dt.date, plan: Plan = Plan()) -> str:
    """Write one day's folder and return its batch id."""
    batch_id = f"{BATCH_PREFIX}{day:%Y%m%d}"
    # The day before is enough to draw the orders that are sent again.
    wanted = order_day(source["orders"]).where(
        F.col("order_day").between(F.lit(day - dt.timedelta(days=1)), F.lit(day))
    )
    near = {**source, "orders": wanted.drop("order_day")}
    rows = {n: df.where(F.col(DAY) == F.lit(day)).drop(DAY) for n, df in daily_batches(near, plan).items()}
    writes = [partial(write_csv, df, f"{out}/{batch_id}", name) for name, df in rows.items()]
    side_by_side(wanted.sparkSession, *writes)
    return batch_id
