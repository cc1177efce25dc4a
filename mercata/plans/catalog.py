"""The eighteen views by name, over any set of mart tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from mercata.plans import delivery, overview, product, quality, seller
from mercata.sources.warehouse import Warehouse

# View: its builder and the tables it reads, in the builder's order.
VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "vw_daily_kpi": (overview.vw_daily_kpi, ("fct_order_items", "fct_orders")),
    "vw_category_contribution": (overview.vw_category_contribution, ("fct_order_items",)),
    "vw_state_revenue": (overview.vw_state_revenue, ("fct_order_items", "fct_orders", "dim_customer")),
    "vw_detail_items": (overview.vw_detail_items, ("fct_order_items", "fct_orders")),
    "vw_category_segment": (product.vw_category_segment, ("fct_order_items",)),
    "vw_category_perf": (product.vw_category_perf, ("fct_order_items",)),
    "vw_category_growth": (product.vw_category_growth, ("fct_order_items",)),
    "vw_seller_scorecard": (seller.vw_seller_scorecard, ("fct_order_items", "fct_orders", "dim_seller")),
    "vw_seller_concentration": (seller.vw_seller_concentration, ("fct_order_items", "dim_seller")),
    "vw_seller_detail": (seller.vw_seller_detail, ("fct_order_items", "fct_orders", "dim_seller")),
    "vw_delivery_perf": (delivery.vw_delivery_perf, ("fct_orders",)),
    "vw_delivery_distribution": (delivery.vw_delivery_distribution, ("fct_orders",)),
    "vw_delivery_route": (delivery.vw_delivery_route, ("fct_order_items", "fct_orders")),
    "vw_review_delay": (delivery.vw_review_delay, ("fct_orders",)),
    "vw_customer_summary": (delivery.vw_customer_summary, ("fct_orders",)),
    "vw_batch_summary": (quality.vw_batch_summary, ("load_audit",)),
    "vw_reject_summary": (quality.vw_reject_summary, ("rejected_rows",)),
    "vw_pipeline_health": (quality.vw_pipeline_health, ("load_audit",)),
}
BASE_TABLES = (
    "fct_order_items",
    "fct_orders",
    "dim_product",
    "dim_seller",
    "dim_customer",
    "load_audit",
    "rejected_rows",
)


def view(tables: Mapping[str, DataFrame], name: str, limit: int | None = None, **options) -> DataFrame:
    """One view; ``options`` are its thresholds, ``limit`` caps what a report shows."""
    build, needs = VIEWS[name]
    df = build(*[tables[t] for t in needs], **options)
    return df if limit is None else df.limit(limit)


def register_views(source: Warehouse | Mapping[str, DataFrame], **options: dict) -> None:
    """Make tables and views available to ``spark.sql``; ``options`` are per view.

    Views of a warehouse follow it: after each run in this session they show what was loaded.
    Views of single tables stay plans over these tables. No view does any work until it is read.
    """
    if isinstance(source, Warehouse):
        source.watch("views", lambda wh: _register(wh.tables(*BASE_TABLES), options))
    else:
        _register(source, options)


def _register(tables: Mapping[str, DataFrame], options: Mapping[str, dict]) -> None:
    for name in BASE_TABLES:
        if name in tables:
            tables[name].createOrReplaceTempView(name)
    for name, (_, needs) in VIEWS.items():
        if all(t in tables for t in needs):
            view(tables, name, **options.get(name, {})).createOrReplaceTempView(name)


class Session:
    """SQL over a warehouse that other sessions load as well.

    Before each statement the warehouse is asked what it holds; if that has changed since the last one, by whatever
    session, tables and views are registered anew. So a statement always sees what a fresh read would see.
    """

    def __init__(self, warehouse: Warehouse, **options: dict):
        self.warehouse, self.options, self._seen = warehouse, options, None

    def sql(self, statement: str) -> DataFrame:
        held = self.warehouse.state()
        if held != self._seen:
            _register(self.warehouse.tables(*BASE_TABLES), self.options)
            self._seen = held
        return self.warehouse.spark.sql(statement)
