"""The runs: seed, one batch, the next batch, rebuild, rollback, reset.

A run may be repeated at any time and leaves the same tables. The audit is written last:
it is the list of finished batches, so a run that broke off is picked up again.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.functions import labels
from mercata.operators.keyed import narrow_to_keys, upsert_columns
from mercata.plans import audit, checks, mart, staging
from mercata.plans.generator import SEED
from mercata.schemas import DYNAMIC_INPUTS, STATE, STATIC_INPUTS
from mercata.session import cut_lineage, recorded_scratch, remove, side_by_side
from mercata.sources import batches
from mercata.sources.warehouse import RAW_DYNAMIC, STAGING_DYNAMIC, Warehouse

DIMENSIONS = ("dim_product", "dim_customer", "dim_seller")

def load_raw(wh: Warehouse, folder: str, batch_id: str, names: Iterable[str], ingested_at=None) -> None:
    """Raw tables of one batch. A batch that is loaded again keeps the time it was first loaded."""
    ingested_at = ingested_at or _first_loaded(wh, batch_id)
    loaded = batches.load_batch(wh.spark, folder, batch_id, tuple(names), ingested_at)
    side_by_side(wh.spark, *[partial(wh.replace_batch, name, df, batch_id) for name, df in loaded.items()])


def _first_loaded(wh: Warehouse, batch_id: str) -> dt.datetime | None:
    known = [n for n in RAW_DYNAMIC if wh.has_batch(n, batch_id)]
    times = [wh.read_batch(n, batch_id).agg(F.unix_micros(F.min("ingested_at"))).first()[0] for n in known]
    times = [t for t in times if t is not None]
    return dt.datetime.fromtimestamp(min(times) / 1e6, dt.timezone.utc) if times else None


def stage_static(wh: Warehouse) -> None:
    staged = {n: staging.STATIC_STAGERS[n](wh.read(f"raw_{n}")) for n in STATIC_INPUTS}
    side_by_side(wh.spark, *[partial(wh.replace, f"stg_{n}", df) for n, df in staged.items()])


def _orders_of(wh: Warehouse, batch_id: str, ids: DataFrame) -> DataFrame:
    """Staged orders: all those of the batch from its folder, earlier ones by id from the buckets of their keys."""
    earlier = wh.keyed("order_keys").lookup(ids).where(F.col("batch_id") != batch_id)
    return earlier.unionByName(wh.read_batch("stg_orders", batch_id).select(*earlier.columns))


def stage_dynamic(wh: Warehouse, batch_id: str, policy: str = "reference") -> None:
    """Stage the four inputs of one batch against all other batches, orders first."""
    def stage(name: str) -> staging.Staged:
        raw = wh.read_batch(f"raw_{name}", batch_id)
        wanted = raw.select(F.trim("order_id").alias("order_id")).distinct()
        keys = "order_keys" if name == "orders" else f"{name}_keys"
        existing = wh.keyed(keys).lookup(wanted).where(F.col("batch_id") != batch_id)
        if name == "orders":
            staged = staging.stage_orders(raw, existing, policy)
        else:
            # Rows in doubt are written, so that the rejects do not shuffle all rows again.
            hold = partial(cut_lineage, label=f"doubtful-{name}")
            parents = _orders_of(wh, batch_id, wanted)
            if wh.keyed("order_keys").exists():  # history is looked up once, not by each reader
                parents = cut_lineage(parents.select("order_id", "ingested_at"), f"parents-{name}")
            staged = staging.CHILD_STAGERS[name](raw, parents, existing, policy, hold)
        wh.replace_batch(f"stg_{name}", staged.clean, batch_id)
        return staged

    first, *children = DYNAMIC_INPUTS
    done = [stage(first), *side_by_side(wh.spark, *[partial(stage, name) for name in children])]
    wh.replace_batch("rejected_rows", reduce(DataFrame.unionByName, [s.rejects for s in done]), batch_id)


def write_audit(wh: Warehouse, batch_id: str, started: float) -> None:
    run = wh.spark.range(1).select(
        F.lit(batch_id).alias("batch_id"),
        F.current_timestamp().alias("run_time"),
        F.lit(round(time.time() - started, 2)).alias("duration_sec"),
    )
    counted = audit.audit_batches(
        run,
        {n: wh.read_batch(n, batch_id) for n in RAW_DYNAMIC},
        wh.read_batch("rejected_rows", batch_id),
        {n: wh.read_batch(n, batch_id) for n in STAGING_DYNAMIC},
    )
    wh.replace_batch("load_audit", counted, batch_id)


# -- mart --------------------------------------------------------------------------


def build_static_dimensions(wh: Warehouse) -> None:
    """Products keep the sizes first loaded and follow later names; sellers follow all columns."""
    products = mart.build_dim_product(*wh.tables("stg_products", "stg_category_translation").values())
    sellers = mart.build_dim_seller(wh.read("stg_sellers"))
    names = upsert_columns(wh.read("dim_product"), products, ["product_id"], ["category_pt", "category_en"])
    places = upsert_columns(wh.read("dim_seller"), sellers, ["seller_id"], ["seller_city", "seller_state"])
    side_by_side(
        wh.spark, partial(wh.replace, "dim_product", names), partial(wh.replace, "dim_seller", places)
    )


def rebuild_mart(wh: Warehouse) -> None:
    """Build customers, both facts and all that batches look up from all of staging."""
    stg = wh.tables(*STAGING_DYNAMIC, "stg_customers")
    orders, items, payments, reviews, people = stg.values()
    with recorded_scratch() as own:
        bought = cut_lineage(mart.bought_orders(orders, people), "bought-orders")
    side_by_side(
        wh.spark,
        partial(wh.keyed("person_batches").rebuild, mart.person_batches_of(bought, items, bought)),
        *[partial(wh.keyed(f"{n}_keys").rebuild, wh.read(f"stg_{n}")) for n in DYNAMIC_INPUTS[1:]],
        partial(wh.keyed("order_keys").rebuild, orders),
        partial(wh.keyed("customer_keys").rebuild, people),
    )
    wh.keyed("dim_customer").rebuild(mart.dim_customer_of(wh.read("person_batches")))
    # What shuffles most runs one after the other, so that disks hold the shuffles of one step at a time.
    with recorded_scratch() as looked_up:
        placed = cut_lineage(mart.with_dimensions(items, wh.read("dim_product"), wh.read("dim_seller")), "placed-items")
    sold = bought.where(labels.is_kept_status())
    facts = mart.item_facts(placed, sold)
    # The writer sorts by batch anyway; rows of an order side by side take less space.
    wh.replace_all_batches("fct_order_items", facts.sortWithinPartitions("batch_id", "order_id"))
    remove(wh.spark, looked_up)
    flagged = mart.with_repeat_flag(sold, wh.read("dim_customer"))
    wh.keyed("fct_orders").rebuild(mart.order_facts(flagged, items, payments, reviews))
    remove(wh.spark, own)


def update_mart(wh: Warehouse, batch_id: str) -> None:
    """Bring the mart up to date with one staged batch. Only the batch and the buckets of its keys are read.

    What the batch adds to each person is kept with the batch's name, so a person's totals are sums over few
    rows, and a batch that is run again takes the place of what it added before. What batches look up changes last:
    until then a run that broke off can be repeated, also with other rows.
    """
    own = {n: wh.read_batch(f"stg_{n}", batch_id) for n in DYNAMIC_INPUTS}
    persons, customers = wh.keyed("person_batches"), wh.keyed("dim_customer")
    parents = cut_lineage(
        _orders_of(wh, batch_id, own["orders"].select("order_id").union(own["order_items"].select("order_id")).distinct()), "parents"
    )
    people = cut_lineage(wh.keyed("customer_keys").lookup(parents.select("customer_id").distinct()), "people")
    added = cut_lineage(mart.person_batches(own["orders"], own["order_items"], parents, people), "person-batch")
    # People of this batch, now or when it was last run.
    touched = added.select("customer_unique_id").union(persons.rows_of_batch(batch_id).select("customer_unique_id")).distinct()
    others = persons.lookup(touched).where(F.col("batch_id") != batch_id)
    histories = cut_lineage(others.unionByName(added), "person-histories")
    known = cut_lineage(mart.dim_customer_of(histories), "person-totals")

    facts = mart.build_fct_order_items(own["order_items"], parents, people, wh.read("dim_product"), wh.read("dim_seller"))
    changed = cut_lineage(_order_facts(wh, batch_id, own, parents, people, histories, known), "order-facts")
    former = wh.keyed("order_keys").rows_of_batch(batch_id).select("order_id")
    side_by_side(
        wh.spark,
        partial(wh.replace_batch, "fct_order_items", facts, batch_id),
        partial(wh.keyed("fct_orders").fold, changed, batch_id, former),
        partial(customers.fold, known, batch_id, touched),
    )
    side_by_side(
        wh.spark,
        partial(persons.fold, added, batch_id, touched, replace=False),
        partial(wh.keyed("order_keys").fold, own["orders"], batch_id, replace=False),
        *[partial(wh.keyed(f"{n}_keys").fold, own[n], batch_id, replace=False) for n in DYNAMIC_INPUTS[1:]],
    )


def _order_facts(wh: Warehouse, batch_id: str, own: dict[str, DataFrame], parents, people, histories, known) -> DataFrame:
    """The order facts of a batch, and those of earlier orders that it changes.

    An earlier order changes when the batch brings (or brought) a review for it, or when it is the only other order of a
    person of the batch: whether that person is a repeat customer depends on the batch.
    """
    reviews, facts = wh.keyed("order_reviews_keys"), wh.keyed("fct_orders")
    reviewed = own["order_reviews"].select("order_id").union(reviews.rows_of_batch(batch_id).select("order_id"))
    flagged = cut_lineage(mart.only_other_orders(histories, known, batch_id), "repeat-flags")
    ids = own["orders"].select("order_id")
    all_ids = cut_lineage(ids.union(reviewed).union(flagged.select("order_id")).distinct(), "changed-orders")
    scores = reviews.lookup(all_ids).where(F.col("batch_id") != batch_id)
    scores = scores.unionByName(own["order_reviews"].select(*scores.columns))

    fresh = mart.build_fct_orders(
        own["orders"], people, own["order_items"], own["order_payments"], narrow_to_keys(scores, ids, ["order_id"]), known
    )
    earlier = facts.lookup(all_ids).where(F.col("batch_id") != batch_id)
    return fresh.unionByName(mart.refreshed_orders(earlier, mart.reviews_per_order(scores), flagged))


# -- runs --------------------------------------------------------------------------


def run_seed(wh: Warehouse, folder: str, policy: str = "reference", ingested_at=None) -> None:
    """Load history and the static tables, and build the mart from them."""
    started = time.time()
    load_raw(wh, folder, SEED, (*DYNAMIC_INPUTS, *STATIC_INPUTS), ingested_at)
    stage_static(wh)
    stage_dynamic(wh, SEED, policy)
    build_static_dimensions(wh)
    rebuild_mart(wh)
    write_audit(wh, SEED, started)
    wh.changed()


def run_batch(wh: Warehouse, folder: str, batch_id: str, policy: str = "reference", ingested_at=None) -> None:
    """Load one daily batch from ``folder`` and bring the mart up to date."""
    started = time.time()
    checks.require_seed(wh.tables(*DIMENSIONS))
    load_raw(wh, folder, batch_id, DYNAMIC_INPUTS, ingested_at)
    stage_dynamic(wh, batch_id, policy)
    update_mart(wh, batch_id)
    checks.require_clean(wh.read_batch("fct_order_items", batch_id))
    write_audit(wh, batch_id, started)
    wh.changed()


def run_next_batch(wh: Warehouse, root: str, policy: str = "reference") -> str | None:
    """Load the first batch folder below ``root`` that is not audited yet; None when all are."""
    batch_id = batches.next_batch(batches.available_batches(wh.spark, root), wh.read("load_audit"))
    if batch_id is not None:
        run_batch(wh, f"{root}/{batch_id}", batch_id, policy)
    return batch_id


def rollback(wh: Warehouse, batch_ids: Iterable[str]) -> None:
    """Take batches out of every layer and rebuild the mart without them, dimensions included."""
    batch_ids = list(batch_ids)
    for name in (*RAW_DYNAMIC, *STAGING_DYNAMIC, "rejected_rows", "load_audit"):
        wh.drop_batches(name, batch_ids)
    rebuild_mart(wh)
    wh.changed()


def reset_dynamic(wh: Warehouse, orders_too: bool = False, audit_too: bool = False) -> None:
    """Drop loaded batches but keep the static tables.

    By default the order fact and the audit stay, so the batches still count as loaded;
    drop both to load them again.
    """
    names = [*RAW_DYNAMIC, *STAGING_DYNAMIC, "fct_order_items", "rejected_rows"]
    names += [n for n in STATE if n != "customer_keys"]
    names += ["fct_orders"] * orders_too + ["load_audit"] * audit_too
    for name in names:
        wh.clear(name)
    wh.changed()


def export_audit(wh: Warehouse, folder: str) -> None:
    """The audit as one CSV file, oldest run first; it has four rows per batch."""
    history = audit.load_history(wh.read("load_audit"))
    history.coalesce(1).write.mode("overwrite").option("header", "true").csv(folder)
