"""Seed and daily runs: equal to a replay of the whole history, repeatable, reversible."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import small
from mercata.plans import audit, catalog, checks, generator, jobs
from mercata.plans.workspace import Workspace
from mercata.sources import batches
from mercata.sources.keyed_table import KeyedTable
from mercata.sources.warehouse import RAW_DYNAMIC, STAGING_DYNAMIC, Warehouse

COMPARED = {
    **{n: () for n in (*STAGING_DYNAMIC, "dim_customer", "dim_product", "dim_seller")},
    "fct_order_items": ("loaded_at",),
    "fct_orders": ("loaded_at",),
    "load_audit": ("run_time", "duration_sec", "note"),
    "rejected_rows": ("rejected_at", "raw_payload"),
}


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).limit(5).collect() == []
    assert b.exceptAll(a).limit(5).collect() == []


def days():
    return [small.FIRST + dt.timedelta(days=n) for n in range(4)]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("batches"))
    source = small.source(spark)
    generator.write_seed(source, f"{root}/seed", small.PLAN)
    return root, [generator.write_day(source, root, d, small.PLAN) for d in days()]


@pytest.fixture(scope="module")
def loaded(spark, folders, tmp_path_factory):
    """The seed and all four days, one run after the other."""
    root, ids = folders
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    wh.create()
    midnight = dt.datetime.combine(small.FIRST, dt.time())
    jobs.run_seed(wh, f"{root}/seed", ingested_at=midnight - dt.timedelta(days=1))
    for n, batch_id in enumerate(ids):
        jobs.run_batch(wh, f"{root}/{batch_id}", batch_id, ingested_at=midnight + dt.timedelta(days=n))
    return wh


@pytest.fixture(scope="module")
def replay(spark):
    return Workspace(spark, small.source(spark), small.PLAN)


def test_scenarios_show_in_the_audit(loaded):
    rows = {
        r.batch_id: r
        for r in catalog.view(loaded.tables("load_audit"), "vw_batch_summary").collect()
    }
    first, second, third, fourth = [rows[f"batch_202003{d:02d}"] for d in (1, 2, 3, 4)]
    assert first.rows_dup == first.rows_rejected == 0 and first.quality_score == 100
    assert second.rows_dup > 0 and second.rows_rejected == 0
    assert third.rows_rejected > 0
    assert fourth.rows_dup > 0 and fourth.rows_rejected > 0
    for r in rows.values():
        assert r.rows_in == r.rows_dup + r.rows_rejected + r.rows_loaded


@pytest.mark.parametrize("table", COMPARED)
def test_daily_runs_equal_a_replay(loaded, replay, table):
    drop = COMPARED[table]
    same(loaded.read(table).drop(*drop), replay[table].drop(*drop))


def test_a_late_child_does_not_change_the_order_fact(loaded):
    """A broken item that is sent again loads as an item but leaves the order as first loaded."""
    orders = loaded.read("stg_orders").select("order_id", F.col("batch_id").alias("order_batch"))
    late = loaded.read("stg_order_items").join(orders, "order_id").where("batch_id <> order_batch")
    assert late.count() > 0
    counted = loaded.read("fct_order_items").groupBy("order_id").agg(F.count("*").alias("n"))
    differs = loaded.read("fct_orders").join(counted, "order_id").where("n > item_count")
    assert differs.count() > 0


def test_running_a_batch_again_changes_nothing(spark, loaded, folders, replay):
    root, ids = folders
    at = dt.datetime.combine(small.FIRST, dt.time()) + dt.timedelta(days=3)
    jobs.run_batch(loaded, f"{root}/{ids[3]}", ids[3], ingested_at=at)
    for table, drop in COMPARED.items():
        same(loaded.read(table).drop(*drop), replay[table].drop(*drop))


def test_rebuild_equals_the_daily_runs(loaded, replay):
    jobs.rebuild_mart(loaded)
    for table in ("dim_customer", "fct_order_items", "fct_orders"):
        drop = COMPARED[table]
        same(loaded.read(table).drop(*drop), replay[table].drop(*drop))


def test_declared_keys_and_not_nulls_hold(loaded):
    for table in ("stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews", "stg_products",
                  "stg_customers", "stg_sellers", "dim_customer", "dim_product", "fct_order_items", "fct_orders"):
        row = checks.constraint_breaches(loaded.read(table), table).first()
        assert set(row) == {0}, (table, row)


def test_evidence(loaded):
    names = ("raw_orders", "stg_orders", "fct_order_items", "load_audit")
    shown = checks.evidence(loaded.tables(*names))
    assert shown["load_audit"].count() == 20 and shown["repeated_keys"].isEmpty()
    assert shown["orphan_items"].first().orphans == 0
    assert {r.table_name for r in shown["layer_counts"].collect()} == set(names)


def test_next_batch_and_status(spark, loaded, folders):
    root, ids = folders
    available = batches.available_batches(spark, root)
    assert jobs.run_next_batch(loaded, root) is None
    earlier = loaded.read("load_audit").where(F.col("batch_id") < ids[2])
    assert batches.next_batch(available, earlier) == ids[2]
    status = {r.batch_id: (r.is_available, r.is_loaded) for r in batches.batch_status(available, earlier).collect()}
    assert status[ids[0]] == (True, True) and status[ids[3]] == (True, False)


def test_export_of_the_audit(spark, loaded, tmp_path):
    jobs.export_audit(loaded, str(tmp_path / "audit"))
    rows = spark.read.option("header", "true").csv(str(tmp_path / "audit")).collect()
    assert len(rows) == 20 and rows[0].batch_id == "seed"


def test_rollback_and_loading_again(spark, loaded, folders, replay):
    root, ids = folders
    before = audit.snapshot(*loaded.tables("load_audit", "fct_order_items", "rejected_rows").values()).first()
    jobs.rollback(loaded, ids[2:])
    for name in (*RAW_DYNAMIC, *STAGING_DYNAMIC, "load_audit", "rejected_rows", "fct_orders", "fct_order_items"):
        assert not set(ids[2:]) & set(loaded.batch_ids(name)), name
    after = audit.snapshot(*loaded.tables("load_audit", "fct_order_items", "rejected_rows").values())
    assert after.first().batches == before.batches - 2
    delta = {r.measure: r.delta for r in audit.snapshot_delta(
        spark.createDataFrame([before]), after).collect()}
    assert delta["batches"] == -2 and delta["item_rows"] < 0
    people = loaded.read("dim_customer").agg(F.sum("total_orders")).first()[0]
    assert people < replay["dim_customer"].agg(F.sum("total_orders")).first()[0]
    assert jobs.run_next_batch(loaded, root) == ids[2]


def test_reset_keeps_static_tables(spark, loaded):
    jobs.reset_dynamic(loaded)
    assert loaded.read("stg_orders").isEmpty() and loaded.read("fct_order_items").isEmpty()
    assert not loaded.read("stg_customers").isEmpty() and not loaded.read("fct_orders").isEmpty()
    assert not loaded.read("load_audit").isEmpty()
    jobs.reset_dynamic(loaded, orders_too=True, audit_too=True)
    assert loaded.read("fct_orders").isEmpty() and loaded.read("load_audit").isEmpty()


def test_a_batch_needs_the_seed(spark, folders, tmp_path):
    root, ids = folders
    wh = Warehouse(spark, str(tmp_path / "empty"))
    wh.create()
    with pytest.raises(checks.CheckFailed, match="dim_customer, dim_product, dim_seller"):
        jobs.run_batch(wh, f"{root}/{ids[0]}", ids[0])


def test_versions_of_whole_tables(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for n in range(4):
        wh.replace("dim_seller", spark.createDataFrame([(f"s{n}", "x", "y")], wh_ddl()))
    assert [r.seller_id for r in wh.read("dim_seller").collect()] == ["s3"]
    assert len(wh._versions("dim_seller")) == 2


def wh_ddl():
    return "seller_id string, seller_city string, seller_state string"


def _files(folder):
    return {str(p): p.read_bytes() for p in Path(folder).rglob("*.parquet")}


@pytest.fixture(scope="module")
def two_days(spark, folders, tmp_path_factory):
    """A warehouse after the seed and the first day, with its views registered."""
    root, ids = folders
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("two-days")))
    wh.create()
    jobs.run_seed(wh, f"{root}/seed")
    jobs.run_batch(wh, f"{root}/{ids[0]}", ids[0])
    catalog.register_views(wh, vw_category_growth={"start": small.FIRST.replace(year=2019), "min_orders": 2})
    return wh


def test_a_run_that_breaks_off_loses_nothing(spark, two_days, folders, monkeypatch):
    root, ids = folders
    wh, fold = two_days, KeyedTable.fold
    earlier = _files(wh.path("fct_order_items"))
    rows = wh.read("fct_orders")
    before = rows.collect()

    # Broken off before the order fact changes, and again once it has changed but nothing else has.
    for table in ("fct_orders", "order_keys"):

        def broken(self, *args, table=table, **kwargs):
            if self.root.endswith(table):
                raise OSError("lost")
            fold(self, *args, **kwargs)

        monkeypatch.setattr(KeyedTable, "fold", broken)
        with pytest.raises(OSError, match="lost"):
            jobs.run_batch(wh, f"{root}/{ids[1]}", ids[1])
        assert ids[1] not in wh.batch_ids("load_audit")
        if table == "fct_orders":
            assert sorted(wh.read("fct_orders").collect()) == sorted(before)
        monkeypatch.undo()
    assert sorted(rows.collect()) == sorted(before)  # what was read before still reads the same
    assert jobs.run_next_batch(wh, root) == ids[1]
    now = wh.read("fct_orders")
    assert now.count() > len(before)
    # Folders of earlier batches are as they were, byte for byte, and yet some earlier orders changed.
    assert _files(wh.path("fct_order_items")).items() >= earlier.items()
    kept = [c for c in now.columns if c != "loaded_at"]
    changed = now.where(F.col("batch_id") != ids[1]).select(kept).exceptAll(spark.createDataFrame(before, now.schema).select(kept))
    assert changed.count() > 0


def test_registered_views_follow_the_warehouse(spark, two_days, folders):
    root, ids = folders
    for n in (2, 3):
        jobs.run_batch(two_days, f"{root}/{ids[n]}", ids[n])
        for name in ("vw_pipeline_health", "vw_category_perf", "vw_seller_detail", "vw_customer_summary"):
            same(spark.sql(f"select * from {name}"), catalog.view(two_days.tables(*catalog.BASE_TABLES), name))
    assert spark.sql("select so_batch_da_chay from vw_pipeline_health").first()[0] == 5


def test_a_batch_loaded_again_keeps_its_first_time(spark, two_days, folders):
    root, ids = folders
    times = two_days.read("raw_orders").select("batch_id", "ingested_at").distinct()
    before = sorted(times.collect())
    customers = sorted(two_days.read("dim_customer").collect())
    jobs.run_batch(two_days, f"{root}/{ids[1]}", ids[1])
    after = two_days.read("raw_orders").select("batch_id", "ingested_at").distinct()
    assert sorted(after.collect()) == before
    assert sorted(two_days.read("dim_customer").collect()) == customers


def test_views_do_no_work_when_built(spark, two_days):
    tracker = spark.sparkContext.statusTracker()
    tables = two_days.tables(*catalog.BASE_TABLES)
    spark.sparkContext.setJobGroup("views", "building views")
    for name in catalog.VIEWS:
        catalog.view(tables, name)
    assert tracker.getJobIdsForGroup("views") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def executed(plan):
    """The lines of an adaptive plan that ran, without its first drafts."""
    kept, draft = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if draft is not None and depth >= draft:
            continue
        draft = depth if "== Initial Plan ==" in line else None
        if draft is None:
            kept.append(line)
    return kept


@pytest.mark.parametrize("name", ["vw_seller_scorecard", "vw_seller_concentration"])
def test_sellers_need_one_scan_of_the_items(spark, two_days, name):
    view = catalog.view(two_days.tables(*catalog.BASE_TABLES), name)
    view.collect()
    lines = executed(view._jdf.queryExecution().executedPlan().toString())
    assert sum("FileScan" in line and "item_revenue" in line for line in lines) == 1
