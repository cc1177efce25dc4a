"""Steps that work out, shuffle or write rows once where they did so twice; the rows are the same."""

import datetime as dt
from contextlib import nullcontext
from pathlib import Path

import pytest
import small
from pyspark.sql import functions as F

from mercata import session
from mercata.functions import labels
from mercata.operators.keyed import insert_if_absent
from mercata.plans import generator, jobs, mart, queries, staging
from mercata.plans.workspace import StoredSource, Workspace
from mercata.schemas import MALFORMED, RAW
from mercata.sources import batches
from mercata.sources.warehouse import Warehouse
from mercata.streaming import ingest


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def listed(df):
    return sorted(map(str, df.collect()))


def test_new_rows_are_worked_out_once(spark):
    new = spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).where("v < 30")
    old = spark.range(0, 10, 2).select(F.col("id").alias("k"))
    found = insert_if_absent(new, old, ["k"])
    assert plan(found).count("Join") == 1 and plan(found).count("Range (0, 20") == 1
    assert sorted(r["k"] for r in found.collect()) == [1, 3, 5, 7, 9, 10, 11, 12, 13, 14]


def test_no_history_costs_no_join(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create()
    ids = spark.range(5).select(F.col("id").cast("string").alias("order_id"))
    known = wh.keyed("order_keys").lookup(ids).select("order_id")
    assert known.isEmpty() and "Join" not in plan(insert_if_absent(ids, known, ["order_id"]))
    assert "Join" not in plan(insert_if_absent(ids, wh.read_batch("stg_orders", "seed"), ["order_id"]))


def test_seed_files_are_compressed_and_read_back(spark, tmp_path):
    source = small.source(spark)
    generator.write_seed(source, str(tmp_path), small.PLAN)
    parts = list(Path(tmp_path).rglob("part-*"))
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    want = generator.seed_batch(source, small.PLAN)
    for name, raw in batches.load_batch(spark, str(tmp_path), "seed").items():
        columns = want[name.removeprefix("raw_")].columns
        got = raw.select(*columns)
        assert got.exceptAll(want[name.removeprefix("raw_")]).isEmpty() and got.count() == want[name.removeprefix("raw_")].count()


def test_staging_alone_writes_no_raw_children(spark):
    w, other = (Workspace(spark, small.source(spark), small.PLAN) for _ in range(2))
    staged = listed(w["stg_order_items"])
    assert "raw_order_items" not in w._tables and staged
    assert other["raw_order_items"].count() > len(staged) and listed(other["stg_order_items"]) == staged


def test_items_meet_their_orders_last(spark):
    w = Workspace(spark, small.source(spark), small.PLAN)
    joins = [line for line in plan(w._fct_order_items()).splitlines() if "Join" in line]
    assert "order_id" in joins[0] and "Inner" in joins[0]


def test_streams_run_for_what_is_asked_for(spark):
    w = Workspace(spark, small.source(spark), small.PLAN)
    assert queries.BUILDERS["stream_stage_orders"](w).count() == w["stg_orders"].count() and w.streamed == {"orders"}
    assert queries.BUILDERS["stream_stage_items"](w).count() == w["stg_order_items"].count()
    assert w.streamed == {"orders", "order_items"}


ODD_ITEMS = [
    ("o1", "1", "10.00"), (" o1 ", "2", "10.00"), ("o1", "1", "10.00"), ("o1", "3", "-1.00"), ("o1", "x", "1.00"), ("o1", "4", None),
    ("none", "1", "1.00"), ("none", "2", "N/A"), (None, "1", "1.00"), ("  ", "1", "1.00"), ("late", "1", "1.00"),
] + [("o2", str(n), "5.00") for n in range(1, 31)]


@pytest.mark.parametrize("policy", staging.POLICIES)
def test_rejects_meet_the_orders_as_rows_in_doubt_alone(spark, policy):
    at, later = dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 3)
    ddl = "order_id string, ingested_at timestamp"
    orders = spark.createDataFrame([("o1", at), ("o2", at), ("late", later)], ddl)
    table = RAW["raw_order_items"]
    usual = {"product_id": "p", "seller_id": "s", "freight_value": "1.00", "batch_id": "b1", "ingested_at": at}
    rows = [usual | {"order_id": o, "order_item_id": n, "price": price} for o, n, price in ODD_ITEMS]
    rows.append(rows[0] | {MALFORMED: "a line,too long"})
    raw = spark.createDataFrame([tuple(r.get(c) for c in table.columns) for r in rows], table.ddl)
    held = []

    def hold(df):
        held.append(df.count())
        return df.localCheckpoint()

    plain = staging.stage_order_items(raw, orders, None, policy)
    spared = staging.stage_order_items(raw, orders, None, policy, hold)
    assert listed(spared.clean) == listed(plain.clean) and plain.clean.count() == 32
    assert listed(spared.rejects.drop("rejected_at")) == listed(plain.rejects.drop("rejected_at"))
    # Ids without an order, then the rows in doubt: not the 34 that are sound and have one.
    assert max(held) <= 10 and spared.rejects.count() == plain.rejects.count() >= 7


def test_shuffles_are_cut_by_the_size_of_the_input(spark):
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n, None) for n in names]
    rows = spark.range(50_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    with pytest.raises(OSError), session.fine_shuffles(spark, 100 * session.INPUT_PER_PARTITION):
        found = rows.groupBy("k").count()
        found.collect()
        assert "hashpartitioning(k" in found._jdf.queryExecution().executedPlan().toString()
        assert ", 100)" in found._jdf.queryExecution().executedPlan().toString()
        raise OSError
    assert [spark.conf.get(n, None) for n in names] == before
    spark.conf.set(names[1], "1m")
    try:
        with session.fine_shuffles(spark, 1):
            assert [spark.conf.get(n, None) for n in names] == ["4", "1m"]  # no coarser than the caller asked for
        assert [spark.conf.get(n, None) for n in names] == [before[0], "1m"]
    finally:
        spark.conf.unset(names[1]) if before[1] is None else spark.conf.set(names[1], before[1])


def test_queries_cut_their_shuffles(spark, sf_dir, monkeypatch):
    asked = []
    monkeypatch.setattr(queries, "fine_shuffles", lambda s, size: asked.append(size) or nullcontext())
    queries.all_queries()["profile_status"](spark, sf_dir)
    want = sum(Path(f"{sf_dir}/{n}.parquet").stat().st_size for n in ("orders", "lineitem", "customer", "part", "supplier"))
    assert asked == [want]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    names = [*session.BUILD_CONF]
    before, kept = [spark.conf.get(n, None) for n in names], shuffle_files(spark)
    with session.fine_shuffles(spark, 1):
        rows = spark.range(5_000).select(F.md5(F.col("id").cast("string")).alias("k")).groupBy("k").count()
        rows.write.parquet(str(tmp_path / "out"))
        assert not shuffle_files(spark) - kept
        assert rows.count() == 5_000 and len(rows.collect()) == len(rows.collect()) == 5_000
    assert [spark.conf.get(n, None) for n in names] == before


@pytest.mark.parametrize("few", [10, 0])
def test_seed_children_are_not_shuffled_for_their_orders(spark, monkeypatch, few):
    monkeypatch.setattr(session, "SENT_KEYS", few)
    monkeypatch.setattr(generator, "SENT_KEYS", few)
    source = small.source(spark)
    odd = [(None, "1", "p1", "v1", None, "1.00", "1.00"), ("nobody", "1", "p1", "v1", None, "1.00", "1.00")]
    items = source["order_items"].union(spark.createDataFrame(odd * 2, source["order_items"].schema))
    source["order_items"] = items.where("order_id is null or order_id in ('nobody', 'o1', 'o2', 'o90', 'o91')")
    found = generator.seed_batch(source, small.PLAN, ["order_items"])["order_items"]
    assert ("rightHint=(strategy=broadcast)" in plan(found)) == ("LeftSemi" not in plan(found)) == bool(few)
    want = source["order_items"].where("order_id in ('o1', 'o2')")
    assert listed(found) == listed(want) and want.count() > 2


def test_runs_map_the_tables_where_they_are_read(spark, sf_dir, tmp_path):
    w = Workspace(spark, StoredSource(spark, sf_dir))
    generator.write_day(w.inputs(), str(tmp_path), w.plan.first_day, w.plan)
    assert w.seed("order_payments").count() > 0 and not w.source._stored


def test_streams_write_their_raw_rows_once(spark):
    w = Workspace(spark, small.source(spark), small.PLAN)
    assert queries.BUILDERS["stream_stage_reviews"](w).count() > 0
    assert not [n for n in w._tables if n.startswith("raw_order")]


def test_a_file_is_named_by_a_path_that_is_no_pattern(spark, tmp_path):
    for n in (1, 2):
        spark.range(n).write.parquet(str(tmp_path / f"raw 50% [{n}]"))
    uri = f"file:{tmp_path}/raw%2050%25%20[2]"
    assert spark.read.parquet(ingest._literal(uri)).count() == 2


def test_a_later_micro_batch_leaves_history_in_place(spark, tmp_path, monkeypatch):
    raw, staged, seen = str(tmp_path / "raw 50%"), str(tmp_path / "staged"), []
    w = Workspace(spark, small.source(spark), small.PLAN)
    stage = staging.stage_orders
    monkeypatch.setattr(staging, "stage_orders", lambda rows, existing, policy: seen.append(plan(existing)) or stage(rows, existing, policy))
    for part in (F.col("batch_id") == "seed", F.col("batch_id") != "seed"):
        w.raw("orders").where(part).write.mode("append").parquet(raw)
        ingest.stage_stream(spark, "orders", raw, staged, str(tmp_path / "checkpoint")).awaitTermination()
    got = ingest.read_staged(spark, staged, "orders").drop("stream", "epoch")
    assert "LeftSemi" in seen[1] and "broadcast" in seen[1]
    monkeypatch.undo()
    assert listed(got) == listed(w["stg_orders"].select(*got.columns))


def test_people_are_looked_up_once(spark):
    w = Workspace(spark, small.source(spark), small.PLAN)
    orders, items, payments, reviews, people = w.some(*(f"stg_{n}" for n in generator.DYNAMIC_INPUTS), "stg_customers")
    bought = mart.bought_orders(orders, people).localCheckpoint()
    persons = mart.person_batches_of(bought, items, bought)
    assert plan(persons).count("Join") == 2
    assert listed(persons) == listed(mart.person_batches(orders, items, orders, people))
    sold = bought.where(labels.is_kept_status())
    flagged = mart.with_repeat_flag(sold, w["dim_customer"])
    found = mart.order_facts(flagged, items, payments, reviews).drop("loaded_at")
    assert listed(found) == listed(w["fct_orders"].drop("loaded_at"))
    found = mart.item_facts(mart.with_dimensions(items, w["dim_product"], w["dim_seller"]), sold).drop("loaded_at")
    assert listed(found) == listed(w["fct_order_items"].drop("loaded_at"))
