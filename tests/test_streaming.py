"""Streams: unseen batches are loaded once and in order; replays change nothing."""

import datetime as dt

from pyspark.sql import functions as F

import small
from mercata.plans import generator, jobs
from mercata.sources import batches
from mercata.sources.warehouse import Warehouse
from mercata.streaming import ingest


def test_batches_are_loaded_as_they_appear(spark, tmp_path):
    source = small.source(spark)
    root, checkpoint = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    generator.write_seed(source, f"{tmp_path}/seed", small.PLAN)
    days = [small.FIRST + dt.timedelta(days=n) for n in range(2)]
    first = generator.write_day(source, root, days[0], small.PLAN)
    wh = Warehouse(spark, f"{tmp_path}/wh")
    wh.create()
    jobs.run_seed(wh, f"{tmp_path}/seed")

    ingest.ingest_batches(wh, root, checkpoint).awaitTermination()
    assert set(wh.batch_ids("load_audit")) == {"seed", first}
    # All files of a batch share one load time, so no child of these clean batches is an orphan.
    assert wh.read("rejected_rows").isEmpty()
    assert wh.read("load_audit").agg({"rows_dup": "max"}).first()[0] == 0
    rows = wh.read("fct_orders").count()

    second = generator.write_day(source, root, days[1], small.PLAN)
    ingest.ingest_batches(wh, root, checkpoint).awaitTermination()
    assert set(wh.batch_ids("load_audit")) == {"seed", first, second}
    assert wh.read("fct_orders").count() > rows
    audited = wh.read("load_audit").select("batch_id", "run_time").distinct().collect()

    # A new checkpoint sees all folders again, but the audit knows them.
    ingest.ingest_batches(wh, root, f"{tmp_path}/other").awaitTermination()
    again = wh.read("load_audit").select("batch_id", "run_time").distinct().collect()
    assert sorted(again) == sorted(audited)


def test_a_batch_without_orders_is_loaded(spark, tmp_path):
    source = small.source(spark)
    root = f"{tmp_path}/in"
    generator.write_seed(source, f"{tmp_path}/seed", small.PLAN)
    late = source["order_payments"].where("order_id = 'o1'").withColumns(
        {"payment_sequential": F.lit("9"), "payment_value": F.lit("1.00")}
    )
    batches.write_csv(late, f"{root}/batch_20200301", "order_payments")
    wh = Warehouse(spark, f"{tmp_path}/wh")
    wh.create()
    jobs.run_seed(wh, f"{tmp_path}/seed")
    ingest.ingest_batches(wh, root, f"{tmp_path}/checkpoint").awaitTermination()
    assert wh.batch_ids("load_audit") == ["batch_20200301", "seed"]
    assert wh.read_batch("stg_order_payments", "batch_20200301").count() == 1


def test_a_new_checkpoint_adds_nothing(spark, tmp_path):
    rows = [("o1", "c1", "shipped", "2020-01-01 10:00:00"), ("o2", "c2", "shipped", "bad"), ("o2", "c2", "shipped", "bad")]
    raw = spark.createDataFrame(rows, "order_id string, customer_id string, order_status string, order_purchase_timestamp string")
    raw.withColumns({"batch_id": F.lit("b1"), "ingested_at": F.current_timestamp()}).write.parquet(f"{tmp_path}/raw")
    for n in range(2):
        ingest.stage_stream(spark, "orders", f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/c{n}").awaitTermination()
        assert ingest.read_staged(spark, f"{tmp_path}/out", "orders").count() == 1
        assert ingest.read_rejects(spark, f"{tmp_path}/out", "orders").count() == 2
