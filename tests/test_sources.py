"""CSV batches and the batch generator."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import small
from mercata.plans import generator, profiler, staging
from mercata.plans.generator import DAY
from mercata.schemas import INPUT_COLUMNS
from mercata.sources import batches


@pytest.fixture(scope="module")
def source(spark):
    return small.source(spark)


@pytest.fixture(scope="module")
def daily(source):
    return generator.daily_batches(source, small.PLAN)


def counts(df, condition="true"):
    return {r[DAY]: r.n for r in df.where(condition).groupBy(DAY).agg(F.count("*").alias("n")).collect()}


def day(n):
    return small.FIRST + dt.timedelta(days=n)


def test_days_are_clean_duplicate_dirty_mixed(daily):
    orders = counts(daily["orders"])
    again = max(1, int(small.PER_DAY * small.PLAN.resend))
    assert orders == {day(0): 12, day(1): 12 + again, day(2): 12, day(3): 12 + again}


def test_faults_have_their_exact_share(daily):
    def share(n, rate):
        return max(1, int(n * rate))

    orders = counts(daily["orders"])
    odd = counts(daily["orders"], "order_purchase_timestamp like '%/%'")
    assert odd == {day(n): share(orders[day(n)], 0.2) for n in (2, 3)}
    loud = counts(daily["orders"], "order_status <> lower(trim(order_status))")
    assert loud == {day(n): share(orders[day(n)], 0.2) for n in (2, 3)}
    items = counts(daily["order_items"])
    bad = counts(daily["order_items"], "price = 'N/A' or price like '-%' or freight_value is null")
    assert bad == {day(n): share(items[day(n)], 0.4) for n in (2, 3)}
    reviews = counts(daily["order_reviews"])
    bad = counts(daily["order_reviews"], "review_score is null or review_score not between '1' and '5'")
    assert bad == {day(n): share(reviews[day(n)], 0.4) for n in (2, 3)}
    payments = counts(daily["order_payments"])
    bad = counts(daily["order_payments"], "payment_type like '% '")
    assert bad == {day(n): share(payments[day(n)], 0.2) for n in (2, 3)}


def test_children_follow_their_orders(daily):
    for name in ("order_items", "order_payments", "order_reviews"):
        lost = daily[name].join(daily["orders"], ["order_id", DAY], "left_anti")
        assert lost.isEmpty()
    resent = daily["orders"].groupBy("order_id").count().where("count > 1").select("order_id")
    items = daily["order_items"].join(resent, "order_id").groupBy("order_id", "order_item_id").count()
    assert {r["count"] for r in items.collect()} == {2}


def test_the_same_day_is_the_same_again(spark, source, daily, tmp_path):
    batch_id = generator.write_day(source, str(tmp_path), day(3), small.PLAN)
    assert batch_id == "batch_20200304"
    for name in ("orders", "order_items", "order_payments", "order_reviews"):
        written = batches.scan_csv(spark, f"{tmp_path}/{batch_id}", name)
        assert all(r.malformed is None for r in written.collect())
        written = written.drop("malformed")
        wanted = daily[name].where(F.col(DAY) == F.lit(day(3))).drop(DAY)
        assert written.exceptAll(wanted).isEmpty() and wanted.exceptAll(written).isEmpty(), name


def test_seed_holds_history_and_static_tables(source):
    seed = generator.seed_batch(source, small.PLAN)
    assert set(seed) == set(INPUT_COLUMNS)
    assert seed["orders"].count() == small.SEED_DAYS * small.PER_DAY
    loud = seed["products"].where("product_category_name like ' %'").collect()
    assert len(loud) <= 1 and all(r.product_category_name == f" {r.product_category_name.strip().upper()}  " for r in loud)
    assert seed["products"].columns == source["products"].columns


def test_unreadable_dates_are_in_no_batch(spark, source):
    bad = source["orders"].limit(1).withColumn("order_purchase_timestamp", F.lit("never"))
    changed = {**source, "orders": source["orders"].unionByName(bad)}
    assert generator.seed_batch(changed, small.PLAN)["orders"].count() == small.SEED_DAYS * small.PER_DAY


def test_csv_with_line_breaks_and_missing_files(spark, tmp_path):
    text = 'a, "b"\nsecond line'
    df = spark.createDataFrame([("r1", "o1", "5", None, text, "2020-01-01 00:00:00", None)],
                               ", ".join(f"{c} string" for c in INPUT_COLUMNS["order_reviews"].split()))
    batches.write_csv(df, str(tmp_path), "order_reviews")
    loaded = batches.load_batch(spark, str(tmp_path), "b1")
    row = loaded["raw_order_reviews"].first()
    assert (row.review_comment_message, row.review_comment_title, row.batch_id) == (text, None, "b1")
    assert loaded["raw_order_items"].isEmpty()
    assert loaded["raw_order_items"].columns[:2] == ["order_id", "order_item_id"]


def test_foreign_csv_dialect(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text(
        'seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01001,"rio, ""centro""\nzona sul",RJ\ns2,,,\n')
    got = {r.seller_id: r for r in batches.scan_csv(spark, str(tmp_path), "sellers").collect()}
    assert got["s1"].seller_city == 'rio, "centro"\nzona sul'
    assert got["s2"].seller_zip_code_prefix is None


def test_listing_and_search_of_files(spark, tmp_path):
    (tmp_path / "x_sellers.csv").write_text("a,b\n1,2.5\n3,4\n")
    (tmp_path / "notes.txt").write_text("-")
    assert [tuple(r) for r in batches.profile_files(spark, str(tmp_path)).collect()] == [("x_sellers.csv", 2, 2)]
    found = batches.find_csv(spark, str(tmp_path), "sellers")
    assert [f.dataType.simpleString() for f in found.schema] == ["int", "double"]
    assert batches.find_csv(spark, str(tmp_path), "orders") is None


def test_column_profile(spark):
    df = spark.createDataFrame([("1", "1.5", "x", None), ("2", None, "y", None)], "a string, b string, c string, d string")
    got = {r.column_name: r for r in profiler.column_profile(df, "t").collect()}
    assert [got[c].data_type for c in "abcd"] == ["int64", "float64", "str", "float64"]
    assert float(got["b"].null_pct) == 50 and got["c"].sample_value == "x" and got["d"].sample_value is None


def test_lines_with_too_many_or_too_few_fields_are_quarantined(spark, tmp_path):
    folder = tmp_path / "batch_20200101"
    folder.mkdir()
    (folder / "order_payments.csv").write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,boleto,1,5.00\no2,1,boleto,1,5.00,EXTRA\no3,1,boleto\n"
    )
    raw = batches.load_batch(spark, str(folder), "b", ["order_payments"])["raw_order_payments"]
    assert raw.count() == 3
    orders = spark.createDataFrame([("o1",), ("o2",), ("o3",)], "order_id string").withColumn(
        "ingested_at", F.lit("2000-01-01").cast("timestamp")
    )
    staged = staging.stage_order_payments(raw, orders)
    assert [r.order_id for r in staged.clean.collect()] == ["o1"]
    rejects = {r.raw_payload: r.reject_reason for r in staged.rejects.collect()}
    assert set(rejects.values()) == {"malformed_line"} and len(rejects) == 2
    assert any("o2,1,boleto,1,5.00,EXTRA" in p for p in rejects)
