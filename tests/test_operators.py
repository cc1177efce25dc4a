"""Operators against plain windows and brute force, with ties, nulls and hot keys."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercata.functions import labels, measures
from mercata.operators.keyed import (
    duplicate_keys,
    insert_if_absent,
    keep_first,
    upsert_columns,
)
from mercata.operators.ordering import exact_percentile, with_global_order, with_value_order
from mercata.operators.sampling import with_sample_flags


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def sellers(spark):
    """A third of all sellers share one value; others tie in small groups."""
    draw = random.Random(7)
    values = [0] * 400 + [draw.randrange(1, 90) for _ in range(800)]
    return spark.createDataFrame(
        [(f"s{i}", Decimal(v).scaleb(-2) * 50) for i, v in enumerate(values)], "id string, v decimal(12,2)"
    ).repartition(8)


@pytest.fixture
def many_partitions(spark):
    """Small data stays in all its partitions, so that ties cross their borders."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def check_global_order(sellers, got=None):
    got = with_global_order(sellers, "v", ["id"]) if got is None else got
    by_value = Window.orderBy(F.col("v").desc())
    full = Window.orderBy(F.col("v").desc(), "id")
    total = sellers.agg(F.sum("v")).first()[0]
    want = sellers.select(
        "id", "v",
        F.row_number().over(full).cast("bigint").alias("row_number"),
        F.rank().over(by_value).cast("bigint").alias("rank"),
        F.sum("v").over(full.rowsBetween(Window.unboundedPreceding, 0)).alias("running_sum"),
        F.lit(1200).cast("bigint").alias("row_count"),
        F.lit(total).alias("total_sum"),
    )
    assert rows(got) == rows(want)
    return got


def test_global_order_in_one_partition(sellers):
    check_global_order(sellers)


def test_global_order_with_ties_across_partitions(sellers, many_partitions):
    got = check_global_order(sellers)
    assert got.rdd.getNumPartitions() > 1
    # The value a third of the rows share lies in several partitions.
    assert got.where("v = 0").select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_global_order_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([("a", Decimal(3))], "id string, v decimal(12,2)")
    r = with_global_order(one, "v", ["id"]).first()
    assert (r.row_number, r["rank"], r.running_sum) == (1, 1, 3)
    assert with_global_order(one.where("false"), "v", ["id"]).count() == 0


def test_value_order_equals_the_global_order(spark, sellers):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("order", "building an order")
    got = with_value_order(sellers, "v", "id")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tracker.getJobIdsForGroup("order") == []
    assert got.columns == with_global_order(sellers, "v", ["id"]).columns
    check_global_order(sellers, got)
    assert with_value_order(sellers.where("false"), "v", "id").count() == 0


def test_value_order_of_negative_and_far_apart_values(spark):
    values = ["-7.00", "-7.00", "-0.01", "0.00", "0.01", "5.00", "5.00", "99999999.99"]
    df = spark.createDataFrame([(f"é{i}", Decimal(v)) for i, v in enumerate(values)], "id string, v decimal(12,2)")
    got = {r["id"]: r for r in with_value_order(df, "v", "id").collect()}
    order = sorted(range(8), key=lambda i: (-Decimal(values[i]), i))
    assert [got[f"é{i}"]["row_number"] for i in order] == [*range(1, 9)]
    assert [got[f"é{i}"]["rank"] for i in order] == [1, 2, 2, 4, 5, 6, 7, 7]
    run = Decimal(0)
    for i in order:
        run += Decimal(values[i])
        assert got[f"é{i}"]["running_sum"] == run


@pytest.mark.parametrize("p", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("n", [1, 2, 3, 10, 11, 1200])
def test_exact_percentile(sellers, p, n):
    some = sellers.orderBy("id").limit(n)
    want = some.agg(F.percentile("v", F.lit(p))).first()[0]
    assert exact_percentile(some, "v", p).first()[0] == pytest.approx(want, abs=1e-9)


def test_exact_percentile_with_a_coarse_bracket(sellers):
    """A bracket that leaves most rows outside still gives the exact value."""
    for p in (0.3, 0.5, 0.77):
        want = sellers.agg(F.percentile("v", F.lit(p))).first()[0]
        assert exact_percentile(sellers, "v", p, accuracy=20).first()[0] == pytest.approx(want, abs=1e-9)
    nothing = sellers.where("false")
    assert exact_percentile(nothing, "v").first()[0] is None


def test_keep_first_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    kept = keep_first(df, ["k"], [F.col("id").desc()])
    assert rows(kept) == [(0, 999), (1, 997), (2, 998)]
    text = plan(kept)
    assert "Partial" in text.split("Exchange")[1]


def test_insert_if_absent(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    old = spark.createDataFrame([(2, "x"), (9, "y")], "k int, v string")
    assert rows(insert_if_absent(new, old, ["k"])) == [(1, "a"), (3, "c")]


def test_upsert_takes_only_the_named_columns(spark):
    ddl = "k int, a string, b string"
    current = spark.createDataFrame([(1, "a1", "b1"), (2, "a2", "b2")], ddl)
    incoming = spark.createDataFrame([(2, "A", None), (3, "A3", "B3")], ddl)
    merged = upsert_columns(current, incoming, ["k"], ["b"])
    assert merged.columns == ["k", "a", "b"]
    assert {tuple(r) for r in merged.collect()} == {(1, "a1", "b1"), (2, "a2", None), (3, "A3", "B3")}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(duplicate_keys(df, ["k"])) == [(1, 2)]


def test_sample_sizes_and_repeatability(spark):
    sizes = {"a": 1, "b": 10, "c": 237, "d": 2000}
    df = spark.createDataFrame([(g, f"{g}{i}") for g, n in sizes.items() for i in range(n)], "g string, k string")
    rates = {"x": 0.15, "y": 0.5}
    got = with_sample_flags(df, "g", ["k"], rates)
    counts = {r.g: r for r in got.groupBy("g").agg(
        F.count("*").alias("n"), F.count_if("is_x").alias("x"), F.count_if("is_y").alias("y"),
        F.count_if(F.col("is_x") & F.col("is_y")).alias("both")).collect()}
    for g, n in sizes.items():
        assert counts[g].n == n
        assert counts[g].x == max(1, int(n * 0.15)) and counts[g].y == max(1, int(n * 0.5))
    assert 0 < counts["d"].both < counts["d"].x  # two draws are independent
    again = with_sample_flags(df.repartition(7).where("g <> 'd'"), "g", ["k"], {"x": 0.15})
    assert rows(again.where("is_x").select("k")) == rows(got.where("is_x and g <> 'd'").select("k"))


def test_sample_of_copies(spark):
    """Copies share a hash: they are drawn together and never dropped."""
    df = spark.createDataFrame([("g", "same")] * 50 + [("g", f"k{i}") for i in range(50)], "g string, k string")
    got = with_sample_flags(df, "g", ["k"], {"x": 0.1})
    drawn = got.where("is_x")
    assert got.count() == 100 and drawn.count() >= 10
    assert drawn.where("k = 'same'").count() in (0, 50)


def test_shares_round_once(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00"))], "n decimal(33,2), d decimal(33,2)")
    r = df.select(
        measures.pct("n", "d", 4).alias("p"),
        measures.pct("n", F.lit(0), 2).alias("zero"),
        measures.rounded_ratio("n", "d").alias("r"),
    ).first()
    assert (r.p, r.zero, r.r) == (Decimal("33.3333"), None, Decimal("0.33"))


def test_cents_are_exact(spark):
    df = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.20"),)], "v decimal(12,2)")
    assert df.agg(measures.from_cents(F.sum(measures.cents("v")))).first()[0] == Decimal("0.30")


@pytest.mark.parametrize("days,bucket,delay", [
    (-8, "1. 0-7d", "1. Early >7d"), (-7, "1. 0-7d", "2. Early 1-7d"), (-1, "1. 0-7d", "2. Early 1-7d"),
    (0, "1. 0-7d", "3. On time"), (1, "1. 0-7d", "4. Late 1-7d"), (7, "1. 0-7d", "4. Late 1-7d"),
    (8, "2. 8-14d", "5. Late 8-15d"), (15, "3. 15-21d", "5. Late 8-15d"), (16, "3. 15-21d", "6. Late >15d"),
    (30, "4. 22-30d", "6. Late >15d"), (31, "5. 30d+", "6. Late >15d"),
])
def test_buckets(spark, days, bucket, delay):
    r = spark.range(1).select(F.lit(days).alias("d")).select(
        labels.delivery_bucket("d").alias("b"), labels.delay_bucket("d").alias("l"),
        labels.delivery_bucket_order("d").alias("bo"), labels.delay_bucket_order("d").alias("lo")).first()
    assert (r.b, r.l) == (bucket, delay)
    assert bucket.startswith(str(r.bo)) and delay.startswith(str(r.lo))


def test_row_labels(spark):
    df = spark.createDataFrame(
        [(Decimal("49.99"), Decimal("0"), "SP", "SP"), (Decimal("50"), Decimal("150"), None, "SP"),
         (Decimal("150"), Decimal("0"), None, None), (Decimal("0"), Decimal("0"), "SP", None)],
        "price decimal(12,2), freight_value decimal(12,2), customer_state string, seller_state string")
    got = df.select(labels.price_segment(), labels.is_cross_state(), labels.freight_ratio()).collect()
    assert [tuple(r) for r in got] == [
        ("Budget", False, Decimal("0")), ("Mid-range", True, Decimal("0.75")),
        ("Premium", False, Decimal("0")), ("Budget", True, None)]


def test_seller_segments(spark):
    cases = [(11, 4, "0.90", "Star"), (11, 4, "0.89", "Risky"), (11, None, "1", "Risky"), (10, 4, None, "Emerging"),
             (10, None, None, "Underperform"), (10, 3, "1", "Underperform")]
    df = spark.createDataFrame([(r, s, Decimal(o) if o else None, w) for r, s, o, w in cases],
                               "r int, s int, o decimal(20,14), w string")
    got = df.select(labels.seller_segment(F.col("r"), F.lit(10), F.col("s"), F.col("o")).alias("g"), "w").collect()
    assert [r.g for r in got] == [r.w for r in got]
