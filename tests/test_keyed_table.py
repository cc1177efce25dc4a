"""Tables in buckets of a key: what a batch reads and rewrites, and what a broken or repeated run leaves."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mercata.sources import batches, keyed_table
from mercata.sources.keyed_table import KeyedTable

DDL = "k string not null, v int, batch_id string"


def table(spark, tmp_path, buckets=64):
    return KeyedTable(spark, str(tmp_path / "t"), DDL, "k", buckets)


def rows(spark, *found):
    return spark.createDataFrame(list(found), DDL.replace(" not null", ""))


def content(df):
    return sorted(tuple(r) for r in df.select("k", "v", "batch_id").collect())


def files(folder):
    return {str(p): p.read_bytes() for p in Path(folder).rglob("*.parquet")}


def seeded(spark, tmp_path):
    t = table(spark, tmp_path)
    t.rebuild(spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v"), F.lit("seed").alias("batch_id")))
    return t


def test_a_lookup_reads_the_buckets_of_its_keys_alone(spark, tmp_path):
    t = seeded(spark, tmp_path)
    assert len(t.read().inputFiles()) == 64 and t.read().count() == 2000
    found = t.lookup(rows(spark, ("k7", 0, ""), ("k8", 0, ""), ("absent", 0, "")).select("k"))
    assert content(found) == [("k7", 7, "seed"), ("k8", 8, "seed")]
    assert len(found.inputFiles()) <= 3
    # Twenty times the history does not change what is read.
    size = sum(Path(f.removeprefix("file://")).stat().st_size for f in found.inputFiles())
    more = table(spark, tmp_path / "more", buckets=64 * 20)
    more.rebuild(spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v"), F.lit("seed").alias("batch_id")))
    again = more.lookup(rows(spark, ("k7", 0, ""), ("k8", 0, ""), ("absent", 0, "")).select("k"))
    assert sum(Path(f.removeprefix("file://")).stat().st_size for f in again.inputFiles()) < 2 * size


def test_a_fold_rewrites_the_buckets_of_its_keys_alone(spark, tmp_path):
    t = seeded(spark, tmp_path)
    before, old = files(t.root), t.read()
    t.fold(rows(spark, ("k7", -7, "b1"), ("new", 1, "b1")), "b1")
    now = files(t.root)
    assert now.items() >= before.items() and 1 <= len(now) - len(before) <= 2
    assert set(before) & {f.removeprefix("file://") for f in t.read().inputFiles()} == set(before) - {
        f for f in before if any(f"/bucket={b}/" in f for b in {Path(x).parent.name.split("=")[1] for x in set(now) - set(before)})
    }
    assert t.read().count() == 2001 and content(t.lookup(rows(spark, ("k7", 0, "")).select("k"))) == [("k7", -7, "b1")]
    assert old.count() == 2000  # a reader of the state before is not disturbed


def test_a_batch_that_runs_again_takes_the_place_of_its_rows(spark, tmp_path):
    t = seeded(spark, tmp_path)
    t.fold(rows(spark, ("a", 1, "b1"), ("a", 2, "b1"), ("k1", 3, "b1")), "b1", replace=False)
    assert content(t.rows_of_batch("b1")) == [("a", 1, "b1"), ("a", 2, "b1"), ("k1", 3, "b1")]
    t.fold(rows(spark, ("c", 5, "b1")), "b1", replace=False)
    assert content(t.rows_of_batch("b1")) == [("c", 5, "b1")] and t.read().count() == 2001
    t.fold(rows(spark), "b1", replace=False)
    assert t.read().count() == 2000
    t.fold(rows(spark, ("x", 1, "b2")), "b2", rows(spark, ("k1", 0, ""), ("k2", 0, "")).select("k"))
    assert t.read().count() == 1999 and t.lookup(rows(spark, ("k2", 0, "")).select("k")).isEmpty()


def test_a_fold_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    t = seeded(spark, tmp_path)
    before = content(t.read())

    def broken(*args):
        raise OSError("lost")

    monkeypatch.setattr(KeyedTable, "_commit", broken)
    with pytest.raises(OSError, match="lost"):
        t.fold(rows(spark, ("k7", -7, "b1")), "b1")
    monkeypatch.undo()
    assert content(t.read()) == before
    t.fold(rows(spark, ("k8", -8, "b1")), "b1")
    assert content(t.rows_of_batch("b1")) == [("k8", -8, "b1")] and t.read().count() == 2000


def test_old_buckets_go(spark, tmp_path):
    t = seeded(spark, tmp_path)
    for n in range(5):
        t.fold(rows(spark, ("k7", n, f"b{n}")), f"b{n}")
    assert len(t.generations()) == 2 and len(files(t.root)) == 65
    assert content(t.lookup(rows(spark, ("k7", 0, "")).select("k"))) == [("k7", 4, "b4")]


def test_no_rows_hot_keys_and_nulls(spark, tmp_path):
    t = table(spark, tmp_path, 4)
    assert not t.exists() and t.read().isEmpty() and t.lookup(rows(spark, ("a", 1, "")).select("k")).isEmpty()
    t.fold(rows(spark), "b0")
    assert t.read().isEmpty()
    hot = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").alias("k"), F.col("id").cast("int").alias("v"), F.lit("b1").alias("batch_id"))
    t.fold(hot, "b1", replace=False)
    assert t.read().count() == 5000 and t.lookup(rows(spark, ("hot", 0, "")).select("k")).count() == 3333


def test_small_files_appear_whole(spark, tmp_path):
    path = str(tmp_path / "x" / "a.json")
    for text in ("one", "zwei é"):
        batches.write_text(spark, path, text)
        assert batches.read_text(spark, path) == text
    assert batches.list_files(spark, str(tmp_path / "x")) == ["a.json"] or all(n.startswith(".") or n == "a.json" for n in batches.list_files(spark, str(tmp_path / "x")))


def test_rows_that_replace_none_are_added_without_a_rewrite(spark, tmp_path):
    t = seeded(spark, tmp_path)
    before = files(t.root)
    t.fold(rows(spark, ("k7", -7, "b1"), ("new", 1, "b1")), "b1", replace=False)
    now = files(t.root)
    added = sum(spark.read.parquet(f).count() for f in set(now) - set(before))
    assert now.items() >= before.items() and added == 2  # the rows of the batch, no row of its buckets
    assert content(t.lookup(rows(spark, ("k7", 0, "")).select("k"))) == [("k7", -7, "b1"), ("k7", 7, "seed")]
    t.fold(rows(spark, ("k7", 70, "b1")), "b1", replace=False)
    assert content(t.rows_of_batch("b1")) == [("k7", 70, "b1")] and t.read().count() == 2001


def test_a_batch_of_unknown_buckets_is_not_added_twice(spark, tmp_path):
    t = table(spark, tmp_path, 2)
    t.rebuild(rows(spark, ("a", 1, "b1"), ("b", 2, "seed")))  # no note tells where b1 is
    t.fold(rows(spark, ("a", 1, "b1")), "b1", replace=False)
    assert content(t.read()) == [("a", 1, "b1"), ("b", 2, "seed")]


def test_added_generations_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_table, "MERGED_PARTS", 3)
    t = table(spark, tmp_path, 1)
    for n in range(8):
        t.fold(rows(spark, ("k", n, f"b{n}")), f"b{n}", replace=False)
        assert content(t.read()) == [("k", i, f"b{i}") for i in range(n + 1)]
        assert len(t.read().inputFiles()) <= 3


def test_large_buckets_are_rewritten_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_table, "LARGE_BUCKET", 0)
    t = seeded(spark, tmp_path)
    gone = rows(spark, ("k1", 0, ""), ("k2", 0, "")).select("k")
    t.fold(rows(spark, ("k7", -7, "b1"), ("new", 1, "b1")), "b1", gone)
    assert t.read().count() == 1999 and t.lookup(gone).isEmpty()
    assert content(t.lookup(rows(spark, ("k7", 0, "")).select("k"))) == [("k7", -7, "b1")]


def test_few_keys_leave_the_table_in_place(spark, tmp_path, monkeypatch):
    t = seeded(spark, tmp_path)
    keys = t.read().select("k").where("v < 9")  # by its files as large as the table
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
    try:
        found = t.lookup(keys)
        assert found.count() == 9 and "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(keyed_table, "FEW_KEYS", 8)
        assert t.lookup(keys).count() == 9 and "SortMergeJoin" in t.lookup(keys)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_buckets_are_added_to_when_rows_are_replaced(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_table, "LARGE_BUCKET", 0)
    t = seeded(spark, tmp_path)
    before, old = files(t.root), t.read()
    gone = rows(spark, ("k1", 0, ""), ("k2", 0, ""), ("k2", 0, "")).select("k")
    t.fold(rows(spark, ("k7", -7, "b1"), ("new", 1, "b1")), "b1", gone)
    now = files(f"{t.root}")
    fresh = [f for f in set(now) - set(before) if "/gone/" not in f]
    assert now.items() >= before.items() and sum(spark.read.parquet(f).count() for f in fresh) == 2
    want = {(f"k{n}", n, "seed") for n in range(2000) if n not in (1, 2, 7)} | {("k7", -7, "b1"), ("new", 1, "b1")}
    assert content(t.read()) == sorted(want) and old.count() == 2000
    # A key that went comes back, and one that came goes; the batch that is run again takes the place of its rows.
    t.fold(rows(spark, ("k1", 11, "b2"), ("new", 12, "b2")), "b2", rows(spark, ("k7", 0, "")).select("k"))
    want = {r for r in want if r[0] not in ("k7", "new")} | {("k1", 11, "b2"), ("new", 12, "b2")}
    assert content(t.read()) == sorted(want) and content(t.rows_of_batch("b2")) == [("k1", 11, "b2"), ("new", 12, "b2")]
    t.fold(rows(spark, ("k1", 21, "b2")), "b2")
    want = {r for r in want if r[2] != "b2"} | {("k1", 21, "b2")}
    assert content(t.read()) == sorted(want) and content(t.lookup(gone)) == [("k1", 21, "b2")]
    t.rebuild(t.read().where("v < 9").persist())
    assert content(t.read()) == sorted(r for r in want if r[1] < 9)


def test_keys_that_went_are_merged_away(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_table, "LARGE_BUCKET", 0)
    monkeypatch.setattr(keyed_table, "MERGED_PARTS", 3)
    t = table(spark, tmp_path, 1)
    for n in range(9):
        t.fold(rows(spark, ("k", n, f"b{n}"), (None, n, f"b{n}")), f"b{n}")
        # A null is no key: its rows stay, as they do when buckets are rewritten.
        assert content(t.read().where("k is not null")) == [("k", n, f"b{n}")] and t.read().count() == n + 2
        assert len(t._manifest()["of"][0]) <= 3
    assert len(list((tmp_path / "t" / "gone").glob("g=*"))) <= 4
    monkeypatch.setattr(keyed_table, "FEW_KEYS", 0)  # too many to be sent to all tasks: rewritten
    t.fold(rows(spark, ("k", 100, "b100")), "b100")
    assert content(t.read().where("k is not null")) == [("k", 100, "b100")] and not t._manifest()["gone"]
