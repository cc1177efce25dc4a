"""Large CSV files read by many tasks: the same rows as the reader that takes a file whole."""

import csv
import random

import pytest

from mercata import schemas
from mercata.plans import generator
from mercata.sources import batches, records

SMALL = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "0"}


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def review(rng, n):
    words = ["ok", "a,b", 'said "well"', "two\nlines", "", "x" * rng.randrange(40), "\n\n", '"', "é", "line\n\nline,\n\"q\"\n"]
    if n % 97 == 0:
        words = ["long\n" * 1200]  # over several ranges
    return [f"r{n}", f"o{n}", str(n % 5 + 1), rng.choice(words), " ".join(rng.choice(words) for _ in range(3)), None, None]


def written(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(schemas.INPUT_COLUMNS["order_reviews"].split())
        out.writerows(rows)


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).limit(3).collect() == [] and b.exceptAll(a).limit(3).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_whole_file_reader(spark, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    rows = [review(rng, n) for n in range(400)]
    written(tmp_path / "order_reviews.csv", rows)
    many = batches.scan_csv(spark, str(tmp_path), "order_reviews", split=True)
    whole = batches.scan_csv(spark, str(tmp_path), "order_reviews")
    assert many.rdd.getNumPartitions() > 20 and whole.rdd.getNumPartitions() == 1
    assert many.count() == 400
    same(many, whole)


def test_windows_line_ends_headers_of_parts_and_malformed_lines(spark, tmp_path, small_ranges):
    folder = tmp_path / "order_reviews.csv"
    folder.mkdir()
    rng = random.Random(9)
    plain = [["r", "o", "1", "t", f"message {n}, \"quoted\"", "d", "e"] for n in range(100)]
    written(folder / "part-0.csv", plain, "\r\n")
    written(folder / "part-1.csv", [review(rng, n) for n in range(1, 90)])
    (folder / "part-2.csv").write_text((folder / "part-1.csv").read_text() + "too,few\n\na,b,c,d,e,f,g,too many\n", encoding="utf-8")
    (folder / "part-3.csv").write_text("")
    many = batches.scan_csv(spark, str(tmp_path), "order_reviews", split=True)
    same(many, batches.scan_csv(spark, str(tmp_path), "order_reviews"))
    assert many.where(f"{schemas.MALFORMED} is not null").count() == 2


def test_a_batch_is_loaded_either_way(spark, tmp_path, small_ranges):
    rng = random.Random(4)
    written(tmp_path / "order_reviews.csv", [review(rng, n) for n in range(1, 200)])
    one, many = (
        batches.load_batch(spark, str(tmp_path), generator.SEED, ["order_reviews", "orders"], split=s) for s in (False, True)
    )
    same(many["raw_order_reviews"].drop("ingested_at"), one["raw_order_reviews"].drop("ingested_at"))
    assert many["raw_orders"].isEmpty()


def test_quotes_that_never_close(spark, tmp_path, small_ranges, monkeypatch):
    monkeypatch.setattr(records, "MOST_OVER", 3000)
    (tmp_path / "orders.csv").write_text("a\n" + 'x,"open\n' + "line\n" * 4000)
    with pytest.raises(ValueError, match="do not balance"):
        records.split_records(spark, str(tmp_path / "orders.csv"))


def test_an_open_end_is_a_record(spark, tmp_path):
    (tmp_path / "x.csv").write_text('h\n1\n"2\n3')
    assert [r[0] for r in records.split_records(spark, str(tmp_path / "x.csv")).collect()] == ["1", '"2\n3']
    assert records.split_records(spark, str(tmp_path / "x.csv"), header=False).count() == 3
