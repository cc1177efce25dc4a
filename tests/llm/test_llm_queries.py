"""The registered queries: SQL where it can express them, and one for each operator."""

import re

import pytest

import __spark_entry__ as entry
from compare import differences, open_oracle
from mercata.llm.queries import ORACLE_SQL, QUERIES


def test_one_query_for_each_operator():
    assert [re.match(r"op(\d+)_", q)[1] for q in QUERIES] == [str(i) for i in range(1, 1 + len(QUERIES))]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_sql(spark, sf_dir, name):
    assert differences(open_oracle(sf_dir), ORACLE_SQL[name], QUERIES[name](spark, sf_dir)) == []


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in ORACLE_SQL])
def test_every_row_has_a_result(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    if name == "op12_spelling":
        pytest.skip("a row per word: see test_spelling")
    key = {"op5_neighbours": "query_id"}.get(name, "doc_id")
    table = "embeddings" if key == "query_id" else "documents"
    all_rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    expected = all_rows.where("vec_id % 20 = 0").count() if table == "embeddings" else all_rows.count()
    assert rows.select(key).distinct().count() == expected
