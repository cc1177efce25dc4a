import numpy as np
import pytest
from pyspark.sql import functions as F

from mercata.llm import hnsw
from mercata.llm import neighbours as n

SCHEMA = "vec_id long, embedding array<float>, vector string, dim string, ids string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    out = {}
    for i, v in queries:
        scored = sorted((-float(np.dot(np.float64(v), np.float64(w))), j) for j, w in rows if j != i and len(w) == len(v))
        out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def found(spark, rows, every, k):
    use = n.usable(table(spark, rows), "vec_id", "embedding")
    got = n.search(n.indexed(use, k), use.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "vector"]), k).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_and_order(spark, monkeypatch):
    monkeypatch.setattr(n, "SHARD", 700)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    vectors = (centres[rng.integers(30, size=2000)] + 0.4 * rng.normal(size=(2000, 16))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    want, got = brute(rows, rows[::20], 20), found(spark, rows, 20, 20)
    hits = [len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.95
    for q, own in got.items():
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        for i, score in own:
            assert score == pytest.approx(float(np.dot(np.float64(vectors[q]), np.float64(vectors[i]))), abs=1e-12)


def test_copies_ties_and_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(i, [0.0, 1.0]) for i in range(300, 305)]
    rows += [(400, [3.0, 0.0]), (401, [1.0, 1.0, 1.0]), (420, [2.0, 0.0, 0.0]), (0, [1.0, 0.0])]
    bad = [(500, None), (501, [0.0, 0.0]), (502, [nan, 1.0]), (503, [inf, 1.0]), (504, [None, 1.0]), (505, []), (None, [1.0, 0.0])]
    got = found(spark, rows + bad, 20, 20)
    assert got[0] == [(400, 3.0)] + [(i, 1.0) for i in range(1, 20)]
    assert got[400][:3] == [(0, 3.0), (1, 3.0), (2, 3.0)]
    assert got[300] == [(i, 1.0) for i in range(301, 305)] + [(i, 0.0) for i in range(16)]  # equal scores: smaller ids
    assert got[420] == [(401, 2.0)]  # candidates of its own dimension only
    assert set(got) == {q for q, _ in rows if q % 20 == 0}


def test_no_rows(spark):
    assert found(spark, [], 20, 5) == {}
    assert found(spark, [(20, [1.0])], 20, 5) == {}


def test_graph_is_kept_within_its_links():
    vectors = np.random.default_rng(1).normal(size=(1500, 8)).astype(np.float32)
    graph = hnsw.build(vectors)
    assert len(graph.levels[0][0]) == 1500 and graph.levels[0][1].shape == (1500, 2 * hnsw.LINKS)
    own = np.arange(1500)[:, None]
    assert not (graph.levels[0][1] == own).any()
    near = graph.search(vectors[:100])
    assert all(len(set(r[r >= 0].tolist())) == (r >= 0).sum() for r in near)
