import hashlib
import math
import random

import numpy as np
import pytest

from mercata.llm import vector_codes as v


def brute(rows, parts=16, entries=64, rounds=2):
    """(id, label, code, error) of rows (id, label, vector), and the codebooks, in plain Python integers."""
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    if not kept:
        return [], []
    longest = max(len(r[2]) for r in kept)
    d = -(-max(longest, 1) // parts)

    def cut(vector):
        whole = [max(-v.LIMIT, min(v.LIMIT, math.floor(256 * x))) for x in vector] + [0] * (d * parts - len(vector))
        return [whole[p * d : (p + 1) * d] for p in range(parts)]

    values = [cut(r[2]) for r in kept]
    start = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0], kept[i][2]))[:entries]
    books = [[values[i][p] for i in start] for p in range(parts)]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assigned():
        return [[min((far(row[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for row in values]

    for _ in range(rounds):
        codes = assigned()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [row[p] for row, code in zip(values, codes, strict=True) if code[p][1] == k]
                if own:
                    books[p][k] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    out = [
        (r[0], r[1], tuple(k for _, k in code), sum(e for e, _ in code)) for r, code in zip(kept, assigned(), strict=True)
    ]
    return out, books


def table(spark, rows):
    schema = "vec_id long, label int, embedding array<double>, code string, error string, id string"
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], schema)


def compare(spark, rows, **options):
    want, books = brute(rows, **options)
    found, got_books = v.coded(table(spark, rows), "vec_id", "embedding", "label", **options)
    got = [(r["id"], r["label"], tuple(np.frombuffer(r["code"], "<u2").tolist()), r["error"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert got_books.tolist() == books
    return found


def clustered(seed, n, dim, spread=0.02):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(12)]
    return [(i, rng.randrange(3), [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"parts": 4, "entries": 20, "rounds": 5}, {"parts": 2, "entries": 3, "rounds": 3}])
def test_equals_brute_force(spark, options):
    found = compare(spark, clustered(1, 200, 16), **options)
    assert found.count() == 200


def test_bounds_spare_comparisons(spark):
    found, _ = v.coded(table(spark, clustered(2, 400, 8, 0.01)), "vec_id", "embedding", "label", parts=2, entries=32, rounds=4)
    compared = found.agg({"whole": "sum"}).first()[0]
    assert compared < 0.5 * 2 * 400


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (5, 1, [0.25, -0.5, 1.0]), (5, 1, [0.25, -0.5, 1.0]), (None, None, [9.0, 9.0]), (7, None, []), (8, 2, None),
        (9, 2, [1.0, None]), (1, 2, [nan, 1.0]), (2, 2, [1.0, inf]), (3, None, [1e300, -1e300]), (4, 1, [0.0] * 5),
        (6, 3, [-0.001, 0.0039, -1.0, 2.0, 3.0]),
    ]
    compare(spark, rows)
    compare(spark, rows, parts=3, entries=2, rounds=1)


def test_ties_go_to_the_lower_index(spark):
    compare(spark, [(i, 0, [float(i // 2 % 3), 0.0]) for i in range(40)], parts=2, entries=8)


def test_no_rows(spark):
    for rows in ([], [(1, 1, None)]):
        found, books = v.coded(table(spark, rows), "vec_id", "embedding", "label")
        assert found.collect() == [] and books.shape[1] == 0


def test_downward():
    x = np.array([0.0, 0.1, 1 / 3, 1000.3, 1e9, -5.0, 2049.0])
    assert (v.downward(x) <= np.maximum(x, 0)).all() and (v.downward(x)[:4] >= x[:4] * 0.999).all()


def test_query(spark, tmp_path):
    rows = clustered(3, 150, 32)
    table(spark, [(i, None if label == 2 else label, x) for i, label, x in rows]).select("vec_id", "label", "embedding").write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    want, books = brute(rows)
    by_label = {k: sum(e for *_, label, _, e in want if label == k) for k in range(3)}
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    got = {tuple(r) for r in v.query(spark, str(tmp_path)).collect()}
    assert got == {(i, "".join(f"{k:02x}" for k in code), e, by_label[label], digest) for i, label, code, e in want}
