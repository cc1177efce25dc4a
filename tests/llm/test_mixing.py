import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cases import documents, empty, odd_texts
from mercata.llm import mixing as m


def brute_size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets of the sources (name: size), excess dealt out again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = {}
    while True:
        rest = [s for s in order if s not in full]
        free = share * sum(sizes.values()) - sum(full.values())
        goal = {s: free * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if goal[s] > most * sizes[s]]
        if not over:
            return full | goal
        full |= {s: most * sizes[s] for s in over}


def best_sum(sizes, counts, budget):
    sums = {0}
    for s, c in zip(sizes, counts, strict=True):
        sums |= {x + k * s for x in sums for k in range(1, c + 1)}
    return min(abs(x - budget) for x in sums)


def check(rows, docs, weights=(3, 1, 2), share=1.5, most=2, slack=0):
    """Rows (id, size, source, source_size, target, copies) against the documents (id, text, source)."""
    want = Counter((i, brute_size(t), s) for i, t, s in docs)
    assert Counter((r[0], r[1], r[2]) for r in rows) == want
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, size, source in want.elements():
        sizes[source] += size
    goal = brute_targets(sizes, weights, share, most)
    for _, size, source, source_size, target, copies in rows:
        assert source_size == sizes[source] and target == pytest.approx(goal[source])
        assert 0 <= copies <= most and (size or not copies or goal[source] >= sizes[source])
        taken[source] += size * copies
    longest = max((r[1] for r in rows), default=0)
    for source, target in goal.items():
        assert abs(taken[source] - target) <= max(slack, longest / 2 + 1)
    return taken, goal


def found(df):
    return [tuple(r) for r in df.select("id", "size", "source", "source_size", "target", "copies").collect()]


def test_word_counts():
    texts = [*odd_texts(), "", None, "a", " a", "a ", "x\x0by\x0cz", "\x85a\xa0b c", "é" * 9]
    column = pa.array(texts, pa.string())
    for part in (column, column.slice(3), column.slice(2, 0), column.slice(1, 2)):
        assert m.word_counts(part).tolist() == [brute_size(t) for t in part.to_pylist()]


def test_word_counts_in_small_parts(monkeypatch):
    monkeypatch.setattr(m, "BYTES", 7)
    texts = odd_texts()
    assert m.word_counts(pa.array(texts, pa.string())).tolist() == [brute_size(t) for t in texts]


@pytest.mark.parametrize("seed", range(40))
def test_fit_is_the_nearest_sum(seed):
    rng = random.Random(seed)
    sizes = sorted(rng.sample(range(1, 60), rng.randrange(1, 7)), reverse=True)
    counts = [rng.randrange(1, 4) for _ in sizes]
    total = sum(s * c for s, c in zip(sizes, counts, strict=True))
    budget = rng.randrange(total + 3)
    takes = m.fitted(sizes, counts, budget)
    assert all(0 <= t <= c for t, c in zip(takes, counts, strict=True))
    got = abs(sum(s * t for s, t in zip(sizes, takes, strict=True)) - budget)
    # The share of each length is fixed beforehand, so the best of all sums need not be reached.
    assert got <= max(sizes) / 2 and got >= best_sum(sizes, counts, budget)
    if seed % 2 == 0:
        ones = [1] * len(sizes)
        if budget < sum(sizes):
            takes = m.fitted(sizes, ones, budget)
            assert abs(sum(s * t for s, t in zip(sizes, takes, strict=True)) - budget) == best_sum(sizes, ones, budget)


def test_fit_of_long_documents(monkeypatch):
    monkeypatch.setattr(m, "WINDOW", 10)
    assert m.fitted([1000], [3], 1400) == [1] and m.fitted([1000], [3], 1600) == [2]
    assert m.fitted([1000, 7], [5, 900], 5000) in ([2, 429], [3, 286], [2, 428])
    assert m.fitted([5], [10**12], 3 * 10**12 + 2) == [6 * 10**11]
    assert m.fitted([], [], 0) == []


@pytest.mark.parametrize("bin_rows", [3, 10_000])
def test_mix(spark, monkeypatch, bin_rows):
    monkeypatch.setattr(m, "BIN_ROWS", bin_rows)
    rng = random.Random(bin_rows)
    names = ["b", "a", None, "ß", "Z", "c"]
    docs = [(i, "w " * rng.choice([0, 1, 3, 5, 8, 8, 8, 40]), rng.choices(names, [9, 1, 3, 1, 1, 3])[0]) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = found(m.mixed(frame, "doc_id", "text", "source"))
    taken, goal = check(rows, docs, slack=0.5)
    # However the rows are laid out, the mix is the same; another seed gives another.
    again = found(m.mixed(frame.repartition(7, "text"), "doc_id", "text", "source"))
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    other = found(m.mixed(frame, "doc_id", "text", "source", seed=1))
    assert sorted(map(repr, other)) != sorted(map(repr, rows))
    check(other, docs, slack=0.5)


def test_other_weights(spark):
    docs = [(i, "x " * (i % 9 + 1), f"s{i % 5}") for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    for weights, share, most in [((1,), 0.3, 1), ((5, 1), 2.5, 4), ((1, 100), 1.0, 3)]:
        rows = found(m.mixed(frame, "doc_id", "text", "source", weights=weights, share=share, most=most))
        check(rows, docs, weights, share, most, slack=0.5)


def test_odd_and_empty_tables(spark):
    odd = documents(spark)
    docs = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    check(found(m.mixed(odd, "doc_id", "text", "source")), docs)
    assert m.mixed(empty(spark), "doc_id", "text", "source").collect() == []
    wordless = documents(spark, [None, "", "  \n"], repeat=False)
    rows = found(m.mixed(wordless, "doc_id", "text", "source"))
    assert [(r[1], r[4], r[5]) for r in rows] == [(0, 0.0, 0)] * 3
    # Rows without an id, all alike: as many are taken as the target asks for.
    docs = [(None, "one two", "a")] * 50 + [(1, "three", "b")] * 20
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    check(found(m.mixed(frame, "doc_id", "text", "source")), docs)


def test_query(spark, sf_dir):
    docs = [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text", "source"]).to_pylist()]
    rows = m.query(spark, sf_dir).collect()
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)
    check([(r["doc_id"], r["size"], r["source"], r["source_size"], r["target"], r["taken"] // r["size"] if r["size"] else 0) for r in rows], docs)
