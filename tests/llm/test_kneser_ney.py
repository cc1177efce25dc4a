import math
from collections import Counter, defaultdict

import pytest

from cases import documents, empty, odd_texts, prose
from mercata.llm import kneser_ney as k


def brute(training, text):
    """Perplexity a byte straight from the definition of interpolated modified Kneser-Ney."""
    order = 4
    counts = {order: Counter()}
    for t in training:
        data = k.PAD + k.normal(t)
        for i in range(3, len(data)):
            counts[order][data[i - 3 : i + 1]] += 1
    for size in range(order - 1, 0, -1):
        counts[size] = Counter(g[1:] for g in counts[size + 1])
    discount, followers = {}, {}
    for size, table in counts.items():
        n = Counter(table.values())
        d = (0.5, 1.0, 1.5)
        if all(n[c] for c in range(1, 5)):
            y = n[1] / (n[1] + 2 * n[2])
            d = tuple(min(max(c - (c + 1) * y * n[c + 1] / n[c], 0.05), c) for c in (1, 2, 3))
        discount[size] = d
        followers[size] = defaultdict(list)
        for g, c in table.items():
            followers[size][g[:-1]].append(c)

    def p(g):
        if not g:
            return 1 / 256
        size = len(g)
        own = followers[size].get(g[:-1])
        if not own:
            return p(g[1:])
        cut = lambda c: discount[size][min(c, 3) - 1]
        c = counts[size].get(g, 0)
        return (max(c - cut(c), 0) if c else 0) / sum(own) + sum(map(cut, own)) / sum(own) * p(g[1:])

    data = k.PAD + k.normal(text)
    bits = [-math.log2(p(data[i - 3 : i + 1])) for i in range(3, len(data))]
    return 2 ** (sum(bits) / len(bits)) if bits else None


def judged(spark, df, trusted, **more):
    ids = spark.createDataFrame([(i,) for i in trusted], "id long")
    return k.judged(df, ids, "doc_id", "text", "lang", **more)


def test_perplexity_equals_the_definition(spark, monkeypatch):
    monkeypatch.setattr(k, "BLOCK", 2000)
    texts = [*odd_texts(), *[prose(s, 60) for s in range(30, 50)]]
    trusted = [3 * i for i in range(len(texts)) if i >= 12]
    rows = judged(spark, documents(spark, texts), trusted).collect()
    held = {r[0] for r in spark.createDataFrame([(i,) for i in trusted], "id long").where(f"pmod(xxhash64(id), {k.HELD_OUT}) = 0").collect()}
    training = [texts[i // 3] for i in trusted if i not in held]
    training += [texts[-1]] if trusted[-1] not in held else []  # the repeated row
    assert len(rows) == len(texts) + 2 and 0 < len(held) < len(trusted)
    for r in rows:
        want = brute(training, "no id at all" if r["id"] is None else texts[r["id"] // 3])
        assert r["perplexity"] == (want if want is None else pytest.approx(want, rel=1e-9))
        assert r["kept"] == (want is not None and want <= r["limit"] + 1e-9)


def test_many_contexts_are_sorted_and_give_the_same(monkeypatch):
    texts = [k.normal(t) for t in [*odd_texts(), prose(1, 300)]] + [bytes(range(33, 256)) * 3]
    strings = k.Strings(k.zstandard.compress(k.PAD + k.PAD.join(texts)))
    dense, rows = strings.cells(), k.np.arange(len(texts)) % 2 == 0
    counts = k._counted(strings, rows)
    monkeypatch.setattr(k, "DENSE", 0)
    for a, b in zip((*dense, *counts), (*strings.cells(), *k._counted(strings, rows)), strict=True):
        assert (a == b).all()
    assert (k.np.diff(dense[1]) > 0).all()


def test_the_limit_is_the_exact_quantile(spark):
    df = documents(spark, [prose(s, 40 + s) for s in range(60)], repeat=False)
    trusted = [3 * i for i in range(60)]
    rows = judged(spark, df, trusted, quantile=0.7, slack=1.0).collect()
    held = {r[0] for r in spark.createDataFrame([(i,) for i in trusted], "id long").where(f"pmod(xxhash64(id), {k.HELD_OUT}) = 0").collect()}
    for lang in {r["lang"] for r in rows}:
        own = [r["perplexity"] for r in rows if r["id"] in held and r["lang"] == lang]
        want = k.np.quantile(own or [r["perplexity"] for r in rows if r["id"] in held], 0.7)
        assert [r["limit"] for r in rows if r["lang"] == lang] == pytest.approx([want] * sum(r["lang"] == lang for r in rows), rel=1e-12)


def test_noise_goes_and_prose_stays(spark):
    clean = [prose(s, 150) for s in range(60)]
    noise = [" | ".join(f"%%{w}&&" for w in prose(s, 60, 50).split()) for s in range(5)]
    df = documents(spark, clean + noise, repeat=False)
    kept = {r["id"]: r["kept"] for r in judged(spark, df, [3 * i for i in range(40)]).collect()}
    assert not any(kept[3 * i] for i in range(60, 65)) and sum(kept[3 * i] for i in range(60)) >= 55


def test_nothing_trusted_and_no_rows(spark):
    rows = judged(spark, documents(spark), []).collect()
    assert all(r["kept"] == bool(k.normal("no id at all" if r["id"] is None else odd_texts()[r["id"] // 3])) for r in rows)
    assert all(r["perplexity"] in (None, pytest.approx(256)) for r in rows)
    assert judged(spark, empty(spark), [3]).count() == 0


def test_discounts(spark):
    counts = [1] * 10 + [2] * 4 + [3] * 2 + [4] + [9] * 3
    d = k.discounts(spark.createDataFrame([(c,) for c in counts], "n long"))
    y = 10 / 18
    assert d == pytest.approx((1 - 2 * y * 0.4, 2 - 3 * y * 0.5, 3 - 4 * y * 0.5))
    assert k.discounts(spark.createDataFrame([(1,)], "n long")) == (0.5, 1.0, 1.5)
