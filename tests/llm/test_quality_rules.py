import re
from collections import Counter
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from cases import documents, empty, odd_texts
from mercata.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeat = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeat), failed


def brute_rules(text):
    """The names of the rules that a text breaks."""
    n_words, chars, symbols, dup_lines, _, base = brute(text)
    n_lines = sum(1 for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line))
    broken = {
        "base": base,
        "symbols": 10 * symbols > n_words,
        "lines": 2 * dup_lines > n_lines,
        "word_length": not 2 * n_words <= chars <= 12 * n_words,
    }
    return [k for k, v in broken.items() if v]


def brute_hosts(rules, hosts):
    """The hosts that are rejected, from the rules that each document breaks; exact fractions but for the root."""
    found = set()
    named = [(r, h) for r, h in zip(rules, hosts, strict=True) if h is not None]
    for kind in ("any", *q.RULES):
        n, f = Counter(), Counter()
        for broken, host in named:
            n[host] += 1
            f[host] += bool(broken) if kind == "any" else kind in broken
        docs = sum(n.values())
        mean = Fraction(sum(f.values()), docs)
        unit = mean * (1 - mean)
        room = docs - len(n) + 1 - Fraction(sum(v * v for v in n.values()), docs)
        weight = Fraction(10**6)
        if unit and room:
            spread = sum(n[h] * (Fraction(f[h], n[h]) - mean) ** 2 for h in n)
            shared = (spread / unit - (len(n) - 1)) / room
            if shared > 0:
                weight = min(max(1 / shared - 1, Fraction(0)), weight)
        limit = min(max(float(mean) + 2 * float(unit / (weight + 1)) ** 0.5, 0.3), 0.5)
        found |= {h for h in n if float((f[h] + mean * weight) / (n[h] + weight)) > limit}
    return found


def test_measures(spark):
    texts = [*odd_texts(), "x y z\n" * 30 + "x y z", "a b c d a b c e " * 2, "# * $ | <b> 100%\n\n \n# * $ | <b> 100%"]
    rows = q.judged(documents(spark, texts)).select("doc_id", "quality_.*").collect()
    for r in rows:
        if r["doc_id"] is not None:
            assert tuple(r[m] for m in q.MEASURES) + (r["base_failed"],) == brute(texts[r["doc_id"] // 3]), r
            assert r["failed"] == brute_rules(texts[r["doc_id"] // 3]), r


def test_columns_stay_and_hosts_reject(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    df = spark.createDataFrame(
        [(i, good if i % 10 == 0 else bad, "bad" if i < 60 else "good") for i in range(60)]
        + [(i, good, "good" if i < 110 else None) for i in range(60, 120)],
        "doc_id long, text string, source string",
    )
    rows = q.judged(df)
    assert rows.columns == ["doc_id", "text", "source", "quality"]
    got = {r["doc_id"]: r["quality"] for r in rows.collect()}
    assert len(got) == 120 and not any(got[i]["kept"] for i in range(60))  # good texts of a bad host go too
    assert all(got[i]["kept"] for i in range(60, 120))
    assert got[115]["host_rate"] is None and 0.5 < got[0]["host_rate"] < 0.9 + 1e-9


def test_each_rule_decides(spark):
    words = [f"word{i}" for i in range(60)]
    texts = {
        "": " ".join(words),
        "symbols": " ".join(words) + " " + "# " * 7,
        "lines": "\n".join([" ".join(words), "x", "x", "x", "x"]),
        "word_length": " ".join(w * 3 for w in words),
        "base": "few words",
    }
    rows = q.judged(documents(spark, list(texts.values()))).select("doc_id", "quality_.*").collect()
    got = {r["doc_id"] // 3: r for r in rows if r["doc_id"] is not None}
    for i, name in enumerate(texts):
        assert got[i]["failed"] == ([name] if name else []), name


def hosts_of(spark, counts):
    """Documents of hosts, given (good, symbol junk, short) counts; the verdicts by host."""
    good, junk, short = " ".join(f"word{i}" for i in range(60)), "ab### " * 30 + " ".join(f"word{i}" for i in range(60)), "short"
    rows = [(t, h) for h, c in counts.items() for t, n in zip((good, junk, short), c, strict=True) for _ in range(n)]
    df = spark.createDataFrame(rows, "text string, source string")
    got = q.judged(df).select("text", "source", "quality.*").collect()
    rules = [brute_rules(r["text"]) for r in got]
    want = brute_hosts(rules, [r["source"] for r in got])
    assert {r["source"] for r in got if r["host_rejected"]} == want
    assert all(r["kept"] == (not b and r["source"] not in want) for r, b in zip(got, rules, strict=True))
    return want


def test_hosts_stand_out_by_several_rules(spark):
    like = {f"h{i}": (90 + i % 3, 5, 5) for i in range(8)}
    assert hosts_of(spark, like) == set()  # alike: nobody is rejected
    assert hosts_of(spark, like | {"junk": (60, 40, 0)}) == {"junk"}  # by one rule, below half of its documents
    assert hosts_of(spark, like | {"mix": (40, 30, 30)}) == {"mix"}  # by no rule alone above half
    assert hosts_of(spark, like | {"hot": (200, 300, 0), "one": (0, 1, 0)}) >= {"hot"}  # more than a third of all rows
    assert hosts_of(spark, {"only": (1, 3, 0)}) == {"only"} and hosts_of(spark, {"only": (3, 0, 1)}) == set()


def test_prior_is_fitted_to_the_hosts():
    rng = np.random.default_rng(5)
    docs = rng.integers(50, 500, 3000)
    failures = rng.binomial(docs, rng.beta(2, 6, 3000))
    mean, weight = q.beta_prior(3000, int(docs.sum()), float((docs**2).sum()), int(failures.sum()), float((failures**2 / docs).sum()))
    assert abs(mean - 0.25) < 0.01 and abs(weight - 8) < 0.5  # chance within a host is taken off
    failures = rng.binomial(docs, 0.25)
    weight = q.beta_prior(3000, int(docs.sum()), float((docs**2).sum()), int(failures.sum()), float((failures**2 / docs).sum()))[1]
    assert weight > 5000
    assert q.beta_prior(0, None, None, None, None) == (0.0, 1.0)
    assert q.beta_prior(2, 10, 50.0, 10, 10.0) == (1.0, q.MOST_WEIGHT) and q.beta_prior(1, 10, 100.0, 5, 2.5)[1] == q.MOST_WEIGHT


def test_no_rows_and_no_python(spark):
    rows = q.judged(empty(spark))
    assert rows.count() == 0
    plan = q.measured(documents(spark), "text", "m")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert rows.select(F.col("quality_.kept")).count() == 0
