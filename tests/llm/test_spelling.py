import random
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from cases import documents, empty
from mercata.llm import spelling as s


def brute_words(rows):
    """Counts of the words of (doc_id, text) rows, letter by letter as the contract has it."""
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    """All words compared with all others."""
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w in words:
        for size in (len(w), len(w) + 1):
            for v in by_length.get(size, ()):
                if (size > len(w) or w < v) and is_near(w, v):
                    near[w].append(v)
                    near[v].append(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def misspelt(seed, known=40, texts=300):
    """Texts of a few stems with letters replaced, dropped, doubled and inserted."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abéÿ") for _ in range(rng.randrange(7, 11))) for _ in range(known)]
    out = []
    for _ in range(texts):
        words = []
        for _ in range(60):
            w = rng.choices(stems, [1 / (i + 1) for i in range(known)])[0]
            if rng.random() < 0.4:
                i, c = rng.randrange(len(w)), rng.choice("abéÿz")
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i] + w[i:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append(rng.choice([" ", "-", "\n", "9"]).join(words))
    return out


@pytest.mark.parametrize("block", [5, 1 << 14])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(s, "BLOCK_WORDS", block)
    texts = misspelt(block)
    df = documents(spark, texts)
    want = brute(brute_words([(r.doc_id, r.text) for r in df.collect()]))
    got = result(s.variants(df, "doc_id", "text"))
    assert got == want
    assert any(r[1] for r in want) and max(r[4] for r in want) > 3


def test_query_equals_brute_force(spark, sf_dir):
    rows = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = brute(brute_words([(r["doc_id"], r["text"]) for r in rows]))
    assert result(s.query(spark, sf_dir)) == want and len(want) > 1000


def test_forms_are_followed_to_the_last(spark):
    chain = ["aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb"]
    texts = [" ".join(w for k, w in enumerate(chain) for _ in range(3 * 12**k))]
    df = documents(spark, texts, repeat=False)
    words = brute_words([(0, texts[0])])
    got = {r[0]: r for r in result(s.variants(df, "doc_id", "text"))}
    assert set(got.values()) == brute(words)
    assert got["aaaaaaa"][2] == "aaaabbb"


def test_equal_letters_side_by_side_count_once(spark):
    # One letter dropped from a run of equal ones gives the same word wherever it is dropped.
    words = ["baaaaaac", "baaaaac", "baaaaacc", "aaaaaaaa", "aaaaaaaaa", "xxxxxxx"]
    df = documents(spark, [" ".join(words * 3), "XXXXXXX"], repeat=False)
    want = brute(brute_words([(r.doc_id, r.text) for r in df.collect()]))
    assert result(s.variants(df, "doc_id", "text")) == want


def test_long_words_and_words_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(s, "PART_ROWS", 100)
    monkeypatch.setattr(s, "BLOCK_LETTERS", 50)
    monkeypatch.setattr(s, "HELD_WORDS", 3)
    long = "ab" * 4000
    texts = [f"{long} {long}x {long[:-1]} {long[1:]} abcdefg", f"{long} {long}x {long[:-1]} {long[1:]} abcdefg abcdefgh abcdefgh", "÷×÷×÷×÷ ÷×÷×÷×÷"]
    df = documents(spark, texts)
    want = brute(brute_words([(r.doc_id, r.text) for r in df.collect()]))
    assert result(s.variants(df, "doc_id", "text")) == want


def test_odd_and_empty_tables(spark):
    odd = documents(spark)
    want = brute(brute_words([(r.doc_id, r.text) for r in odd.collect()]))
    assert result(s.variants(odd, "doc_id", "text")) == want
    assert result(s.variants(empty(spark), "doc_id", "text")) == set()
    assert result(s.variants(documents(spark, [None, "", "short words only"]), "doc_id", "text")) == set()


def test_common_length():
    for a, b in [("", ""), ("a", ""), ("abc", "abd"), ("x" * 500, "x" * 400 + "y"), ("x" * 500, "x" * 500), ("y" * 100, "x" * 100)]:
        want = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert s.common_length(a, b) == want
