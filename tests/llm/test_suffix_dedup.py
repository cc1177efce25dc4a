import random

import numpy as np
import pytest

from cases import documents, empty, odd_texts, prose
from mercata.llm import suffix_dedup as s


def brute(texts):
    """For each text in its order: bytes removed, runs, and what stays."""
    seen, out = {}, []
    for k, text in enumerate(texts):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            if seen.setdefault(data[i : i + 100], (k, i)) != (k, i):
                gone[i : i + 100] = True
        runs = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum())
        out.append((len(data), int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return out


def agrees(spark, texts):
    got = s.without_repeats(documents(spark, texts, repeat=False), "doc_id", "text").select("doc_id", "deduplicated_.*").collect()
    got = [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in sorted(got, key=lambda r: r["doc_id"])]
    assert got == brute(texts)
    return got


def repetitive():
    rng = random.Random(7)
    passages = [prose(100 + i, 40) for i in range(6)]
    texts = []
    for i in range(60):
        own = prose(200 + i, 30)
        for p in rng.sample(passages, 2):
            at, cut = rng.randrange(len(own)), rng.randrange(60)
            own = own[:at] + p[cut:] + own[at:]
        texts.append(own)
    return texts + [texts[3], texts[3], texts[5][:-1] + "?"]


@pytest.mark.parametrize("hot", [1, 4, 4096])
def test_every_byte_of_every_text(spark, monkeypatch, hot):
    monkeypatch.setattr(s, "HOT", hot)
    got = agrees(spark, [*odd_texts(), *repetitive(), "ab" * 300, "ab" * 51, "x" * 99, "x" * 100, "é" * 200, "aé" * 200])
    assert sum(r[1] for r in got) > 5000


def test_blocks_parts_and_shards_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 3000)
    monkeypatch.setattr(s, "PART", 1000)
    monkeypatch.setattr(s, "SHARD", 50)
    long = prose(1, 2000)
    agrees(spark, [*repetitive(), long, long[:500] + "!" + long[500:], None, "", long])


def test_strings_of_a_collection():
    rng = random.Random(5)
    core = bytes(rng.choice(b"abc") for _ in range(300))
    lead, n, data, texts = [], [], [], []
    for _ in range(200):
        at, before, count = rng.randrange(90, 100), rng.randrange(0, 69), rng.randrange(1, 70)
        count = min(count, before + 1)
        piece = bytearray(core[at - before : at - before + count + 99])
        if rng.random() < 0.5:
            piece[rng.randrange(len(piece))] = ord("z")
        lead.append(before)
        n.append(count)
        data.append(bytes(piece))
    lead, n, rank = np.array(lead), np.array(n), np.random.default_rng(1).permutation(200)
    got = s.repeated(lead, n, np.frombuffer(b"".join(data), np.uint8), rank)
    first = {}
    for i in range(200):
        for k in range(n[i]):
            key = (k - lead[i], data[i][k : k + 100])
            first[key] = min(first.get(key, 1 << 30), rank[i])
    for i in range(200):
        for k in range(n[i]):
            assert got[i, k] == (first[k - lead[i], data[i][k : k + 100]] < rank[i])
        assert not got[i, n[i] :].any()


def test_ids_missing_and_repeated(spark):
    long = prose(9, 60)
    df = documents(spark, [long, long, "short"])
    df = df.union(df.where("doc_id = 3")).union(df.where("doc_id = 0").selectExpr("CAST(null AS long)", *[c for c in df.columns[1:]]))
    rows = s.without_repeats(df, "doc_id", "text")
    assert rows.columns == [*df.columns, "deduplicated_"]
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"], r["deduplicated_"]["n_removed"]) for r in rows.collect())
    size = len(long.encode())
    # The missing id comes first; rows equal in id and text are one text.
    assert [g[3] for g in got if g[2] == long] == [0, size, size, size]
    assert len(got) == 7


def test_no_rows(spark):
    assert s.without_repeats(empty(spark), "doc_id", "text").count() == 0
