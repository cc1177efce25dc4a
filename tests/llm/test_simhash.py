import math
import random
import re

import numpy as np
import pytest
import xxhash

from cases import documents, empty, odd_texts, prose
from mercata.llm import components as c
from mercata.llm import simhash as s


def brute_fingerprint(text, words=4):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i : i + words]) for i in range(max(len(found) - words + 1, min(len(found), 1)))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius=4):
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= radius and root(a) != root(b):
                label[root(b)] = root(a)
    least = {}
    for i, f in zip(ids, fps, strict=True):
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return [least.get(root(f)) for f in fps]


def test_fingerprints():
    for text in [*odd_texts(), "A B c", "a b c d", "a b c d e"]:
        assert s.fingerprint(text, 4) == brute_fingerprint(text), text
    assert s.fingerprint(None, 4) == s.fingerprint(" \n", 4) == 0


@pytest.mark.parametrize("lead", [8, 13])
def test_ties_join_what_is_within_the_radius(lead):
    rng = random.Random(lead)
    fps = set()
    for _ in range(12):  # chains and clusters of fingerprints a few bits apart
        f = rng.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 7)))
    fps = sorted(fps)
    prefixes = {}
    for f in fps:
        for mask in s.flips(lead, 2).tolist():
            prefixes.setdefault((f >> 64 - lead) ^ mask, []).append(f)
    edges = []
    for prefix, own in prefixes.items():
        a, b = s.bucket_ties(prefix, np.array(own, np.uint64), lead, 2)
        edges += zip(a.tolist(), b.tolist(), strict=True)
        assert len(a) < len(own)
    groups = {f: f for f in fps}

    def root(f):
        while groups[f] != f:
            f = groups[f]
        return f

    for a, b in edges:
        groups[root(a)] = root(b)
    want = dict(zip(fps, brute_components(fps, fps), strict=True))
    for a in fps:
        for b in fps:
            assert (root(a) == root(b)) == (want[a] == want[b])


def test_components_of_documents(spark):
    base = prose(50, 400)
    near = [base.replace(w, w + "x", 1) for w in base.split()[:40]]
    texts = [*odd_texts(), base, *near, base.upper(), "   ", prose(51, 400)]
    rows = s.components(documents(spark, texts), "doc_id", "text", words=4).collect()
    ids, fps = [r["id"] for r in rows], [r["fp"] % 2**64 for r in rows]
    assert len(rows) == len(texts) + 2
    for i, f in zip(ids, fps, strict=True):
        assert f == brute_fingerprint("no id at all" if i is None else texts[i // 3])
    assert [r["component_id"] for r in rows] == brute_components(ids, fps)


def test_one_row_of_each_group_stays(spark):
    df = documents(spark, [*odd_texts(), odd_texts()[5], None])
    kept = s.deduplicated(df, "doc_id", "text")
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # nulls and blanks are one group; the long text, its copies and the near copy another
    assert 0 in ids and not {3, 6} & set(ids) and 15 in ids and not {18, 21} & set(ids)
    assert len(ids) == len(set(ids)) and None in ids


def test_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(100, 101)]
    forest = c.star_forest(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r["a"], r["b"]) for r in forest) == [(0, i) for i in range(1, 61)] + [(100, 100 + i) for i in range(1, 50)]


def test_heavy_prefixes_are_split(spark, monkeypatch):
    monkeypatch.setattr(s, "BUCKET_VARIANTS", 20_000)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    # One group of near copies that share their leading 20 bits, and fingerprints of no group.
    fps = {base ^ sum(1 << b for b in rng.sample(range(44), rng.randrange(0, 4))) for _ in range(1500)}
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(300)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp long")
    levels, heaviest = [], 0
    for lead, rows in s.buckets(distinct, 2):
        levels.append(lead)
        held = {}
        for r in rows.collect():
            spent = ((r["fp"] % 2**64) >> 64 - lead ^ r["prefix"]).bit_count()
            n = sum(math.comb(64 - lead, k) for k in range(3 - spent))
            held[r["prefix"]] = held.get(r["prefix"], 0) + n
        heaviest = max([heaviest, *held.values()])
    assert len(levels) > 1 and heaviest <= 2 * s.BUCKET_VARIANTS
    forest = {r["b"]: r["a"] for r in c.star_forest(s.ties(distinct, 2)).collect()}
    groups = {}
    for f, label in zip(signed, brute_components(signed, fps), strict=True):
        groups.setdefault(label, set()).add(f)
    found = {}
    for f in signed:
        found.setdefault(forest.get(f, f), set()).add(f)
    assert found == groups and max(map(len, groups.values())) > 700


def test_no_rows(spark):
    assert s.components(empty(spark), "doc_id", "text").count() == 0
    assert s.prefix_bits(0, 2) == s.LEAST_PREFIX < s.prefix_bits(10**8, 2)
