"""The pipeline against the operators' brute-force versions, stage by stage."""

from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline as p
from cases import documents, empty
from mercata.session import cut_lineage
from test_quality_rules import brute_hosts, brute_rules
from test_simhash import brute_components, brute_fingerprint
from test_suffix_dedup import brute as repeats_brute


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in p.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], sf_dir)))
    return [{r["doc_id"]: r for r in x.collect()} if i < 5 else x.collect() for i, x in enumerate(out)], out


def test_columns(stages):
    frames = stages[1]
    assert [n for n, _ in p.STAGES] == ["quality rules", "language ID", "near duplicates", "repeated passages", "packing"]
    for f in frames[1:5]:
        assert f.dtypes == frames[0].dtypes


def test_quality(stages):
    before, after = stages[0][:2]
    rules = {i: brute_rules(r["text"]) for i, r in before.items()}
    bad = brute_hosts(rules.values(), [r["source"] for r in before.values()])
    assert set(after) == {i for i, r in before.items() if not rules[i] and r["source"] not in bad}


def test_language_keeps_what_has_letters(stages):
    before, after = stages[0][1:3]
    assert set(after) == {i for i, r in before.items() if any(c.isalpha() for c in r["text"])}


def test_near_duplicates(stages):
    before, after = stages[0][2:4]
    ids = sorted(before)
    groups = brute_components(ids, [brute_fingerprint(before[i]["text"], 4) for i in ids])
    assert set(after) == {i for i, g in zip(ids, groups, strict=True) if i == g} and len(after) < len(before)


def test_repeated_passages(stages):
    before, after = stages[0][3:5]
    ids = sorted(before)
    for i, (_, removed, _, kept) in zip(ids, repeats_brute([before[i]["text"] for i in ids]), strict=True):
        text = kept.decode("utf-8", "replace").replace("�", "") if removed else before[i]["text"]
        if text.strip():
            assert (after[i]["text"], after[i]["n_chars"]) == (text, len(text))
        else:
            assert i not in after


def test_only_broken_characters_beside_a_cut_go(spark, sf_dir):
    passage = "".join(f"{i:03d} passage " for i in range(20))
    # The two characters before the passage end in the same byte.
    texts = [f"first \u00e9{passage}", f"second \ufffd text \u0129{passage}\u00e9 \ufffd last"]
    got = {r["doc_id"]: r for r in p.repeated_passages(spark, documents(spark, texts, repeat=False), sf_dir).collect()}
    want = "second \ufffd text \u00e9 \ufffd last"
    assert (got[0]["text"], got[3]["text"], got[3]["n_chars"]) == (texts[0], want, len(want))


def test_packing(stages):
    before, pieces = stages[0][4:]
    tokens = defaultdict(int)
    for r in pieces:
        tokens[r["doc_id"]] += r["length"]
    assert set(tokens) == set(before)
    assert all(tokens[r["doc_id"]] == r["doc_tokens"] for r in pieces)


def test_odd_documents_and_none(spark, sf_dir):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (documents(spark), documents(spark, ["x", None]), empty(spark)):
        for i, (_, stage) in enumerate(p.STAGES):
            wide = cut_lineage(stage(spark, docs, sf_dir))
            if i < 4:
                assert wide.columns == docs.columns
            docs = wide
    narrow = documents(spark).select(*columns)
    assert p.near_duplicates(spark, narrow, sf_dir).columns == columns


def test_the_callers_settings_and_tables_stay(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    key, before = p.BATCH_ROWS[0], "777"
    spark.conf.set(key, before)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    beside = cut_lineage(docs, "beside")
    tables = {t.name for t in spark.catalog.listTables()}
    first = p.run(spark, str(tmp_path))
    assert spark.conf.get(key) == before
    want = sorted(first.collect())
    second = sorted(p.run(spark, str(tmp_path)).collect())
    assert [r[:5] for r in second] == [r[:5] for r in want]
    assert beside.count() == 60 and sorted(first.collect()) == want
    assert {t.name for t in spark.catalog.listTables()} <= tables
    spark.conf.unset(key)
