import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import documents, empty, odd_texts, prose
from mercata.llm import packing, rans, token_files, word_ids
from mercata.session import scratch_path

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_has_the_librarys_ids(library, text):
    words = word_ids.WordIds(PATH)
    assert next(words.with_end([text])).tolist() == ids_of(library, text)


def test_odd_texts_and_a_small_table_of_pieces(library):
    words = word_ids.WordIds(PATH)
    words.limit = 50
    texts = [t or "" for t in odd_texts()] + ["Ab, ab. ÀB! ab", "Σας ΑΣ, İx", "x's y'll<|endoftext|>."] + [prose(s, 80) for s in range(9)]
    for text, ids in zip(texts, words.with_end(texts), strict=True):
        assert ids.tolist() == ids_of(library, text), text


@pytest.mark.parametrize("n", [0, 1, 2, 1023, 1024, 1025, 262_144, 262_145, 700_001])
def test_blocks_decode_to_what_was_encoded(n):
    tokens = np.random.default_rng(n).zipf(1.4, n) % 49_000
    table = rans.Table.of_counts(np.bincount(tokens, minlength=1 << 16))
    block = rans.encode(tokens, table)
    assert (rans.decode(block, table) == tokens).all()
    if n > 10_000:
        p = np.bincount(tokens) / n
        p = p[p > 0]
        assert len(block) < 1.1 * n * -(p * np.log2(p)).sum() / 8 + 9000


def test_damage_and_foreign_tables_are_told():
    tokens = np.arange(5000) % 300
    table = rans.Table.of_counts(np.bincount(tokens, minlength=400))
    block = rans.encode(tokens, table)
    with pytest.raises(ValueError):
        rans.decode(block[:100] + bytes([block[100] ^ 1]) + block[101:], table)
    with pytest.raises(ValueError):
        rans.decode(block[:-9], table)
    with pytest.raises(ValueError):
        rans.decode(block, rans.Table.of_counts(np.bincount(tokens[:100], minlength=400)))


@pytest.mark.parametrize("counts", [[0, 0], [5], [1] * 50_000, [10**12, 1, 1]])
def test_frequencies_fill_the_range(counts):
    freq = rans.Table.of_counts(np.array(counts)).freq
    assert freq.sum() == (1 << rans.BITS if any(counts) else 0) and ((freq > 0) == (np.array(counts) > 0)).all()


def test_files(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 2000)
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(token_files.tokenised(documents(spark), "doc_id", "text", PATH), path)
    rows = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    texts = odd_texts()
    want = [None, *[3 * i for i in range(len(texts))], 3 * len(texts) - 3]  # a missing id first, a repeated row behind itself
    assert [r["id"] for r in rows] == want
    at = 0
    for r in rows:
        ids = ids_of(library, "no id at all" if r["id"] is None else texts[r["id"] // 3])
        assert (r["start"], r["n_tokens"], r["ids"]) == (at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_no_rows(spark):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(token_files.tokenised(empty(spark), "doc_id", "text", PATH), path)
    assert token_files.read_tokens(spark, path).count() == 0


def check_places(pieces, tokens, loss, limits, cut):
    sequences, rows = {}, {}
    for p in sorted(pieces, key=lambda p: (p.sequence, p.offset)):
        own = sequences.setdefault(p.sequence, [0, 0, 0.0])
        assert p.offset == own[0] and p.length > 0
        own[0] += p.length
        own[1] += 1
        own[2] += loss[p.row] * p.length / tokens[p.row]
        rows.setdefault(p.row, []).append((p.start, p.length))
    for row, parts in rows.items():
        ends = [s + n for s, n in sorted(parts)]
        assert [s for s, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] == tokens[row]
        assert cut or len(parts) == 1
    assert len(rows) == len(tokens) and sorted(sequences) == [*range(len(sequences))]
    return sequences


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9000), min_size=1, max_size=60))
def test_texts_fill_sequences_without_padding(lengths):
    tokens = np.array(lengths)
    sequences = check_places(packing.place(tokens, tokens, packing.Limits(), True), tokens, tokens, None, True)
    assert all(n <= 4096 and (n == 4096 or n & (n - 1) == 0) for n, _, _ in sequences.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 600), st.floats(0, 1)), min_size=1, max_size=80))
def test_examples_stay_whole_under_three_limits(rows):
    tokens = np.array([t for t, _ in rows])
    loss = np.array([int(t * f) for t, f in rows])
    limits = packing.Limits(tokens=512, segments=4, loss=200)
    for n, k, own in check_places(packing.place(tokens, loss, limits, False), tokens, loss, limits, False).values():
        assert k == 1 or (n <= 512 and k <= 4 and own <= 200 + 1e-6)


def test_packed_documents(spark, library):
    rows = packing.packed_documents(documents(spark), "doc_id", "text", PATH).collect()
    texts = odd_texts()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["id"], []).append(r)
    assert set(by_id) == {None, *[3 * i for i in range(len(texts))]}
    for i, own in by_id.items():
        ids = ids_of(library, "no id at all" if i is None else texts[i // 3])
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["doc_tokens"] == len(ids) and len(part) == r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        copies = 2 if i == 3 * len(texts) - 3 else 1
        assert sum(r["length"] for r in own) == copies * len(ids)
    assert packing.packed_documents(empty(spark), "doc_id", "text", PATH).count() == 0


def test_packed_examples(spark):
    df = spark.createDataFrame([(i, i % 50 * 10, i % 7 * 10) for i in range(200)] + [(None, None, None)], "x long, t long, l long")
    rows = packing.packed_examples(df, "x", "t", "l", packing.Limits(tokens=1000, segments=8, loss=100)).collect()
    assert len(rows) == 201 and len({(r["sequence_id"], r["segment"]) for r in rows}) == 201
