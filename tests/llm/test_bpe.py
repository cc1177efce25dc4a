import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import documents, empty, odd_texts
from mercata.llm import bpe

PATH, PATTERN = str(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH, PATTERN)


def agrees(encoder, library, texts):
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert encoder.words.decode(ids) == library.decode(want, skip_special_tokens=False).encode()


def test_mixtures_of_spaces_words_and_special_tokens(encoder, library):
    rng = random.Random(3)
    parts = ["a", "the", "ing", " ", "  ", "\n", "\n\n", "\t", "é", "<|endoftext|>", "12", "..", "'s", "日本", "\x1c", "\0", "🙂", "aaaa", "　"]
    agrees(encoder, library, ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(3000)])


def test_odd_and_periodic_texts(encoder, library):
    agrees(encoder, library, [t or "" for t in odd_texts()] + ["a" * n for n in range(70)] + ["ab" * n + "=" * n for n in range(40)])


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(encoder, library, text):
    agrees(encoder, library, [text])


def test_known_pieces_are_dropped_and_learnt_again(library):
    small = bpe.Encoder(PATH, PATTERN)
    small.limit = 20
    texts = [f"word{i} again{i % 7} the end" for i in range(200)]
    for text in texts:
        agrees(small, library, [text])
    assert len(small.known) < 200


def test_shared_prefixes_are_encoded_once(encoder):
    words = sorted({b" the", b" then", b" there", b" thereby", b" these"})
    assert encoder.words.encode_words(words) == [next(iter(encoder.words.encode_words([w]))) for w in words]


def test_round_trips(spark, library):
    rows = bpe.round_trips(documents(spark), "doc_id", "text", PATH, PATTERN).collect()
    assert len(rows) == len(odd_texts()) + 2
    for r in rows:
        if r["id"] is not None:
            text = odd_texts()[r["id"] // 3] or ""
            ids = library.encode(text, add_special_tokens=False).ids
            assert (r["n_tokens"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(text.encode()).hexdigest())
            assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()


def test_ids_and_texts(spark):
    ids = bpe.encoded(documents(spark), "doc_id", "text", PATH, PATTERN)
    texts = {r["id"]: r["text"] for r in bpe.decoded(ids, PATH, PATTERN).collect()}
    assert texts == {None: "no id at all"} | {3 * i: t or "" for i, t in enumerate(odd_texts())}


def test_no_rows(spark):
    assert bpe.round_trips(empty(spark), "doc_id", "text", PATH, PATTERN).count() == 0
