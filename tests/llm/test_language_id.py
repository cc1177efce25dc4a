import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cases import documents, empty, odd_texts
from mercata.llm import language_id as l


def brute_length(training, text):
    """The exact code length by escapes from three bytes down, straight from the definition."""
    seen = defaultdict(Counter)
    for t in training:
        data = b"\0\0\0" + t.encode()
        for i in range(3, len(data)):
            for k in range(4):
                seen[data[i - k : i]][data[i]] += 1
    symbols = {b for t in training for b in t.encode()}
    data, bits = b"\0\0\0" + text.encode(), 0.0
    for i in range(3, len(data)):
        chance = 1.0
        for k in (3, 2, 1, 0):
            followers = seen.get(data[i - k : i])
            if not followers:
                continue
            total = sum(followers.values()) + len(followers)
            if data[i] in followers:
                bits -= math.log2(chance * followers[data[i]] / total)
                break
            chance *= len(followers) / total
        else:
            bits -= math.log2(chance / (len(symbols) + 1))
    return bits


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "text string, lang string")


def test_code_lengths(spark):
    training = ["the cat and the dog", "that is the end", "another one, then"]
    model = l.trained(rows(spark, [(t, "en") for t in training]))
    for text in ["the dog is the end", "xyz the", "t", "ééé"]:
        plain = text if text != "ééé" else "é"
        got = model.lengths([plain.encode()])[0, 0]
        if plain.isascii() and not set(plain) & set("xyz"):
            assert got == pytest.approx(brute_length(training, plain), abs=0.002 * len(plain))
        assert got > 0


def test_contexts_beyond_the_table_fall_back(spark, monkeypatch):
    training = [("the cat and the dog that is there", "en"), ("der hund und die katze die da ist", "de")]
    full = l.trained(rows(spark, training))
    monkeypatch.setattr(l, "TABLE_BYTES", 1)
    small = l.trained(rows(spark, training))
    assert len(small.table) < len(full.table)
    for model in (full, small):
        best, score, bits = model.predictions(["the dog", "die katze", None, "", " 12 ", "日本"])
        assert best[:5] == ["en", "de", "und", "und", "und"] and best[5] in ("en", "de")
        assert score[2:5] == [0.0] * 3 and all(0 <= x <= 1 for x in score) and bits[0] > 0


def brute_length_of(languages, lang, text):
    """The same where bytes that only other languages have count as symbols."""
    own = {b for t in languages[lang] for b in t.encode()}
    symbols = {b for texts in languages.values() for t in texts for b in t.encode()}
    extra = math.log2((len(symbols) + 1) / (len(own) + 1))
    return brute_length(languages[lang], text) + extra * sum(b not in own for b in text.encode())


def test_all_bytes_and_contexts_count(spark, monkeypatch):
    letters = "".join(chr(c) for c in [*range(32, 127), *range(0xA0, 0x250), *range(0x370, 0x580), *range(0x3041, 0x3100), *range(0x4E00, 0x5200)])
    training = {f"l{i}": [letters[i::9] * 2, f"the cat {i} and the dog {i} {letters[i * 7 : i * 7 + 300]}"] for i in range(9)}
    pairs = [(t, lang) for lang, texts in training.items() for t in texts]
    symbols = len({b for t, _ in pairs for b in t.encode()})
    assert symbols > 128
    texts = ["the cat 3 and", letters[2::9][:60], letters[100:160], letters[-40:], "\U0001f642 the"]
    full = l.trained(rows(spark, pairs))
    monkeypatch.setattr(l, "TABLE_BYTES", 1)
    none = l.trained(rows(spark, pairs))
    monkeypatch.setattr(l, "TABLE_BYTES", 1 << 18)
    some = l.trained(rows(spark, pairs))
    assert len(none.table) == 0 < len(some.table) < len(full.table)
    for t in texts:
        got = full.lengths([t.encode()])[0]
        assert (none.lengths([t.encode()])[0] == got).all() and (some.lengths([t.encode()])[0] == got).all()
        for i, lang in enumerate(full.langs):
            assert got[i] == pytest.approx(brute_length_of(training, lang, t), abs=0.001 * len(t.encode()))


def test_long_codes_are_exact():
    gram = lambda text: int.from_bytes(text, "big")
    model = l.Model(["x"], [l.Counts(l.np.array([gram(b"aaaa"), gram(b"bbbb")], l.np.uint32), l.np.array([10**12, 1]))])
    data = l.np.frombuffer(b"aaab", l.np.uint8)
    chance = float(model.counts[0].chances(l.np.array([gram(b"aaab")], l.np.uint32), model.base)[0])
    assert model.has_long and int(model.codes(data)[0, 0]) == round(-math.log2(chance) * l.UNIT) > l.LONG


def test_held_out_accuracy(spark, sf_dir):
    from mercata.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op8_language_id"](spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    held = [r for r in found if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_training_rows_leave_out_held_out_and_null(spark):
    df = documents(spark)
    got = l.training_rows(df, "doc_id", "text", "lang").count()
    ids = [*range(0, 3 * len(odd_texts()), 3), 3 * len(odd_texts()) - 3]
    kept = [i for i in ids if zlib.crc32(str(i).encode()) % 4 != 2 and odd_texts()[i // 3] is not None]
    assert got == len(kept)


def test_columns_stay_and_odd_rows(spark):
    df = documents(spark)
    model = l.trained(l.training_rows(df, "doc_id", "text", "lang"))
    out = l.with_language(df, "text", model, "language_")
    assert out.columns == [*df.columns, "language_"] and out.count() == df.count()
    assert out.where(F.col("text").isNull()).select("language_.lang_pred").first()[0] == "und"


def test_nothing_to_learn_from(spark):
    model = l.trained(l.training_rows(empty(spark), "doc_id", "text", "lang"))
    got = l.with_language(documents(spark), "text", model, "found").select("found.*").distinct().collect()
    assert [tuple(r) for r in got] == [("und", 0.0, 0.0)]
    assert l.with_language(empty(spark), "text", model, "found").count() == 0
