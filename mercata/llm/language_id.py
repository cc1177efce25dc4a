"""Language identification by prediction by partial matching over bytes.

Each language has a variable-order context tree: how often each byte followed each context of 3, 2,
1 and 0 bytes in the training texts. A byte never seen after a context is reached by an escape, whose
probability is the share of distinct followers (method C), to the next shorter context, down to
equal chances. With the counts frozen a text's exact code length in each language is a sum over its
bytes; the shortest wins, and its score is its share of all languages' probabilities.

Counting covers every training text: tasks send one row per language and four-byte string, summed by
Spark. The model holds all of them, as sorted arrays per language: it grows with the distinct strings
of four bytes (twelve bytes for each, and less for the shorter ones), never with the rows. The code
lengths of the most frequent contexts, as many as ``TABLE_BYTES`` has room for, are also laid out in a
table; the strings of a text that it does not have are looked up in the arrays, with the same result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import ragged, read_table
from mercata.session import cut_lineage

ORDER = 3
TABLE_BYTES = 32 << 20
UNIT = 1024  # code lengths are whole numbers of 1/1024 bit, so sums do not depend on their order
LONG = (1 << 16) - 1  # in the table: as long as this or longer, to be worked out
PART = 1 << 20  # bytes handled at a time
CONTEXTS = 1 << 13  # laid out at a time
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def held_out(id_col) -> "F.Column":
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts behind one another, three zero bytes before each; starts and lengths."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + 3) - lengths
    return np.frombuffer(b"".join(b"\0\0\0" + t for t in texts), np.uint8), starts, lengths


def _parts(texts: list[bytes]):
    """Lists of whole texts of about ``PART`` bytes, with the place of the first."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PART or i == len(texts) - 1:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0


def counted(texts: DataFrame) -> DataFrame:
    """lang, gram (four bytes as a number) and n over all rows (text, lang) of ``texts``."""

    def run(batches):
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, rows in by_lang.items():
                for _, part in _parts(rows):
                    data, starts, lengths = _joined(part)
                    wide = data.astype(np.uint32)
                    grams = wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]
                    own = np.ones(len(grams), bool)  # not those that end in the next text's padding
                    for k in range(3):
                        own[(starts + lengths)[:-1] + k - 3] = False
                    found, n = np.unique(grams[own], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found)), pa.array(found, pa.int64()), pa.array(n, pa.int64())], ["lang", "gram", "n"]
                    )

    rows = texts.select(F.col("text").cast("binary"), "lang").where("octet_length(text) > 0")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ``keys``, sums of ``n`` and how many there were of each; equal keys need not be neighbours."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[firsts], np.add.reduceat(n, firsts) if len(keys) else n, np.diff(np.append(firsts, len(keys)))


def _at(keys: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """For each of ``values`` those of the wanted keys, as floats, 0 where a key is absent."""
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[place] == wanted
    return [np.where(known, v[place], 0).astype(float) for v in values]


class Counts:
    """What followed each context of up to ``ORDER`` bytes in one language, as sorted arrays."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.orders = []
        for k in range(ORDER, -1, -1):
            keys, n, _ = _summed(grams & np.uint32(256 ** (k + 1) - 1), n)
            self.orders.insert(0, (keys, n, *_summed(keys >> np.uint32(8), n)))
            grams = keys

    def chances(self, grams: np.ndarray, base: float) -> np.ndarray:
        """The chance of the last byte of each string after the bytes before it; ``base`` below all contexts."""
        chance = np.full(len(grams), base)
        for k, (keys, n, contexts, totals, seen) in enumerate(self.orders):
            key = grams & np.uint32(256 ** (k + 1) - 1)
            (count,) = _at(keys, key, n)
            chance = mixed(count, *_at(contexts, key >> np.uint32(8), totals, seen), chance)
        return chance

    def rows(self, wanted: np.ndarray, order: int, classes: np.ndarray, size: int, base: float) -> np.ndarray:
        """The same for all classes of bytes after each of the contexts ``wanted`` of ``order`` bytes."""
        if order:
            shorter, at = np.unique(wanted & np.uint32(256 ** (order - 1) - 1), return_inverse=True)
            below = self.rows(shorter, order - 1, classes, size, base)[at]
        else:
            below = np.full((len(wanted), size), base)
        keys, n, contexts, totals, seen = self.orders[order]
        first = np.searchsorted(keys, wanted << np.uint32(8))
        length = np.searchsorted(keys, wanted << np.uint32(8) | np.uint32(255), "right") - first
        own = ragged(np.arange(len(keys)), first, length)
        counts = np.zeros((len(wanted), size))
        counts[np.repeat(np.arange(len(wanted)), length), classes[keys[own] & np.uint32(255)]] = n[own]
        return mixed(counts, *(x[:, None] for x in _at(contexts, wanted, totals, seen)), below)


class Model:
    """Code lengths per context, following byte and language; see ``trained``."""

    def __init__(self, langs: list[str], counts: list[Counts]):
        self.langs, self.counts = langs, counts
        seen = np.unique(np.concatenate([np.empty(0, np.uint32), *(c.orders[0][0] for c in counts)])).astype(np.int64)
        self.base = 1 / (len(seen) + 1)  # all bytes that were never seen are one symbol, class 0
        known = np.union1d(seen, [0])  # texts begin after zero bytes
        self.classes, self.size = np.zeros(256, np.int32), len(known) + 1
        self.classes[known] = np.arange(1, self.size)
        contexts, totals, _ = _summed(
            np.concatenate([np.empty(0, np.uint32), *(c.orders[ORDER][2] for c in counts)]),
            np.concatenate([np.empty(0, np.int64), *(c.orders[ORDER][3] for c in counts)]),
        )
        room = TABLE_BYTES // (2 * self.size * max(len(langs), 1))
        chosen = np.sort(contexts[np.lexsort((contexts, -totals))[:room]])
        table = np.empty((len(chosen), self.size, len(langs)), np.uint16)
        for first in range(0, len(chosen), CONTEXTS):
            part = chosen[first : first + CONTEXTS]
            for i, c in enumerate(counts):
                found = coded_lengths(c.rows(part, ORDER, self.classes, self.size, self.base))
                table[first : first + len(part), :, i] = np.minimum(found, LONG)
        self.table = table.reshape(len(chosen) * self.size, len(langs))
        self.has_long = bool((self.table == LONG).any())
        self.row = np.full(self.size**ORDER if len(chosen) else 0, -1, np.int32)
        place = [self.classes[chosen >> np.uint32(shift) & np.uint32(255)] for shift in (16, 8, 0)]
        self.row[(place[0] * self.size + place[1]) * self.size + place[2]] = np.arange(len(chosen), dtype=np.int32)

    def codes(self, data: np.ndarray) -> np.ndarray:
        """Code lengths of each byte after the first three, in units, in each language, and a last row of zeros."""
        c = self.classes[data]
        codes = np.zeros((len(data) - 2, len(self.langs)), np.uint32)
        if len(self.row):
            row = self.row[(c[:-3] * self.size + c[1:-2]) * self.size + c[2:-1]]
            codes[:-1] = np.take(self.table, np.maximum(row, 0) * np.int64(self.size) + c[3:], 0, mode="clip")
            rest = row < 0
            if self.has_long:
                rest |= (codes[:-1] == LONG).any(1)
            rest = np.flatnonzero(rest)
        else:
            rest = np.arange(len(data) - 3)
        if len(rest):
            wide = [data[rest + k].astype(np.uint32) << np.uint32(24 - 8 * k) for k in range(4)]
            grams, at = np.unique(wide[0] | wide[1] | wide[2] | wide[3], return_inverse=True)
            for i, counts in enumerate(self.counts):
                codes[rest, i] = coded_lengths(counts.chances(grams, self.base))[at]
        return codes

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths in bits of each (non-empty) text in each language."""
        data, starts, lengths = _joined(texts)
        codes = self.codes(data)
        bounds = np.stack([starts - 3, starts - 3 + lengths], 1).reshape(-1)
        sums = np.add.reduceat(codes, bounds, 0, np.int64)[::2]
        return sums / UNIT

    def predictions(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """For each text: language, score and bits a byte. A text that is null or has no letter is
        ``und`` with score and bits 0."""
        best, score, bits = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and self.langs and LETTER.search(t)]
        raw = [texts[i].encode() for i in known]
        for first, part in _parts(raw):
            found = self.lengths(part)
            least = found.min(1, keepdims=True)
            share = np.exp2(np.maximum(least - found, -1000))
            for k, row in enumerate(known[first : first + len(part)]):
                at = int(found[k].argmin())
                best[row], score[row] = self.langs[at], float(1 / share[k].sum())
                bits[row] = float(found[k, at] / len(part[k]))
        return best, score, bits


def coded_lengths(chances: np.ndarray) -> np.ndarray:
    return np.round(-np.log2(chances) * UNIT).astype(np.uint32)


def mixed(counts: np.ndarray, total: np.ndarray, seen: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Chances of each follower: its share where it was seen, else the escape and the chance below."""
    whole = np.maximum(total + seen, 1)
    escaped = np.where(total > 0, seen / whole, 1.0) * below
    return np.where(counts > 0, counts / whole, escaped)


def trained(texts: DataFrame) -> Model:
    """A model of the rows (text, lang) of ``texts``, none of them null."""
    grams = cut_lineage(counted(texts), "language-grams")
    langs = sorted(r["lang"] for r in grams.select("lang").distinct().collect())

    def counts(lang: str) -> Counts:
        rows = grams.where(F.col("lang") == lang).select("gram", "n").toArrow()
        return Counts(rows.column("gram").to_numpy().astype(np.uint32), rows.column("n").to_numpy())

    return Model(langs, [counts(lang) for lang in langs])


def training_rows(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Texts with a language that are not held out."""
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"), df[lang_col].alias("lang"))
    return rows.where("text IS NOT NULL AND lang IS NOT NULL").where(~held_out(F.col("id"))).select("text", "lang")


def with_language(df: DataFrame, text_col: str, model: Model, out: str) -> DataFrame:
    """``df`` with a last struct column ``out``: lang_pred, score, bits (a byte)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at, names = df.columns.index(text_col), [f"c{i}" for i in range(len(df.columns))]

    def run(batches):
        for batch in batches:
            lang, score, bits = shared.value.predictions(batch.column(at).to_pylist())
            made = pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())], ["lang_pred", "score", "bits"]
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*names, "made"])

    kinds = [f.dataType.simpleString() for f in df.schema.fields]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    rows = df.toDF(*names).mapInArrow(run, f"{schema}, made struct<lang_pred: string, score: double, bits: double>")
    return rows.toDF(*df.columns, out)


def query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = trained(training_rows(docs, "doc_id", "text", "lang"))
    rows = with_language(docs.select("doc_id", "text"), "text", model, "found")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred", "found.score")
