"""Small tables with the odd rows that every operator must bear."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use themselves
    "id long, quality string, kept string, language string, deduplicated string, row_number string, block string, fp string"
)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdefghij klmnoé") for _ in range(rng.randrange(2, 9))).strip() or "a" for _ in range(vocabulary)]
    return " ".join(rng.choice(known) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(words)).strip()


def odd_texts() -> list:
    """Nulls, blanks, one word, repeats, broken spaces, many scripts, special tokens, a long text."""
    long = prose(1, 3000)
    return [
        None,
        "",
        " \n\t ",
        "one",
        "One two\vthree\x1cfour",
        long,
        long,
        long.replace("a", "b", 1),
        "the cat sat on the mat " * 40,
        "日本語 текст É é ß İ Σ ΑΣ 🙂 é <|endoftext|> <|startoftext|>x",
        "a" * 500,
        "WARC/1.1\r\n\r\nx\r\n\r\n" * 30,
        *[prose(s, 120) for s in range(2, 8)],
    ]


def documents(spark, texts=None, repeat=True):
    """The texts as documents, with a null id, a null source, a null language and, if asked for, a repeated row."""
    texts = odd_texts() if texts is None else texts
    rows = [(i * 3, t, "en" if i % 2 else "fr", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    if repeat and rows:
        rows += [rows[-1], (None, "no id at all", None, None, None)]
    return spark.createDataFrame([(*r, 7, *"abcdefg") for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
