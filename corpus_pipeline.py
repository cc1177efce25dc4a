"""A corpus pipeline: documents in, packed token sequences out.

Each stage gets all that the one before it kept, written as Parquet and read again. All but the last
return the columns of documents. An empty table stays empty through all stages.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm import language_id, packing, quality_rules, simhash, suffix_dedup
from mercata.llm.common import fresh, read_table
from mercata.llm.word_ids import VOCABULARY
from mercata.session import cut_lineage, recorded_scratch, remove

LEAST_SCORE = 0.5  # of the predicted language
# Rows that go to Python at a time: texts are long, and a batch is held several times over, on both sides.
BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1500")
KNOWN_PIECES = 300_000  # that a Python worker keeps while it packs; earlier stages leave less room than a query of its own has
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep and whose host is not rejected; a null text goes."""
    rows = quality_rules.judged(docs)
    return rows.where(F.col(rows.columns[-1])["kept"]).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is at least as likely as all others together.

    The model is trained on the documents of this stage. Without any to train on, all stay.
    """
    model = language_id.trained(language_id.training_rows(docs, "doc_id", "text", "lang"))
    if not model.langs:
        return docs
    out = fresh(docs, "language")
    rows = language_id.with_language(docs, "text", model, out)
    kept = (F.col(out)["lang_pred"] != language_id.UNKNOWN) & (F.col(out)["score"] >= LEAST_SCORE)
    return rows.where(kept).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id. Four-word shingles, at most four differing bits."""
    return simhash.deduplicated(docs, "doc_id", "text", words=4, half=2).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occurred before, with their new length; a text without words left goes.

    A character that is cut in two goes as a whole.
    """
    rows = suffix_dedup.without_repeats(docs, "doc_id", "text", whole=True)
    cut = F.col(rows.columns[-1])
    rows = rows.withColumn("text", F.when(cut["n_removed"] == 0, F.col("text")).otherwise(cut["kept"].cast("string")))
    rows = rows.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return rows.where(F.col("text").rlike(r"\S")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, as op10 returns them."""
    path = str(public_tokenizers.path(VOCABULARY))
    pieces = packing.packed_documents(docs, "doc_id", "text", path, known=KNOWN_PIECES)
    return pieces.withColumnRenamed("id", "doc_id")


# What a stage leaves for the next one to remove, by thread, input folder and stage.
_left: ContextVar[dict[tuple[str, int], list[str]]] = ContextVar("tables of the stage before")
# The caller's own setting, by application and input folder, while stages run.
_callers: dict[tuple[str, str], str] = {}


def small_batches(spark: SparkSession, sf_dir: str) -> None:
    """Fewer rows go to Python at a time until ``usual_batches``."""
    key, value = BATCH_ROWS
    _callers.setdefault((spark.sparkContext.applicationId, sf_dir), spark.conf.get(key))
    spark.conf.set(key, value)


def usual_batches(spark: SparkSession, sf_dir: str) -> None:
    before = _callers.pop((spark.sparkContext.applicationId, sf_dir), None)
    if before is not None:
        spark.conf.set(BATCH_ROWS[0], before)


def tidy(stages: list[tuple[str, Stage]]) -> list[tuple[str, Stage]]:
    """The stages, with small batches; each starts by removing the tables that the one before it wrote for itself.

    By then that one's result has been written. Tables that its input still reads stay. A stage knows its own tables
    only, so other queries and pipelines of the application keep theirs. The last stage writes its result, which is
    small, and puts the caller's setting of batches back.
    """

    def wrapped(k: int, stage: Stage) -> Stage:
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            left = _left.get(None)
            if left is None:
                _left.set(left := {})
            small_batches(spark, sf_dir)
            done = False
            try:
                used = [f.removeprefix("file:").lstrip("/") for f in docs.inputFiles()]
                paths = {p: p.removeprefix("file:").lstrip("/") for p in left.pop((sf_dir, k - 1), [])}
                remove(spark, [p for p, plain in paths.items() if not any(f.startswith(f"{plain}/") for f in used)])
                with recorded_scratch() as own:
                    out = stage(spark, docs, sf_dir)
                left[sf_dir, k] = own
                if k == len(stages) - 1:
                    out = cut_lineage(out, "packed")
                done = True
            finally:
                if k == len(stages) - 1 or not done:
                    usual_batches(spark, sf_dir)
            return out

        return run_stage

    return [(name, wrapped(k, stage)) for k, (name, stage) in enumerate(stages)]


STAGES = tidy(
    [
        ("quality rules", quality),
        ("language ID", language),
        ("near duplicates", near_duplicates),
        ("repeated passages", repeated_passages),
        ("packing", packed),
    ]
)

# Fingerprints, code lengths, suffixes and token ids are beyond SQL: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = read_table(spark, sf_dir, "documents"), []
    try:
        for i, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if i < len(STAGES) - 1:
                with recorded_scratch() as written:
                    docs = cut_lineage(docs, f"stage-{i + 1}")
                remove(spark, last)
                last = written
    finally:
        usual_batches(spark, sf_dir)
    return docs
