"""From documents to training tokens: the operators of the llm subpackage, one after the other.

Each stage gets the Parquet files of the one before it, works on all rows and, but for the last,
returns the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import bpe, line_runs, minhash, phrase_index, toxicity
from docweave.llm.common import drop_scratch, scratch_mark, shared_folder, written
from docweave.llm.queries import table, vocabulary_path

#: SQL can't express nearest-neighbour votes, near-duplicate classes or BPE; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled examples nearest to them mark as toxic go.

    Null, empty and long texts are scored like any (no known term: the score of no neighbours),
    repeated rows share their fate, no labels mean no toxic documents, extra columns are kept.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, threshold=0.7)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of two lines or more, or of one long line, are cut out; a document of nothing else goes.

    The first copy by doc_id, row and line stays; null and empty texts stay as they are; n_chars
    is counted again; extra columns are kept.
    """
    kept = line_runs.dedup_line_runs(docs, min_lines=2, min_chars=250).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the least doc_id, of repeated rows the first.

    Null texts and texts without words are in no class and stay; extra columns are kept.
    """
    return minhash.one_of_each(docs, shingle=5, similarity=0.8)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go.

    An item of fewer words counts whole; null and empty texts stay, an empty benchmark removes nothing, extra columns are kept.
    """
    found = phrase_index.find_phrases(docs, table(spark, sf_dir, "benchmark"), length=10)
    return found.where("n_hit = 0").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of them and of the text that they decode to; null texts are empty ones."""
    return bpe.encode_documents(docs, vocabulary_path(), keep_text=True).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to documents; each result is written to the shared folder and read again."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        mark = scratch_mark()
        docs = written(stage(spark, docs, sf_dir), name, folder)
        drop_scratch(spark, mark)  # only the stage's result is read from here on
    return docs
