"""The queries that apply each operator of this subpackage, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package from where the driver has it, if nothing else says where
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    # texts may be long: smaller batches bound what a task holds outside the heap and in its Python worker
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweave.llm import neighbours

    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op2_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweave.llm import suffix_trees

    return suffix_trees.dedup_words(table(spark, sf_dir, "documents"), length=35, keep_text=False)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweave.llm import toxicity

    return toxicity.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweave.llm import quality

    return quality.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweave.llm import bpe

    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path(), keep_text=False)


def op6_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweave.llm import phrase_index

    found = phrase_index.find_phrases(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), length=10)
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweave.llm import languages

    return languages.held_out_languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweave.llm import suffix_array

    return suffix_array.dedup_bytes(table(spark, sf_dir, "documents"), length=200, keep_text=False)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweave.llm import minhash

    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "keeps")


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docweave.llm import line_runs

    kept = line_runs.dedup_line_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), min_lines=2, min_chars=250)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from docweave.llm import line_runs, phrase_index, suffix_array, suffix_trees

    return {"op2_suffix_trees": suffix_trees.ORACLE_SQL, "op6_phrase_index": phrase_index.ORACLE_SQL, "op8_suffix_array": suffix_array.ORACLE_SQL, "op10_line_runs": line_runs.ORACLE_SQL}
