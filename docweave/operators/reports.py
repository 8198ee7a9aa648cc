"""Counts and errors of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def processing_report(reports: DataFrame) -> DataFrame:
    """Sum of (n_docs, n_pages) reports; none sum to 0."""
    return reports.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_docs", "n_pages")))


def errors_by_document(errors: DataFrame) -> DataFrame:
    """Errors (id, root_id, page_number or null, title, detail) of each root document, in order of appearance (``pos``)."""
    listed = F.array_sort(F.collect_list(F.struct("pos", "id", "page_number", "title", "detail")))
    return errors.groupBy(F.coalesce("root_id", "id").alias("doc_id")).agg(listed.alias("errors"), F.count("*").alias("n_errors"), F.sum(F.col("page_number").isNotNull().cast("long")).alias("n_pages"))


def error_report(errors: DataFrame) -> DataFrame:
    """n_docs: root documents with errors; n_pages: errors on pages, those on whole files count none."""
    return errors.agg(F.count_distinct(F.coalesce("root_id", "id")).alias("n_docs"), F.coalesce(F.sum(F.col("page_number").isNotNull().cast("long")), F.lit(0)).alias("n_pages"))


def inference_report(pages: DataFrame, failed: str = "failed") -> DataFrame:
    """processed and successes of a batch of pages: all documents and lines; complete documents and pages that were read.

    Pages that were read count in successes though their document is partial.
    """
    documents = pages.groupBy("id").agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("bad"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return documents.agg(F.count("*").alias("processed_docs"), total(F.col("n")).alias("processed_pages"), total((F.col("bad") == 0).cast("long")).alias("success_docs"), total(F.col("n") - F.col("bad")).alias("success_pages"))


def extraction_report(results: DataFrame) -> DataFrame:
    """processed and successes of (status, n_pages) extraction results."""
    ok = F.col("status") == "SUCCESS"
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return results.agg(F.count("*").alias("processed_docs"), total(F.col("n_pages")).alias("processed_pages"), total(ok.cast("long")).alias("success_docs"), total(F.when(ok, F.col("n_pages")).otherwise(0)).alias("success_pages"))


def final_report(preprocessing_errors: DataFrame, inference: DataFrame, inference_errors: DataFrame) -> DataFrame:
    """One row: inference counts as they are, errors of both stages rolled up."""
    errors = error_report(preprocessing_errors.unionByName(inference_errors)).withColumnsRenamed({"n_docs": "error_docs", "n_pages": "error_pages"})
    return inference.crossJoin(errors)  # one row each


def split_errors(results: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows)."""
    return results.where(F.col(error).isNull()), results.where(F.col(error).isNotNull())


def batch_statistics(batched: DataFrame, keys: list[str], length: str) -> DataFrame:
    return batched.groupBy(*keys).agg(F.count("*").alias("n_docs"), F.sum(length).alias("total"), F.max(length).alias("longest"))
