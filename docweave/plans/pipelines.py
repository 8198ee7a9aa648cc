"""The dataflows end to end: DataFrame in, DataFrame out.

What a model gave is kept (in memory, then on disk) until the session ends or its results are
unpersisted, as several outputs of a dataflow read it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import media, values
from docweave.operators import batching, predicates, regroup, reports, search, upsert
from docweave.plans import plugins

_TRANSLATION = "struct<source_language:string,target_language:string,translator:string,content:string>"


@dataclass
class TranslationConfig:
    splitter: dict[str, Any] = field(default_factory=lambda: {"model": "LINES"})
    translator: dict[str, Any] = field(default_factory=lambda: {"model": "TAGGING"})
    batch_text_length: int = 10_000
    batches_per_worker: int = 10


def translation_batches(docs: DataFrame, target: str, config: TranslationConfig | None = None, chosen=None) -> DataFrame:
    """Documents to translate with their language's batch and task; reads no content."""
    config = config or TranslationConfig()
    found = predicates.search(docs, predicates.and_query(predicates.translation_query(chosen, target), predicates.has_type()))
    slim = found.select("doc_id", "id", "language", "content_text_length")
    batched = batching.by_length(slim, "content_text_length", config.batch_text_length, ["language"], "doc_id")
    return batching.group_batches(batched, config.batches_per_worker)


def translate(docs: DataFrame, target: str, config: TranslationConfig | None = None, chosen=None) -> tuple[DataFrame, DataFrame]:
    """(documents with the new translations, counts requested and written)."""
    config = config or TranslationConfig()
    found = predicates.search(docs, predicates.and_query(predicates.translation_query(chosen, target), predicates.has_type()))
    split = plugins.split_with(found.select("id", "language", "content").where("content IS NOT NULL"), config.splitter)
    parts = regroup.explode_parts(split.drop("content"), F.col("sentences")).drop("sentences")
    done = regroup.join_parts(plugins.translate_with(parts, config.translator, target), ["id", "language"], "translated")
    new = F.struct(F.col("language").alias("source_language"), F.lit(target).alias("target_language"), F.lit(config.translator["model"]).alias("translator"), "content").cast(_TRANSLATION)
    translations = done.select("id", new.alias("translation")).persist()  # the model runs once for both results
    counts = found.agg(F.count("*").alias("requested")).crossJoin(translations.agg(F.count("*").alias("translated")))  # one row each
    return upsert.upsert_translations(docs, translations), counts


def classify(docs: DataFrame, model: str, language: str, config: dict[str, Any] | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents with new tags, count); documents whose content in the language is missing drop out."""
    found = predicates.search(docs, predicates.and_query(predicates.unclassified(model, language), predicates.has_type()))
    texts = found.select("id", values.content_in(F.lit(language), F.col("language"), F.col("content"), F.col("content_translated")).alias("content")).where("content IS NOT NULL")
    labelled = plugins.classify_with(texts, config or {"model": "LENGTH"}).persist()
    tags = labelled.select("id", values.classified_tag(model, F.col("label")).alias("tag"))
    return upsert.add_tags(docs, tags), tags.agg(F.count("*").alias("classified"))


def translate_and_classify(docs: DataFrame, model: str, language: str) -> tuple[DataFrame, DataFrame]:
    """Translates what is in other languages, then classifies what is known in the language."""
    others = predicates.untranslated_elsewhere(language)
    docs, translated = translate(docs, language, chosen=others)
    docs, classified = classify(docs, model, language)
    return docs, translated.select("translated").crossJoin(classified)  # one row each


def transcribe(audio: DataFrame, docs: DataFrame, config: dict[str, Any] | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents with transcribed content, artifacts with confidence and score) of (id, content) binaries."""
    found = plugins.transcribe_with(audio, config or {"model": "SCRIPT"}).persist()
    good, _ = reports.split_errors(found)
    artifacts = good.select("id", values.confidence(F.col("score")).alias("confidence"), F.col("score").alias("manifest_confidence"), "segments")
    segments = good.select("id", F.posexplode("segments").alias("pos", "s")).select("id", "pos", F.col("s.text").alias("text"), F.lit(None).cast("string").alias("speaker"))
    return upsert.update_content(docs, regroup.speaker_text(segments, ["id"], "pos").select("id", "content")), artifacts


def extract(pages: DataFrame, config: dict[str, Any] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(contents, errors, report) of (id, html, n_pages)."""
    found = plugins.extract_with(pages, config or {"model": "HTML"}).persist()
    good, bad = reports.split_errors(found)
    return good, bad, reports.extraction_report(found.join(pages.select("id", "n_pages"), "id"))


def detect(files: DataFrame, images: list[str], documents: list[str], target_pages: int = 200, failed=None, config: dict[str, Any] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(batched files, document artifacts, report) of (doc_id, id, content_type, n_pages) files.

    ``failed`` is a predicate on id and page_number of pages that can't be read.
    """
    ways = media.with_category(files, images, documents)
    batched = batching.by_pages(ways, "n_pages", target_pages, ["category"], "doc_id")
    pages = regroup.explode_pages(ways.select("id", "n_pages")).withColumn("failed", F.lit(False) if failed is None else failed)
    seen = plugins.detect_with(pages, config or {"model": "EVERY"})
    return batched, regroup.pages_of_documents(seen), reports.inference_report(pages)


def index_vectors(docs: DataFrame, config: dict[str, Any] | None = None) -> DataFrame:
    """doc_id, content, vector."""
    return plugins.embed_with(docs.select(F.col("id").alias("doc_id"), "content"), config or {"model": "LETTERS"})


def find_similar(vectors: DataFrame, texts: list[str], k: int = 2, config: dict[str, Any] | None = None) -> DataFrame:
    """Nearest documents to each text, concatenated over the texts."""
    queries = vectors.sparkSession.createDataFrame(list(enumerate(texts)), "query_id int, content string")
    return search.nearest(vectors, plugins.embed_with(queries, config or {"model": "LETTERS"}), k)
