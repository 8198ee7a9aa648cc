"""Documents, pages, segments and signals of the dataflows, derived from the test tables; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the test documents' language codes stand for (fixed values).
LANGUAGES = {"en": "ENGLISH", "fr": "FRENCH", "de": "GERMAN", "es": "SPANISH"}
#: Synthetic content types by doc_id % 6 (fixed values).
CONTENT_TYPES = ["application/pdf", "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "image/png", "image/jpeg", "audio/wav", "text/html"]
#: Extensions that the stand-in image and office libraries read (fixed values).
IMAGES = [".bmp", ".gif", ".jpeg", ".jpg", ".png", ".tiff", ".pdf", ".msp"]
OFFICE = [".docx", ".html", ".odt", ".png", ".pdf", ".key"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package from where the driver has it, if nothing else says where
    from pathlib import Path

    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(value, choices):
    out = F.when(value == choices[0][0], choices[0][1])
    for k, v in choices[1:]:
        out = out.when(value == k, v)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index documents: id, language, project, root document, content type, pages, a translation for each third."""
    d = table(spark, sf_dir, "documents")
    key = lambda x: F.lpad(x.cast("string"), 8, "0")
    language = _case(F.col("lang"), list(LANGUAGES.items()))
    target = F.when(F.col("lang") == "en", "FRENCH").otherwise("ENGLISH")
    translation = F.struct(language.alias("source_language"), target.alias("target_language"), F.lit("old").alias("translator"), F.substring("text", 1, 40).alias("content"))
    return d.select(
        "doc_id", key(F.col("doc_id")).alias("id"), F.lit("Document").alias("type"), language.alias("language"), F.col("source").alias("project"),
        F.when((F.col("doc_id") % 10).isin(5, 7), key(F.col("doc_id") - F.col("doc_id") % 10)).alias("rootDocument"),
        _case(F.col("doc_id") % 6, list(enumerate(CONTENT_TYPES))).alias("contentType"), F.concat(F.lit("/data/"), F.col("source"), F.lit("/file "), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("path"),
        (F.lit(1) + F.expr("n_chars div 1000")).cast("int").alias("n_pages"), F.col("text").alias("content"), F.col("n_chars").alias("content_text_length"),
        F.when(F.col("doc_id") % 3 == 0, F.array(translation)).alias("content_translated"), F.when(F.col("doc_id") % 4 == 0, F.array(F.concat(F.lit("classified:quality-v1:"), (F.col("doc_id") % 2).cast("string")))).alias("tags"),
    )


DOCUMENTS = """
docs AS (SELECT doc_id, lpad(doc_id::VARCHAR, 8, '0') AS id, 'Document' AS type,
  CASE lang WHEN 'en' THEN 'ENGLISH' WHEN 'fr' THEN 'FRENCH' WHEN 'de' THEN 'GERMAN' WHEN 'es' THEN 'SPANISH' END AS language, source AS project,
  CASE WHEN doc_id % 10 IN (5, 7) THEN lpad((doc_id - doc_id % 10)::VARCHAR, 8, '0') END AS root_document,
  CASE doc_id % 6 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' WHEN 2 THEN 'image/png' WHEN 3 THEN 'image/jpeg' WHEN 4 THEN 'audio/wav' ELSE 'text/html' END AS content_type,
  '/data/' || source || '/file ' || doc_id::VARCHAR || '.pdf' AS path, (1 + n_chars // 1000)::INTEGER AS n_pages, text AS content, n_chars AS content_text_length,
  CASE WHEN doc_id % 3 = 0 THEN CASE WHEN lang = 'en' THEN 'FRENCH' ELSE 'ENGLISH' END END AS translated_to, CASE WHEN doc_id % 3 = 0 THEN substring(text, 1, 40) END AS translated,
  CASE WHEN doc_id % 4 = 0 THEN 'classified:quality-v1:' || (doc_id % 2)::VARCHAR END AS tag FROM documents)"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of documents in stream order (seq), with a synthetic read failure."""
    d = documents(spark, sf_dir).select("doc_id", "id", "rootDocument", "n_pages")
    p = d.select("doc_id", "id", "rootDocument", F.explode(F.sequence(F.lit(1), F.col("n_pages"))).alias("page_number"))
    return p.withColumn("failed", (F.col("doc_id") * 7 + F.col("page_number")) % 11 == 0).withColumn("seq", F.col("doc_id") * 1000 + F.col("page_number"))


PAGES = DOCUMENTS + """,
pages_ AS (SELECT doc_id, id, root_document, page_number, (doc_id * 7 + page_number) % 11 = 0 AS failed FROM (SELECT doc_id, id, root_document, unnest(generate_series(1, n_pages)) AS page_number FROM docs))"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript segments: conversation turns; the system's and user's are one speaker, turns divisible by 7 have none."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.when(F.col("turn") % 7 == 6, F.lit(None)).when(F.col("role") == "assistant", "assistant").otherwise("human").alias("speaker"), "text")


SEGMENTS = """segments AS (SELECT conv_id, turn, CASE WHEN turn % 7 = 6 THEN NULL WHEN role = 'assistant' THEN 'assistant' ELSE 'human' END AS speaker, text FROM conversations)"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress signals: users are runs, event types activities."""
    e = table(spark, sf_dir, "events")
    progress = (F.abs(F.floor(F.col("value"))) % 101) / F.lit(100.0)
    return e.select((F.col("user_id") % 50).cast("string").alias("run_id"), F.col("event_type").alias("activity_id"), progress.alias("progress"), (F.lit(1.0) + F.length("event_type") % 3).alias("weight"), "ts", F.col("event_id").alias("seq"), (F.col("event_id") % 97 == 0).alias("force"))


SIGNALS = """signals AS (SELECT (user_id % 50)::VARCHAR AS run_id, event_type AS activity_id, (abs(floor(value))::BIGINT % 101) / 100.0::DOUBLE AS progress, (1.0 + length(event_type) % 3)::DOUBLE AS weight, ts, event_id AS seq, event_id % 97 = 0 AS force FROM events)"""
