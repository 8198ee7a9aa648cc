"""Named queries of the dataflow operators on the test tables, with their SQL for DuckDB.

Arrays and structs are flattened to scalars or text, so that rows compare.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions import forms, languages, media, paths, values
from docweave.operators import batching, predicates, regroup, reports, search, upsert
from docweave.plans import fixtures, pipelines, plugins, preprocessing
from docweave.sources import files
from docweave.streaming import progress

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def wrap(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return wrap


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _with(tables: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{tables} {select}"


D = fixtures.DOCUMENTS

# -- selection ---------------------------------------------------------------------------------


@_query(_with(D, "SELECT id, content_type, language, content_text_length FROM docs WHERE content_type IN ('application/pdf', 'image/png')"))
def scan_docs_by_type(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    found = predicates.search(d, predicates.docs_query(None, ["image/png", "application/pdf"]))
    return found.select("id", F.col("contentType").alias("content_type"), "language", "content_text_length")


@_query(_with(D, "SELECT count(*)::BIGINT AS n FROM docs WHERE coalesce(translated_to, '') <> 'ENGLISH'"))
def count_untranslated(spark, sf_dir):
    return predicates.search(fixtures.documents(spark, sf_dir), predicates.untranslated("ENGLISH")).agg(F.count("*").alias("n"))


@_query(_with(D, "SELECT id FROM docs WHERE id IN ('00000000', '00000006', '00000012', '99999999') AND content_type = 'application/pdf'"))
def docs_by_ids(spark, sf_dir):
    return predicates.search(fixtures.documents(spark, sf_dir), predicates.docs_query(["00000000", "00000006", "00000012", "99999999"], ["application/pdf"])).select("id")


@_query(_with(D, "SELECT id FROM docs WHERE content_type = 'application/pdf' AND language = 'FRENCH'"))
def docs_by_query(spark, sf_dir):
    return predicates.search(fixtures.documents(spark, sf_dir), predicates.docs_query({"term": {"language": "FRENCH"}}, ["application/pdf"])).select("id")


@_query(_with(D, "SELECT id FROM docs WHERE content_type IN ('audio/wav', 'application/pdf')"))
def docs_all(spark, sf_dir):
    return predicates.search(fixtures.documents(spark, sf_dir), predicates.docs_query({}, ["audio/wav", "application/pdf"])).select("id")


@_query(_with(D, "SELECT id FROM docs SEMI JOIN (SELECT doc_id FROM labels) USING (doc_id)"))
def docs_by_id_table(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return predicates.by_ids(d, fixtures.table(spark, sf_dir, "labels").select("doc_id"), "doc_id").select("id")


@_query(_with(D, "SELECT id, language FROM docs WHERE coalesce(translated_to, '') <> 'ENGLISH'"))
def untranslated_docs(spark, sf_dir):
    return predicates.search(fixtures.documents(spark, sf_dir), predicates.untranslated("ENGLISH")).select("id", "language")


@_query(_with(D, "SELECT id FROM docs WHERE coalesce(language, '') <> 'ENGLISH'"))
def untranslated_docs_template(spark, sf_dir):
    return predicates.search(fixtures.documents(spark, sf_dir), predicates.untranslated_elsewhere("ENGLISH")).select("id")


@_query(_with(D, "SELECT id FROM docs WHERE language <> 'ENGLISH' AND coalesce(translated_to, '') <> 'ENGLISH'"))
def untranslated_docs_map(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir).withColumn("content_translated", F.map_from_entries(F.transform("content_translated", lambda t: F.struct(t["target_language"], t["content"]))))
    return predicates.search(d, predicates.untranslated_elsewhere("ENGLISH")).select("id")


@_query(_with(D, "SELECT id FROM docs WHERE NOT starts_with(coalesce(tag, ''), 'classified:quality-v1:') AND (coalesce(translated_to, '') = 'ENGLISH' OR language = 'ENGLISH')"))
def unclassified_docs(spark, sf_dir):
    return predicates.search(fixtures.documents(spark, sf_dir), predicates.unclassified("quality-v1", "ENGLISH")).select("id")


@_query(_with(D, "SELECT id FROM docs WHERE tag IS NOT NULL AND (language = 'GERMAN' OR root_document IS NOT NULL) AND NOT (content_type = 'audio/wav')"))
def docs_by_bool(spark, sf_dir):
    query = {"bool": {"filter": [{"exists": {"field": "tags"}}], "should": [{"term": {"language": "GERMAN"}}, {"exists": {"field": "rootDocument"}}], "minimum_should_match": 1, "must_not": [{"terms": {"contentType": ["audio/wav"]}}]}}
    return predicates.search(fixtures.documents(spark, sf_dir), query).select("id")


@_query(_with(D, "SELECT id, CASE content_type WHEN 'application/pdf' THEN 'pdf' WHEN 'image/png' THEN 'image' WHEN 'image/jpeg' THEN 'image' ELSE 'to_pdf' END AS category FROM docs WHERE content_type <> 'audio/wav'"))
def formats_dispatch(spark, sf_dir):
    return media.with_category(fixtures.documents(spark, sf_dir).withColumnRenamed("contentType", "content_type"), fixtures.IMAGES, fixtures.OFFICE).select("id", "category")


@_query(_with(D, "SELECT id FROM docs WHERE content_type = 'audio/wav'"))
def audio_docs(spark, sf_dir):
    return predicates.search(fixtures.documents(spark, sf_dir), predicates.docs_query(None, media.AUDIO_TYPES)).select("id")


# -- paths and other scalars --------------------------------------------------------------------


@_query(_with(D, "SELECT id, substring(id, 1, 2) || '/' || substring(id, 3, 2) AS dir, project || '/' || substring(id, 1, 2) || '/' || substring(id, 3, 2) || '/' || id AS artifacts FROM docs"))
def artifact_paths(spark, sf_dir):
    return fixtures.documents(spark, sf_dir).select("id", paths.safe_dir(F.col("id")).alias("dir"), paths.artifacts_dir(F.col("id"), F.col("project")).alias("artifacts"))


def _files(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return d.select(
        "id", paths.document_path(F.col("id"), F.col("project"), F.col("rootDocument"), F.col("path")).alias("path"), "project", paths.document_location(F.col("rootDocument")).alias("location"),
        F.element_at(F.split("path", "/"), -1).alias("resource_name"), paths.page_count(F.when(F.col("doc_id") % 5 > 0, F.col("n_pages"))).alias("n_pages"),
    )


FILES = D + """,
files AS (SELECT id, CASE WHEN root_document IS NULL THEN ltrim(path, '/') ELSE project || '/' || substring(id, 1, 2) || '/' || substring(id, 3, 2) || '/' || id || '/raw' END AS path, project,
  CASE WHEN root_document IS NULL THEN 'filesystem' ELSE 'artifacts' END AS location, regexp_extract(path, '[^/]*$') AS resource_name, CASE WHEN doc_id % 5 > 0 THEN n_pages ELSE 1 END AS n_pages FROM docs)"""


@_query(_with(FILES, "SELECT * FROM files"))
def processed_files(spark, sf_dir):
    return _files(spark, sf_dir)


@_query(_with(FILES, "SELECT id, CASE location WHEN 'filesystem' THEN '/fs/' || path ELSE '/art/' || path END AS located FROM files"))
def located_files(spark, sf_dir):
    f = _files(spark, sf_dir)
    return f.select("id", paths.locate(F.col("location"), F.col("id"), F.col("project"), F.col("path"), "/fs", "/art", "/work").alias("located"))


@_query(_with(FILES, """SELECT id, CASE location WHEN 'filesystem' THEN path ELSE project || '/symlinks/' || substring(id, 1, 2) || '/' || substring(id, 3, 2) || '/' || id || '/' || resource_name END AS by_name,
  CASE location WHEN 'filesystem' THEN path ELSE project || '/symlinks/' || substring(id, 1, 2) || '/' || substring(id, 3, 2) || '/' || id || '/' || id || '.pdf' END AS by_id FROM files"""))
def published_paths(spark, sf_dir):
    f = _files(spark, sf_dir)
    columns = (F.col(c) for c in ("location", "id", "project", "path", "resource_name"))
    columns = list(columns)
    return f.select("id", paths.published_path(*columns, True).alias("by_name"), paths.published_path(*columns, False).alias("by_id"))


@_query(_with(D, "SELECT id, coalesce(root_document, id) AS routing FROM docs"))
def routes(spark, sf_dir):
    return fixtures.documents(spark, sf_dir).select(paths.route(F.col("id"), F.col("rootDocument")).alias("r")).select("r.id", "r.routing")


@_query(_with(D, "SELECT id, substring(sha256(path), 1, 20) || '-/--data--' || substring(project, 1, 10) || '--' || substring('file ' || doc_id::VARCHAR || '.pdf', 1, 10) AS name FROM docs"))
def debug_names(spark, sf_dir):
    return fixtures.documents(spark, sf_dir).select("id", paths.debug_name(F.col("path")).alias("name"))


@_query(_with(D, "SELECT id, CASE WHEN doc_id % 2 = 0 THEN content_text_length WHEN content <> '' THEN length(content) END::BIGINT AS length FROM docs"))
def content_lengths(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return d.select("id", paths.content_length(F.when(F.col("doc_id") % 2 == 0, F.col("content_text_length")), F.col("content")).cast("long").alias("length"))


@_query(_with(D, "SELECT id, lang AS alpha2, CASE lang WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' WHEN 'de' THEN 'deu' WHEN 'es' THEN 'spa' END AS alpha3, 'translation_' || lang || '_to_en' AS task, 'opus-' || lang || '-en' AS model FROM docs JOIN documents USING (doc_id)"))
def language_codes(spark, sf_dir):
    d = languages.with_codes(fixtures.documents(spark, sf_dir))
    return d.select("id", "alpha2", "alpha3", languages.model_name("opus", F.col("alpha2"), F.lit("en")).alias("m")).select("id", "alpha2", "alpha3", "m.task", "m.model")


@_query(_with(D, "SELECT id, 'Translate into FRENCH, without additional explanation: ' || substring(content, 1, 20) AS prompt, CASE WHEN starts_with(content, 'The') THEN substring(content, 4, 20) ELSE substring(content, 1, 20) END AS stripped FROM docs"))
def prompts(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return d.select("id", languages.prompt(F.substring("content", 1, 20), F.lit("FRENCH")).alias("prompt"), F.substring(languages.strip_prefix(F.col("content"), F.lit("The")), 1, 20).alias("stripped"))


@_query(_with(D, "SELECT id, CASE WHEN language = 'ENGLISH' THEN content WHEN translated_to = 'ENGLISH' THEN translated END AS content FROM docs"))
def content_in_language(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return d.select("id", values.content_in(F.lit("ENGLISH"), F.col("language"), F.col("content"), F.col("content_translated")).alias("content"))


@_query("""SELECT doc_id, doc_id % 4 <> 1 AND doc_id % 7 <> 0 AS valid FROM documents""")
def byte_ranges_valid(spark, sf_dir):
    d = fixtures.table(spark, sf_dir, "documents")
    gap = F.when(F.col("doc_id") % 4 == 1, 1).otherwise(0)
    ranges = F.array(F.array(F.lit(0), F.col("n_chars")), F.array(F.col("n_chars") + gap, F.col("n_chars") + 5))
    return d.select("doc_id", paths.byte_ranges_valid(ranges, F.when(F.col("doc_id") % 7 == 0, 3).otherwise(2)).alias("valid"))


@_query("SELECT event_id, md5(event_id::VARCHAR) AS trace_id, substring(md5(user_id::VARCHAR), 1, 16) AS parent_id, event_id % 2 = 0 AS sampled, '00-' || md5(event_id::VARCHAR) || '-' || substring(md5(user_id::VARCHAR), 1, 16) || CASE WHEN event_id % 2 = 0 THEN '-01' ELSE '-00' END AS traceparent FROM events")
def traceparents(spark, sf_dir):
    e = fixtures.table(spark, sf_dir, "events")
    made = e.select("event_id", paths.traceparent(F.md5(F.col("event_id").cast("string")), F.substring(F.md5(F.col("user_id").cast("string")), 1, 16), F.col("event_id") % 2 == 0).alias("traceparent"))
    return made.select("event_id", "traceparent", paths.parse_traceparent(F.col("traceparent")).alias("p")).select("event_id", "traceparent", "p.trace_id", "p.parent_id", "p.sampled")


# -- batching -----------------------------------------------------------------------------------

_BY_LENGTH = D + """,
c AS (SELECT doc_id, id, language, sum(content_text_length) OVER (PARTITION BY language ORDER BY doc_id) AS cum FROM docs WHERE coalesce(translated_to, '') <> 'ENGLISH'),
b AS (SELECT id, language, sum(CASE WHEN cum > 10000 THEN 1 ELSE 0 END) OVER (PARTITION BY language ORDER BY doc_id)::BIGINT AS batch_id FROM c)"""


@_query(_with(_BY_LENGTH, "SELECT id, language, batch_id FROM b"))
def batch_by_length(spark, sf_dir):
    """The flagship: untranslated documents in length batches for each language."""
    return pipelines.translation_batches(fixtures.documents(spark, sf_dir), "ENGLISH").select("id", "language", "batch_id")


@_query(_with(_BY_LENGTH, "SELECT language, batch_id // 10 AS task_id, count(*)::BIGINT AS n_docs FROM b GROUP BY ALL"))
def batches_per_worker(spark, sf_dir):
    return pipelines.translation_batches(fixtures.documents(spark, sf_dir), "ENGLISH").groupBy("language", "task_id").agg(F.count("*").alias("n_docs"))


def _fold(stream: str, order: str, size: str, flush: str, source: str, tables: str = D) -> str:
    """A sequential fold in SQL: ``flush`` says from held and n when a batch is closed before a row."""
    return tables + f""",
r AS (SELECT {stream} AS stream, {order} AS o, {size} AS n, row_number() OVER (PARTITION BY {stream} ORDER BY {order}) AS rn FROM {source}),
f AS (SELECT stream, o, n, rn, n::BIGINT AS held, 0::BIGINT AS batch_id FROM r WHERE rn = 1
  UNION ALL SELECT r.stream, r.o, r.n, r.rn, CASE WHEN {flush} THEN r.n ELSE f.held + r.n END, CASE WHEN {flush} THEN f.batch_id + 1 ELSE f.batch_id END FROM f JOIN r ON r.stream = f.stream AND r.rn = f.rn + 1)"""


@_query(_with(_fold("language", "doc_id", "content_text_length", "f.held + r.n > 10000", "docs"), "SELECT o AS doc_id, batch_id FROM f", True))
def batch_by_length_reset(spark, sf_dir):
    return batching.by_length_reset(fixtures.documents(spark, sf_dir), "content_text_length", 10_000, ["language"], "doc_id").select("doc_id", "batch_id")


@_query(_with(_fold("content_type", "doc_id", "n_pages", "f.held >= 100", "docs"), "SELECT o AS doc_id, stream AS content_type, batch_id FROM f", True))
def batch_by_pages(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return batching.by_pages(d, "n_pages", 100, ["contentType"], "doc_id", block=97).select("doc_id", F.col("contentType").alias("content_type"), "batch_id")


@_query(_with(_fold("1", "doc_id", "n_pages", "f.held >= 40", "docs"), "SELECT o AS doc_id, unnest(generate_series(1, n)) AS page_number, batch_id FROM f", True))
def batch_inference(spark, sf_dir):
    p = fixtures.pages(spark, sf_dir).withColumn("all", F.lit(1))
    return batching.by_document_runs(p, "doc_id", 40, ["all"], "seq").select("doc_id", F.col("page_number").cast("long").alias("page_number"), "batch_id")


@_query(_with(D + ", r AS (SELECT doc_id, content_text_length AS n, row_number() OVER (ORDER BY doc_id) AS rn FROM docs)", "SELECT doc_id, sum(CASE WHEN rn > 1 AND n >= 3000 THEN 1 ELSE 0 END) OVER (ORDER BY doc_id)::BIGINT AS batch_id FROM r"))
def batch_bulk_chars(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir).select("doc_id", "content_text_length").withColumn("all", F.lit(1))
    return batching.by_characters(d, "content_text_length", 3000, ["all"], "doc_id").select("doc_id", "batch_id")


@_query(_with(D, "SELECT doc_id, language, (row_number() OVER (PARTITION BY language ORDER BY doc_id) - 1) // 64 AS batch_id FROM docs"))
def batch_fixed_language(spark, sf_dir):
    return batching.by_count(fixtures.documents(spark, sf_dir), 64, ["language"], "doc_id").select("doc_id", "language", "batch_id")


@_query(_with(D, "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 80 AS batch_id FROM docs"))
def batch_fixed_global(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir).select("doc_id").withColumn("all", F.lit(1))
    return batching.by_count(d, 80, ["all"], "doc_id").select("doc_id", "batch_id")


@_query(_with(D + ", b AS (SELECT language, (row_number() OVER (PARTITION BY language ORDER BY doc_id) - 1) // 64 AS batch_id, content_text_length AS n FROM docs)", "SELECT language, batch_id, count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total, max(n)::BIGINT AS longest FROM b GROUP BY ALL"))
def batch_statistics(spark, sf_dir):
    b = batching.by_count(fixtures.documents(spark, sf_dir), 64, ["language"], "doc_id")
    return reports.batch_statistics(b, ["language", "batch_id"], "content_text_length")


@_query(_with(D + ", b AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 10 + 995 AS n FROM docs)", "SELECT doc_id, (n // 1000)::VARCHAR || '/batch_' || n::VARCHAR || '.jsonl' AS path FROM b"))
def batch_shards(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir).select("doc_id").withColumn("all", F.lit(1))
    return batching.by_count(d, 10, ["all"], "doc_id").select("doc_id", batching.shards(F.col("batch_id"), F.lit(995)).alias("path"))


# -- taking apart and putting together ----------------------------------------------------------

_SENTENCES = D + r""",
s AS (SELECT doc_id, id, language, unnest(list_filter(string_split_regex(content, '\. |\n'), lambda x: x <> '')) AS part, unnest(generate_series(0, len(list_filter(string_split_regex(content, '\. |\n'), lambda x: x <> '')) - 1)) AS pos FROM docs)"""


@_query(_with(_SENTENCES, "SELECT id, pos::INTEGER AS pos, part FROM s"))
def explode_sentences(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return regroup.explode_parts(d.select("id", "content"), values.sentences(F.col("content"))).select("id", "pos", "part")


@_query(_with(_SENTENCES, "SELECT id, string_agg(part, ' ' ORDER BY pos) AS content, count(*)::BIGINT AS n_parts FROM s GROUP BY id"))
def regroup_sentences(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return regroup.join_parts(regroup.explode_parts(d.select("id", "content"), values.sentences(F.col("content"))), ["id"])


@_query(_with(D, "SELECT id, unnest(generate_series(1, n_pages))::INTEGER AS page_number FROM docs"))
def explode_pages(spark, sf_dir):
    return regroup.explode_pages(fixtures.documents(spark, sf_dir).select("id", "n_pages")).select("id", "page_number")


@_query(_with(fixtures.PAGES, """SELECT id, CASE WHEN bool_or(failed) THEN 'partial' ELSE 'complete' END AS status, count(*) FILTER (WHERE NOT failed)::BIGINT AS n_success_pages,
  coalesce(string_agg(page_number::VARCHAR, ',' ORDER BY page_number) FILTER (WHERE NOT failed AND page_number % 3 = 0), '') AS pages FROM pages_ GROUP BY id HAVING NOT bool_and(failed)"""))
def doc_status(spark, sf_dir):
    seen = plugins.detect_with(fixtures.pages(spark, sf_dir), {"model": "EVERY", "n": 3})
    found = regroup.pages_of_documents(seen)
    return found.select("id", "status", "n_success_pages", F.array_join(F.transform("pages", lambda p: p["page_number"].cast("string")), ",").alias("pages"))


@_query(_with(fixtures.PAGES + ", d AS (SELECT id, count(*) AS n, count(*) FILTER (WHERE failed) AS bad FROM pages_ GROUP BY id)", "SELECT count(*)::BIGINT AS processed_docs, sum(n)::BIGINT AS processed_pages, count(*) FILTER (WHERE bad = 0)::BIGINT AS success_docs, sum(n - bad)::BIGINT AS success_pages FROM d"))
def inference_report(spark, sf_dir):
    return reports.inference_report(fixtures.pages(spark, sf_dir))


def _errors(spark, sf_dir):
    p = fixtures.pages(spark, sf_dir).where("failed").select("id", F.col("rootDocument").alias("root_id"), "page_number", F.lit("ReadError").alias("title"), F.concat(F.lit("page "), F.col("page_number").cast("string")).alias("detail"), F.col("seq").alias("pos"))
    d = fixtures.documents(spark, sf_dir).where("doc_id % 13 = 0").select("id", F.col("rootDocument").alias("root_id"), F.lit(None).cast("int").alias("page_number"), F.lit("Unsupported").alias("title"), F.lit("file").alias("detail"), (F.col("doc_id") * 1000).alias("pos"))
    return d, p


_ERRORS = fixtures.PAGES + """,
e AS (SELECT coalesce(root_document, id) AS doc_id, page_number, 'page ' || page_number::VARCHAR AS detail, doc_id * 1000 + page_number AS pos FROM pages_ WHERE failed
  UNION ALL SELECT coalesce(root_document, id), NULL, 'file', doc_id * 1000 FROM docs WHERE doc_id % 13 = 0)"""


@_query(_with(_ERRORS, "SELECT doc_id, count(*)::BIGINT AS n_errors, count(page_number)::BIGINT AS n_pages, string_agg(detail, ';' ORDER BY pos) AS details FROM e GROUP BY doc_id"))
def error_rollup(spark, sf_dir):
    d, p = _errors(spark, sf_dir)
    return reports.errors_by_document(d.unionByName(p)).select("doc_id", "n_errors", "n_pages", F.array_join(F.transform("errors", lambda e: e["detail"]), ";").alias("details"))


@_query(_with(_ERRORS + ", d AS (SELECT id, count(*) AS n, count(*) FILTER (WHERE failed) AS bad FROM pages_ GROUP BY id)", "SELECT (SELECT count(*) FROM d)::BIGINT AS processed_docs, (SELECT sum(n) FROM d)::BIGINT AS processed_pages, (SELECT count(*) FROM d WHERE bad = 0)::BIGINT AS success_docs, (SELECT sum(n - bad) FROM d)::BIGINT AS success_pages, (SELECT count(DISTINCT doc_id) FROM e)::BIGINT AS error_docs, (SELECT count(page_number) FROM e)::BIGINT AS error_pages"))
def final_report(spark, sf_dir):
    d, p = _errors(spark, sf_dir)
    return reports.final_report(d, reports.inference_report(fixtures.pages(spark, sf_dir)), p)


@_query("SELECT count(*)::BIGINT AS n_docs, sum(1 + n_chars // 1000)::BIGINT AS n_pages FROM documents")
def processing_report(spark, sf_dir):
    parts = fixtures.documents(spark, sf_dir).groupBy("project").agg(F.count("*").alias("n_docs"), F.sum("n_pages").alias("n_pages"))
    return reports.processing_report(parts)


@_query(_with(fixtures.SEGMENTS + """,
c AS (SELECT *, CASE WHEN row_number() OVER w > 1 AND speaker IS DISTINCT FROM lag(speaker) OVER w THEN 1 ELSE 0 END AS change FROM segments WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (SELECT *, sum(change) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM c),
p AS (SELECT conv_id, run, string_agg(text, chr(10) ORDER BY turn) AS t FROM r GROUP BY ALL)""", "SELECT conv_id, string_agg(t, chr(10) || chr(10) ORDER BY run) AS content, count(*)::BIGINT AS n_paragraphs FROM p GROUP BY conv_id"))
def speaker_text(spark, sf_dir):
    return regroup.speaker_text(fixtures.segments(spark, sf_dir), ["conv_id"], "turn")


# -- updates ------------------------------------------------------------------------------------


def _new_translations(d):
    new = F.struct(F.col("language").alias("source_language"), F.lit("ENGLISH").alias("target_language"), F.lit("new").alias("translator"), F.when(F.col("doc_id") % 9 == 0, F.substring("content", 1, 40)).otherwise(F.concat(F.lit("new "), F.substring("content", 1, 10))).alias("content"))
    return d.where("doc_id % 2 = 1 OR doc_id % 9 = 0").select("id", new.alias("translation"))


def _flat(df):
    show = F.transform(F.coalesce("content_translated", F.array().cast(df.schema["content_translated"].dataType)), lambda t: F.concat_ws("|", t["source_language"], t["target_language"], t["translator"], t["content"]))
    return df.select("id", F.size(show).cast("long").alias("n"), F.array_join(show, "#").alias("translations"))


_NEW = "(doc_id % 2 = 1 OR doc_id % 9 = 0)"
_TEXT = "CASE WHEN doc_id % 9 = 0 THEN substring(content, 1, 40) ELSE 'new ' || substring(content, 1, 10) END"
_OLD = "(language || '|' || translated_to || '|old|' || translated)"


@_query(_with(D, f"""SELECT id, CASE WHEN translated IS NULL THEN (CASE WHEN {_NEW} THEN 1 ELSE 0 END) WHEN {_NEW} AND translated_to <> 'ENGLISH' THEN 2 ELSE 1 END::BIGINT AS n,
  CASE WHEN NOT {_NEW} THEN coalesce({_OLD}, '') WHEN translated IS NULL THEN language || '|ENGLISH|new|' || {_TEXT} WHEN translated_to <> 'ENGLISH' THEN {_OLD} || '#' || language || '|ENGLISH|new|' || {_TEXT}
  WHEN translated = {_TEXT} THEN {_OLD} ELSE language || '|ENGLISH|new|' || {_TEXT} END AS translations FROM docs"""))
def upsert_translations(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return _flat(upsert.upsert_translations(d, _new_translations(d)))


@_query(_with(D, f"""SELECT id, (CASE WHEN translated IS NULL THEN 0 ELSE 1 END + CASE WHEN {_NEW} THEN 1 ELSE 0 END)::BIGINT AS n,
  concat_ws('#', {_OLD}, CASE WHEN {_NEW} THEN language || '|ENGLISH|new|' || {_TEXT} END) AS translations FROM docs"""))
def append_translations(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return _flat(upsert.append_translations(d, _new_translations(d)))


@_query(_with(D, f"""SELECT id, CASE WHEN {_NEW} THEN {_TEXT} WHEN translated_to = 'ENGLISH' THEN translated END AS english, CASE WHEN translated_to = 'FRENCH' THEN translated END AS french FROM docs"""))
def put_translation_map(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    new = _new_translations(d).select("id", F.col("translation.target_language").alias("language"), F.col("translation.content").alias("content"))
    old = d.withColumn("content_translated", F.map_from_entries(F.transform("content_translated", lambda t: F.struct(t["target_language"], t["content"]))))
    out = upsert.put_translation_map(old, new)
    return out.select("id", F.try_element_at("content_translated", F.lit("ENGLISH")).alias("english"), F.try_element_at("content_translated", F.lit("FRENCH")).alias("french"))


@_query(_with(D, "SELECT id, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN tag = 'classified:quality-v1:0' THEN tag ELSE concat_ws(',', tag, 'classified:quality-v1:0') END ELSE coalesce(tag, '') END AS tags FROM docs"))
def add_tags(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    new = d.where("doc_id % 3 = 0").select("id", values.classified_tag("quality-v1", F.lit("0")).alias("tag"))
    return upsert.add_tags(d, new).select("id", F.array_join(F.coalesce("tags", F.array().cast("array<string>")), ",").alias("tags"))


@_query(_with(D, "SELECT id, CASE WHEN doc_id % 5 = 0 THEN 'heard' ELSE content END AS content FROM docs"))
def update_content(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return upsert.update_content(d, d.where("doc_id % 5 = 0").select("id", F.lit("heard").alias("content"))).select("id", "content")


@_query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new' WHEN doc_id % 2 = 0 THEN 'old' END AS structure, CASE WHEN doc_id % 2 = 0 THEN 'kept' END AS passports FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0""")
def manifest_merge(spark, sf_dir):
    d = fixtures.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("project"))
    old = d.where("doc_id % 2 = 0").withColumn("entries", F.create_map(F.lit("structure"), F.lit("old"), F.lit("passports"), F.lit("kept")))
    new = d.where("doc_id % 3 = 0").withColumn("entries", F.create_map(F.lit("structure"), F.lit("new")))
    merged = upsert.merge_manifests(old, new)
    return merged.select("doc_id", F.try_element_at("entries", F.lit("structure")).alias("structure"), F.try_element_at("entries", F.lit("passports")).alias("passports"))


# -- whole dataflows ----------------------------------------------------------------------------


@_query(_with(D, "SELECT count(*)::BIGINT AS requested, count(*) FILTER (WHERE regexp_replace(content, '\\. |\\n', '', 'g') <> '')::BIGINT AS translated FROM docs WHERE coalesce(translated_to, '') <> 'ENGLISH'"))
def translate_pipeline_counts(spark, sf_dir):
    return pipelines.translate(fixtures.documents(spark, sf_dir), "ENGLISH")[1]


@_query(_with(_SENTENCES + ", t AS (SELECT id, string_agg('[ENGLISH] ' || part, ' ' ORDER BY pos) AS content FROM s GROUP BY id)", "SELECT id, t.content AS english FROM t JOIN docs USING (id) WHERE coalesce(translated_to, '') <> 'ENGLISH'"))
def mapinpandas_translate(spark, sf_dir):
    docs, _ = pipelines.translate(fixtures.documents(spark, sf_dir), "ENGLISH")
    new = F.get(F.filter("content_translated", lambda t: t["translator"] == "TAGGING"), 0)
    return docs.select("id", new["content"].alias("english")).where("english IS NOT NULL")


@_query(_with(D + ", k AS (SELECT CASE WHEN language = 'ENGLISH' THEN content WHEN translated_to = 'ENGLISH' THEN translated END AS c FROM docs WHERE tag IS NULL)", "SELECT count(c)::BIGINT AS classified FROM k"))
def classify_pipeline_counts(spark, sf_dir):
    return pipelines.classify(fixtures.documents(spark, sf_dir), "quality-v1", "ENGLISH")[1]


@_query(_with(D + ", k AS (SELECT id, CASE WHEN language = 'ENGLISH' THEN content WHEN translated_to = 'ENGLISH' THEN translated END AS c FROM docs WHERE tag IS NULL)", "SELECT id, CASE WHEN length(c) >= 2000 THEN 'classified:quality-v1:long' ELSE 'classified:quality-v1:short' END AS tag FROM k WHERE c IS NOT NULL"))
def classified_tags(spark, sf_dir):
    docs, _ = pipelines.classify(fixtures.documents(spark, sf_dir), "quality-v1", "ENGLISH")
    return docs.select("id", F.explode("tags").alias("tag")).where(F.col("tag").rlike("(long|short)$"))


@_query(_with(D, """SELECT (SELECT count(*) FROM docs WHERE language <> 'ENGLISH' AND regexp_replace(content, '\\. |\\n', '', 'g') <> '')::BIGINT AS translated,
  (SELECT count(*) FROM docs WHERE tag IS NULL AND (language = 'ENGLISH' OR translated_to = 'ENGLISH' OR regexp_replace(content, '\\. |\\n', '', 'g') <> ''))::BIGINT AS classified"""))
def translate_and_classify_counts(spark, sf_dir):
    return pipelines.translate_and_classify(fixtures.documents(spark, sf_dir), "quality-v1", "ENGLISH")[1]


@_query("SELECT lpad(conv_id::VARCHAR, 8, '0') AS id, string_agg(text, chr(10) ORDER BY turn) AS content FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS text FROM conversations WHERE false) GROUP BY 1")
def transcribe_nothing(spark, sf_dir):
    """Documents without audio stay out of a transcription."""
    audio = fixtures.documents(spark, sf_dir).where("false").select("id", F.col("content").cast("binary").alias("content"))
    docs = fixtures.documents(spark, sf_dir).where("false")
    return pipelines.transcribe(audio, docs)[0].select("id", "content")


@_query(_with(D + """, a AS (SELECT id, content, CASE WHEN content LIKE '%' || chr(10) THEN left(content, -1) ELSE content END AS c FROM docs WHERE content_type = 'audio/wav' AND content IS NOT NULL),
n AS (SELECT id, c, CASE WHEN content = '' THEN 0 ELSE len(string_split(c, chr(10))) END AS n FROM a)""", "SELECT id, length(c)::INTEGER AS length, n::INTEGER AS n_segments, round(exp(-0.1 * n), 9) AS confidence FROM n"))
def transcribe_pipeline(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir).where(F.col("contentType") == "audio/wav")
    docs, artifacts = pipelines.transcribe(d.select("id", F.col("content").cast("binary").alias("content")), d)
    return docs.select("id", F.length("content").alias("length")).join(artifacts.select("id", F.size("segments").alias("n_segments"), F.round("confidence", 9).alias("confidence")), "id")


@_query("""SELECT page_id::VARCHAR AS id, 'SUCCESS' AS status, length(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')))::INTEGER AS length, 1::INTEGER AS total, true AS valid
FROM pages WHERE trim(html) <> ''""")
def mapinpandas_extract(spark, sf_dir):
    p = fixtures.table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), "html", F.lit(1).alias("n_pages"))
    good, _, _ = pipelines.extract(p)
    return good.select("id", "status", F.length("content").alias("length"), "total", paths.byte_ranges_valid(F.col("byte_ranges"), F.col("total")).alias("valid"))


@_query("SELECT count(*)::BIGINT AS processed_docs, count(*)::BIGINT AS processed_pages, count(*) FILTER (WHERE trim(html) <> '')::BIGINT AS success_docs, count(*) FILTER (WHERE trim(html) <> '')::BIGINT AS success_pages FROM pages")
def extraction_report(spark, sf_dir):
    p = fixtures.table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), "html", F.lit(1).alias("n_pages"))
    return pipelines.extract(p)[2]


@_query(_with(D, "SELECT count(*)::BIGINT AS processed_docs, sum(n_pages)::BIGINT AS processed_pages, count(*)::BIGINT AS success_docs, sum(n_pages)::BIGINT AS success_pages FROM docs WHERE content_type <> 'audio/wav'"))
def detection_report(spark, sf_dir):
    files = fixtures.documents(spark, sf_dir).withColumnRenamed("contentType", "content_type").select("doc_id", "id", "content_type", "n_pages")
    return pipelines.detect(files, fixtures.IMAGES, fixtures.OFFICE)[2]


# -- preprocessing and forms ---------------------------------------------------------------------


def _raw_files(spark, sf_dir):
    return fixtures.documents(spark, sf_dir).select("id", F.col("contentType").alias("content_type"), F.col("content").cast("binary").alias("content"))


@_query(_with(D, "SELECT id, 'UnsupportedFile' AS title, 'files of type audio/wav can''t be read' AS detail FROM docs WHERE content_type = 'audio/wav'"))
def unsupported_raw_files(spark, sf_dir):
    found = media.unsupported(_raw_files(spark, sf_dir), fixtures.IMAGES, fixtures.OFFICE)
    return found.select("id", "error.title", "error.detail")


#: Which stand-in reads a content type: pictures and PDFs are one page here, as they hold neither NUL bytes nor form feeds.
_PRINTED = "content_type LIKE '%wordprocessing%' OR content_type = 'text/html'"


@_query(_with(D + f""", f AS (SELECT id, content, {_PRINTED} AS printed FROM docs WHERE content_type <> 'audio/wav' AND content IS NOT NULL AND NOT (({_PRINTED}) AND content = '')),
p AS (SELECT id, content, printed, unnest(generate_series(1, CASE WHEN printed THEN 1 + (length(content) - 1) // 1000 ELSE 1 END)) AS k FROM f)""", "SELECT id, k::INTEGER AS page_number, octet_length(encode(CASE WHEN printed THEN substring(content, 1000 * (k - 1) + 1, 1000) ELSE content END))::INTEGER AS size FROM p"))
def page_images(spark, sf_dir):
    pages, _ = preprocessing.page_images(_raw_files(spark, sf_dir), fixtures.IMAGES, fixtures.OFFICE)
    return pages.select("id", "page_number", F.octet_length("image").alias("size"))


@_query(_with(D, f"SELECT CASE WHEN content_type = 'audio/wav' THEN 'UnsupportedFile' WHEN content IS NULL THEN 'MissingContent' ELSE 'ValueError' END AS title, count(*)::BIGINT AS n FROM docs WHERE content_type = 'audio/wav' OR content IS NULL OR (({_PRINTED}) AND content = '') GROUP BY 1"))
def preprocessing_errors(spark, sf_dir):
    _, errors = preprocessing.page_images(_raw_files(spark, sf_dir), fixtures.IMAGES, fixtures.OFFICE)
    return errors.groupBy(F.col("error.title").alias("title")).agg(F.count("*").alias("n"))


_MANIFEST = T.StructType([T.StructField("project", T.StringType()), T.StructField("docs", T.StringType()), T.StructField("doc_id", T.LongType()), T.StructField("target_language", T.StringType()), T.StructField("content_text_length", T.LongType())])


def _arguments(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir)
    return d.select("project", F.col("id").alias("docs"), "doc_id", F.lit("ENGLISH").alias("target_language"), F.col("content_text_length").cast("long").alias("content_text_length"))


_MANIFEST_SQL = """'{' || CASE WHEN source IS NULL THEN '' ELSE '"project":"' || source || '",' END || '"docId":' || doc_id || ',"targetLanguage":"ENGLISH"' || CASE WHEN n_chars IS NULL THEN '' ELSE ',"contentTextLength":' || n_chars END || '}'"""


@_query(f"SELECT {_MANIFEST_SQL} AS manifest FROM documents")
def manifest_arguments(spark, sf_dir):
    return _arguments(spark, sf_dir).select(forms.manifest_json(_MANIFEST).alias("manifest"))


@_query("SELECT source AS project, doc_id, 'ENGLISH' AS target_language, n_chars::BIGINT AS content_text_length FROM documents")
def manifest_round_trip(spark, sf_dir):
    written = _arguments(spark, sf_dir).select(forms.manifest_json(_MANIFEST).alias("m"))
    return written.select(forms.from_manifest(F.col("m"), _MANIFEST).alias("s")).select("s.*").drop("docs")


@_query(f"SELECT doc_id, sha256({_MANIFEST_SQL}) || '.json' AS name FROM documents")
def result_names(spark, sf_dir):
    return _arguments(spark, sf_dir).select("doc_id", forms.result_name(forms.manifest_json(_MANIFEST)).alias("name"))


@_query(_with(D, "SELECT id, language, content, n_pages FROM docs"))
def jsonl_round_trip(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir).select("id", "language", "content", "n_pages")
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="docweave-")
    path = f"{base.rstrip('/')}/jsonl-{uuid.uuid4().hex}"
    d.write.option("ignoreNullFields", True).json(path)
    return files.read_jsonl(spark, path, d.schema)


# -- order, places and keys ----------------------------------------------------------------------


@_query(_with(D, "SELECT id, content_type, row_number() OVER (PARTITION BY content_type ORDER BY doc_id)::BIGINT AS scan_pos FROM docs WHERE content_type IN ('application/pdf', 'image/png', 'audio/wav')"))
def ordered_scan_by_type(spark, sf_dir):
    found = predicates.ordered_scan(fixtures.documents(spark, sf_dir), predicates.docs_query(None, ["image/png", "application/pdf", "audio/wav"]), ["contentType"])
    return found.select("id", F.col("contentType").alias("content_type"), "scan_pos")


@_query(_with(D, "SELECT id, language, row_number() OVER (PARTITION BY language ORDER BY doc_id)::BIGINT AS scan_pos FROM docs WHERE coalesce(translated_to, '') <> 'ENGLISH' AND language IS NOT NULL"))
def ordered_scan_by_language(spark, sf_dir):
    found = predicates.ordered_scan(fixtures.documents(spark, sf_dir).where("language IS NOT NULL"), predicates.untranslated("ENGLISH"), ["language"])
    return found.select("id", "language", "scan_pos")


@_query(_with(D, "SELECT id, content_type, language, row_number() OVER (PARTITION BY content_type, language ORDER BY doc_id)::BIGINT AS scan_pos FROM docs WHERE language IS NOT NULL"))
def ordered_scan_by_type_and_language(spark, sf_dir):
    found = predicates.ordered_scan(fixtures.documents(spark, sf_dir).where("language IS NOT NULL"), predicates.match_all(), ["contentType", "language"])
    return found.select("id", F.col("contentType").alias("content_type"), "language", "scan_pos")


@_query("SELECT doc_id // 16 AS batch, doc_id % 16 AS pos, doc_id, length(text)::INTEGER AS found FROM documents")
def results_by_place(spark, sf_dir):
    d = fixtures.table(spark, sf_dir, "documents")
    place = [F.expr("doc_id div 16").alias("batch"), (F.col("doc_id") % 16).alias("pos")]
    return regroup.zip_results(d.select(*place, "doc_id"), d.select(*place, F.length("text").alias("found")), ["batch", "pos"])


@_query("SELECT doc_id, toxic FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)")
def required_documents(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id").distinct()
    labels = fixtures.table(spark, sf_dir, "labels").join(docs, "doc_id", "left_semi")
    return regroup.require_keys(labels.select("doc_id", "toxic"), docs, "doc_id")


@_query("SELECT event_id, event_type, ((row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 64)::BIGINT AS micro_batch FROM events")
def sentence_micro_batches(spark, sf_dir):
    e = fixtures.table(spark, sf_dir, "events").select("event_id", "event_type")
    return batching.micro_batches(e, 64, "event_type", "event_id")


@_query(_with(D, """SELECT id, CASE WHEN doc_id % 3 = 0 AND translated_to = 'ENGLISH' THEN 1 WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS n, 'second' AS english FROM docs WHERE language IS NOT NULL"""))
def updates_in_order(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir).where("language IS NOT NULL")
    two = d.select("id", "language", F.explode(F.array(F.lit("second"), F.lit("first"))).alias("text")).withColumn("at", F.when(F.col("text") == "first", 1).otherwise(2))
    new = F.struct(F.col("language").alias("source_language"), F.lit("ENGLISH").alias("target_language"), F.lit("new").alias("translator"), F.col("text").alias("content"))
    out = upsert.upsert_translations(d, two.select("id", "at", new.alias("translation")), order="at")
    english = F.get(F.filter("content_translated", lambda t: t["target_language"] == "ENGLISH"), 0)["content"]
    return out.select("id", F.size("content_translated").cast("long").alias("n"), english.alias("english"))


# -- older layout, files and tags ----------------------------------------------------------------


def _older(spark, sf_dir):
    """Documents with a map of language to text in place of the array."""
    d = fixtures.documents(spark, sf_dir)
    return d.withColumn("content_translated", F.map_from_entries(F.transform("content_translated", lambda t: F.struct(t["target_language"], t["content"]))))


@_query(_with(D, "SELECT id FROM docs WHERE tag IS NULL AND (language = 'ENGLISH' OR translated_to = 'ENGLISH')"))
def unclassified_older(spark, sf_dir):
    return predicates.search(_older(spark, sf_dir), predicates.unclassified_in_map("quality-v1", "ENGLISH")).select("id")


@_query(_with(D, "SELECT id, CASE WHEN language = 'FRENCH' THEN content WHEN translated_to = 'FRENCH' THEN translated END AS content FROM docs"))
def content_older(spark, sf_dir):
    d = _older(spark, sf_dir)
    return d.select("id", values.content_in_map(F.lit("FRENCH"), F.col("language"), F.col("content"), F.col("content_translated")).alias("content"))


@_query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN true WHEN 4 THEN false ELSE true END AS valid FROM events""")
def language_tags(spark, sf_dir):
    tags = F.array(*map(F.lit, ["en", "pt-BR", "english_uk", "zh-Hant-TW", "e", "sl-rozaj-biske"]))
    return fixtures.table(spark, sf_dir, "events").select("event_id", languages.is_tag(F.get(tags, F.col("event_id") % 6)).alias("valid"))


@_query(_with(D + ", m AS (SELECT DISTINCT 'm' || (doc_id % 7) AS model, language FROM docs WHERE language IS NOT NULL)", "SELECT language, string_agg(model, ',' ORDER BY model) AS models FROM m GROUP BY language"))
def language_models(spark, sf_dir):
    d = fixtures.documents(spark, sf_dir).where("language IS NOT NULL")
    models = d.groupBy(F.concat(F.lit("m"), (F.col("doc_id") % 7).cast("string")).alias("model")).agg(F.collect_set("language").alias("languages"))
    return regroup.models_by_language(models).select("language", F.array_join("models", ",").alias("models"))


@_query("SELECT lpad(doc_id::VARCHAR, 8, '0') AS id, 'work/' || doc_id || '.png' AS path, 'r' || (doc_id % 5) AS root_id, 'root/' || (doc_id % 5) AS root_path, 'filesystem' AS root_location, 'workdir' AS location FROM documents")
def child_files(spark, sf_dir):
    d = fixtures.table(spark, sf_dir, "documents")
    fields = {"id": F.lpad(F.col("doc_id").cast("string"), 8, "0"), "path": F.lit("old"), "project": F.col("source"), "location": F.lit("artifacts"), "resource_name": F.lit("x"), "n_pages": F.lit(1), "root_id": F.concat(F.lit("r"), (F.col("doc_id") % 5).cast("string")), "root_path": F.concat(F.lit("root/"), (F.col("doc_id") % 5).cast("string")), "root_location": F.lit("filesystem")}
    file = F.struct(*(v.alias(k) for k, v in fields.items()))
    made = paths.child_file(file, F.concat(F.lit("work/"), F.col("doc_id").cast("string"), F.lit(".png")))
    return d.select(made.alias("f")).select("f.id", "f.path", "f.root_id", "f.root_path", "f.root_location", "f.location")


# -- search -------------------------------------------------------------------------------------


@_query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
p AS (SELECT q.vec_id AS query_id, v.vec_id AS doc_id, round(1 - list_dot_product(q.e, v.e) / sqrt(list_dot_product(q.e, q.e) * list_dot_product(v.e, v.e)), 6) AS distance FROM v q, v WHERE q.vec_id < 5),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM p) SELECT query_id, doc_id, distance, rank::INTEGER AS rank FROM r WHERE rank <= 2""")
def top_k_similar(spark, sf_dir):
    v = fixtures.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    queries = v.where("doc_id < 5").withColumnRenamed("doc_id", "query_id")
    found = search.nearest(v, queries, 2)
    return found.select("query_id", "doc_id", F.round("distance", 6).alias("distance"), "rank")


@_query(_with(D + """, t AS (SELECT id, lower(coalesce(content, '')) AS c, greatest(1, length(coalesce(content, ''))) AS n FROM docs UNION ALL SELECT '0', 'the and of', 10 UNION ALL SELECT '1', 'der die das', 11),
v AS (SELECT id, list_transform(list_transform(range(26), lambda i: ((length(c) - length(replace(c, chr((97 + i)::INTEGER), ''))) / n)::FLOAT), lambda x: x::DOUBLE) AS e FROM t),
p AS (SELECT q.id::INTEGER AS query_id, v.id AS doc_id, round(1 - list_dot_product(q.e, v.e) / sqrt(list_dot_product(q.e, q.e) * list_dot_product(v.e, v.e)), 6) AS distance FROM v q, v WHERE length(q.id) = 1 AND length(v.id) = 8 AND list_sum(v.e) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM p)""", "SELECT query_id, distance, rank::INTEGER AS rank FROM r WHERE rank <= 2"))
def text_similar(spark, sf_dir):
    docs = fixtures.documents(spark, sf_dir).select("id", "content").where(F.lower("content").rlike("[a-z]"))
    found = pipelines.find_similar(pipelines.index_vectors(docs), ["the and of", "der die das"], 2)
    return found.select("query_id", F.round("distance", 6).alias("distance"), F.col("rank").cast("int").alias("rank"))


# -- progress -----------------------------------------------------------------------------------


@_query(_with(fixtures.SIGNALS + ", l AS (SELECT *, row_number() OVER (PARTITION BY run_id, activity_id ORDER BY ts DESC, seq DESC) AS r FROM signals)", "SELECT run_id, round(sum(progress * weight), 6) AS progress, sum(weight) AS max_progress FROM l WHERE r = 1 GROUP BY run_id"))
def progress_totals(spark, sf_dir):
    t = progress.totals(fixtures.signals(spark, sf_dir))
    return t.select("run_id", F.round("progress", 6).alias("progress"), "max_progress")


@_query(_with(fixtures.SIGNALS + """,
o AS (SELECT *, row_number() OVER (PARTITION BY run_id, activity_id ORDER BY ts, seq) AS rn FROM signals),
f AS (SELECT run_id, activity_id, rn, seq, ts AS last, true AS sent FROM o WHERE rn = 1
  UNION ALL SELECT o.run_id, o.activity_id, o.rn, o.seq, CASE WHEN o.force OR epoch_us(o.ts) - epoch_us(f.last) >= 3600000000 THEN o.ts ELSE f.last END, o.force OR epoch_us(o.ts) - epoch_us(f.last) >= 3600000000 FROM f JOIN o ON o.run_id = f.run_id AND o.activity_id = f.activity_id AND o.rn = f.rn + 1)""", "SELECT run_id, activity_id, seq FROM f WHERE sent", True))
def progress_throttled(spark, sf_dir):
    return progress.throttled(fixtures.signals(spark, sf_dir), 3600.0).select("run_id", "activity_id", "seq")


@_query(_with(fixtures.SIGNALS + ", b AS (SELECT run_id, activity_id, count(*) AS n FROM signals GROUP BY ALL)", "SELECT run_id, activity_id, (n + 2)::BIGINT AS n, 0.0::DOUBLE AS first, 1.0::DOUBLE AS last FROM b"))
def progress_bounds(spark, sf_dir):
    bounded = progress.with_bounds(fixtures.signals(spark, sf_dir))
    at = F.struct("ts", "seq")
    return bounded.groupBy("run_id", "activity_id").agg(F.count("*").alias("n"), F.min_by("progress", at).alias("first"), F.max_by("progress", at).alias("last"))


@_query("SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 0.0 ELSE (event_id % 100) / (user_id % 10)::DOUBLE END AS fraction, 0.2::DOUBLE + (event_id % 100) / 100.0::DOUBLE * (0.8::DOUBLE - 0.2::DOUBLE) AS scaled FROM events")
def progress_scalars(spark, sf_dir):
    e = fixtures.table(spark, sf_dir, "events")
    step = F.col("event_id") % 100
    return e.select("event_id", values.progress_fraction(step, (F.col("user_id") % 10).cast("double")).alias("fraction"), values.progress_scaled(step / F.lit(100.0), 0.2, 0.8).alias("scaled"))
