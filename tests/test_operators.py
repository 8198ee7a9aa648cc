"""Known results of single operators, and folds against plain loops."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions import languages, media, paths, values
from docweave.operators import batching, predicates, regroup, reports, search, upsert
from docweave.plans import plugins, registry, tasks
from docweave.sources import files
from docweave.streaming import progress


def groups(df, order="id"):
    out = {}
    for r in df.orderBy(order).collect():
        out.setdefault(r.batch_id, []).append(r[order])
    return [out[k] for k in sorted(out)]


def docs(spark, sizes):
    return spark.createDataFrame([("x", i, n) for i, n in enumerate(sizes, 1)], "s string, id long, n long")


def test_length_batches(spark):
    assert groups(batching.by_length(docs(spark, [600, 600, 600]), "n", 1400, ["s"], "id")) == [[1, 2], [3]]
    # never reset: once over the limit, each document is a batch
    assert groups(batching.by_length(docs(spark, [600] * 5), "n", 1400, ["s"], "id")) == [[1, 2], [3], [4], [5]]
    assert groups(batching.by_length_reset(docs(spark, [600] * 5), "n", 1400, ["s"], "id")) == [[1, 2], [3, 4], [5]]
    assert [r.batch_id for r in batching.by_length(docs(spark, [9]), "n", 5, ["s"], "id").collect()] == [1]
    assert batching.by_length(docs(spark, [1]).where("false"), "n", 5, ["s"], "id").count() == 0


def test_page_batches(spark):
    assert groups(batching.by_pages(docs(spark, [1, 2, 1]), "n", 1, ["s"], "id")) == [[1], [2], [3]]
    pages = spark.createDataFrame([("x", 1, 6), ("x", 2, 0), ("x", 3, 0), ("x", 4, 7)], "s string, id long, doc int")
    assert groups(batching.by_document_runs(pages, "doc", 1, ["s"], "id")) == [[1], [2, 3], [4]]


def loop_pages(sizes, target):
    out, batch, held = [], 0, 0
    for i, n in enumerate(sizes):
        if held >= target:
            batch, held = batch + 1, 0
        held += n
        out.append(batch)
    return out


def loop_characters(sizes, target):
    out, batch = [], 0
    for i, n in enumerate(sizes):
        batch += i > 0 and n >= target
        out.append(batch)
    return out


def loop_length(sizes, limit):
    out, batch, total = [], 0, 0
    for n in sizes:
        total += n
        batch += total > limit
        out.append(batch)
    return out


@settings(max_examples=8, deadline=None)
@given(sizes=st.lists(st.integers(0, 12), min_size=1, max_size=40), target=st.integers(1, 15))
def test_folds_equal_loops(spark, sizes, target):
    df = docs(spark, sizes)
    got = lambda out: [r.batch_id for r in out.orderBy("id").collect()]
    assert got(batching.by_pages(df, "n", target, ["s"], "id", block=7)) == loop_pages(sizes, target)
    assert got(batching.by_characters(df, "n", target, ["s"], "id")) == loop_characters(sizes, target)
    assert got(batching.by_length(df, "n", target, ["s"], "id")) == loop_length(sizes, target)


def test_running_sums_cross_blocks(spark):
    got = batching.running_sums(docs(spark, range(1, 50)), ["s"], "id", {"t": F.col("n")}, block=5)
    assert [r.t for r in got.orderBy("id").collect()] == [sum(range(1, i + 1)) for i in range(1, 50)]


def test_regroup(spark):
    parts = spark.createDataFrame([("d", 1, "Goodbye"), ("d", 0, "Hello")], "id string, pos int, part string")
    assert [(r.content, r.n_parts) for r in regroup.join_parts(parts, ["id"]).collect()] == [("Hello Goodbye", 2)]


def test_speaker_text(spark):
    said = [("speaker_0_sentence_0", "a"), ("speaker_0_sentence_1", "a"), ("speaker_1_sentence_0", "b"), ("speaker_0_sentence_2", "a")]
    df = spark.createDataFrame([("d", i, t, s) for i, (t, s) in enumerate(said)], "id string, pos int, text string, speaker string")
    got = regroup.speaker_text(df, ["id"], "pos").collect()[0]
    assert got.content == "speaker_0_sentence_0\nspeaker_0_sentence_1\n\nspeaker_1_sentence_0\n\nspeaker_0_sentence_2" and got.n_paragraphs == 3


def test_reports(spark):
    pages = [("doc-0", 1, True), ("doc-0", 2, False), ("doc-1", 1, False), ("doc-2", 1, False)]
    df = spark.createDataFrame(pages, "id string, page_number int, failed boolean")
    r = reports.inference_report(df).collect()[0]
    assert (r.processed_docs, r.processed_pages, r.success_docs, r.success_pages) == (3, 4, 2, 3)
    found = {r.id: r.status for r in regroup.pages_of_documents(df.withColumn("detections", F.array(F.lit("x")))).collect()}
    assert found == {"doc-0": "partial", "doc-1": "complete", "doc-2": "complete"}
    results = spark.createDataFrame([("SUCCESS", 2), ("FAILURE", 1)], "status string, n_pages int")
    r = reports.extraction_report(results).collect()[0]
    assert (r.processed_docs, r.processed_pages, r.success_docs, r.success_pages) == (2, 3, 1, 2)


def python_upsert(items, new):
    if items is None:
        return [new]
    for i, t in enumerate(items):
        if t[:2] == new[:2]:
            return items if t[3] == new[3] else [*items[:i], new, *items[i + 1 :]]
    return [*items, new]


def test_upsert_equals_loop(spark):
    import itertools

    kind = "array<struct<source_language:string,target_language:string,translator:string,content:string>>"
    elements = [("EN", "FR", "a", "x"), ("EN", "FR", "b", "y"), ("EN", "DE", "a", "x")]
    cases = [None, [], *[list(c) for n in (1, 2, 3) for c in itertools.product(elements, repeat=n)]]
    new = ("EN", "FR", "c", "x")
    old = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], f"id int, content_translated {kind}")
    updates = old.select("id").withColumn("translation", F.expr("named_struct('source_language','EN','target_language','FR','translator','c','content','x')"))
    got = {r.id: [tuple(t) for t in r.content_translated] for r in upsert.upsert_translations(old, updates).collect()}
    assert got == {i: python_upsert(c, new) for i, c in enumerate(cases)}


def test_last_updates(spark):
    rows = [("d", 1, "a", "x"), ("d", 2, "b", "y"), ("d", 3, "c", "y"), ("e", 1, "a", "x")]
    df = spark.createDataFrame(rows, "id string, seq int, translator string, content string")
    got = {r.id: (r.translator, r.content) for r in upsert.last_updates(df, ["id"], "seq").collect()}
    assert got == {"d": ("b", "y"), "e": ("a", "x")}


def test_queries_have_the_known_form():
    pdf = {"bool": {"must": [{"terms": {"contentType": ["application/pdf"]}}, {"term": {"type": "Document"}}]}}
    assert predicates.docs_query(None, ["application/pdf"]) == {"query": pdf}
    assert predicates.docs_query(["doc-id-0"], ["application/pdf"]) == {"query": {"bool": {"must": [pdf, {"ids": {"values": ["doc-id-0"]}}]}}}
    assert predicates.docs_query({"term": {"some": "query"}}, ["application/pdf"]) == {"query": {"bool": {"must": [pdf, {"term": {"some": "query"}}]}}}
    assert predicates.translation_query(None, "ENGLISH") == {"bool": {"must_not": [{"term": {"content_translated.target_language.keyword": "ENGLISH"}}]}}
    with pytest.raises(ValueError, match="no query is known"):
        predicates.docs_query(3, [])


def test_compiled_queries(spark):
    df = spark.createDataFrame([("a", "x", ["t1"]), ("b", None, None)], "id string, contentType string, tags array<string>")
    found = lambda q: {r.id for r in predicates.search(df, q).collect()}
    assert found({"match_all": {}}) == {"a", "b"}
    assert found({"bool": {"must_not": [{"term": {"contentType": "x"}}]}}) == {"b"}
    assert found({"bool": {"must_not": [{"prefix": {"tags": "t"}}]}}) == {"b"}
    assert found({"term": {"missing.field": 1}}) == set() and found({"ids": {"values": []}}) == set()
    assert found({"bool": {"should": [{"term": {"tags": "t1"}}, {"ids": {"values": ["b"]}}]}}) == {"a", "b"}
    with pytest.raises(ValueError, match="unsupported query"):
        found({"regexp": {"id": "."}})


def test_paths(spark):
    row = spark.range(1).select(paths.artifacts_dir(F.lit("doc_id"), F.lit("p")).alias("a"), paths.suffix(F.lit("x/y.tar.gz")).alias("s"), paths.suffix(F.lit(".bashrc")).alias("n")).collect()[0]
    assert (row.a, row.s, row.n) == ("p/do/c_/doc_id", ".gz", "")
    with pytest.raises(Exception, match="four characters"):
        spark.range(1).select(paths.safe_dir(F.concat(F.lit("abc"), F.lit("")))).collect()
    valid = lambda r, n: spark.range(1).select(paths.byte_ranges_valid(F.expr(r), F.lit(n)).alias("v")).collect()[0].v
    assert not valid("array(array(0,1),array(1,2),array(2,3))", 2) and valid("array(array(0,1),array(1,2))", 2) and not valid("array(array(1,0))", 1)


def test_media_types():
    assert [len(media.types_of(e)) for e in (".pdf", ".docx", ".jpg")] == [1, 1, 2]
    assert media.types_of(".uot") == media.types_of(".xml")
    with pytest.raises(ValueError, match="no media type"):
        media.types_of(".nothing")
    ways = media.categories([".png", ".pdf", ".msp"], [".docx", ".png", ".key", ".pdf"])
    assert ways == {"pdf": [".pdf"], "image": [".png"], "to_pdf": [".docx"]}


def test_languages(spark):
    tags = {"en": True, "en-US": True, "zh-Hant-TW": True, "english language": False, "e": False, "de-1996": True}
    df = spark.createDataFrame([(t,) for t in tags], "t string")
    assert {r.t: r.ok for r in df.select("t", languages.is_tag(F.col("t")).alias("ok")).collect()} == tags


def test_progress(spark):
    import datetime

    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    rows = [("r", "a", 0.5, 2.0, at(0), 1, False), ("r", "a", 1.0, 2.0, at(1), 2, False), ("r", "b", 1.0, 4.0, at(2), 3, False), ("r", "a", 1.0, 2.0, at(31), 4, False), ("r", "b", 1.0, 4.0, at(3), 5, True)]
    df = spark.createDataFrame(rows, "run_id string, activity_id string, progress double, weight double, ts timestamp, seq long, force boolean")
    assert [(r.progress, r.max_progress) for r in progress.totals(df).collect()] == [(6.0, 6.0)]
    assert {r.seq for r in progress.throttled(df).collect()} == {1, 3, 4, 5}
    with pytest.raises(ValueError, match="start"):
        values.progress_scaled(F.lit(0.5), 0.8, 0.2)


def test_progress_stream(spark, tmp_path):
    import datetime

    rows = [("r", "a", 0.1 * i, 1.0, datetime.datetime(2024, 1, 1, 0, 0, i), i) for i in range(5)]
    df = spark.createDataFrame(rows, "run_id string, activity_id string, progress double, weight double, ts timestamp, seq long")
    df.write.parquet(str(tmp_path / "in"))
    query = progress.stream_latest(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "latest_progress")
    query.awaitTermination(60)
    assert [round(r.progress, 1) for r in spark.table("latest_progress").collect()] == [0.4]


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "p/a", "x", "filesystem", "a.pdf", 2, None, None, None, 0), ("b", "p/b", "x", "artifacts", "b.pdf", 1, None, None, None, 1)], T.StructType([*files.PROCESSED_FILE.fields, T.StructField("batch_id", T.IntegerType())]))
    files.write_batches(df, str(tmp_path / "batches"))
    back = files.read_jsonl(spark, str(tmp_path / "batches"), "id string, path string, n_pages int, batch_id int")
    assert {(r.id, r.n_pages) for r in back.collect()} == {("a", 2), ("b", 1)}
    assert files.count_lines(spark, str(tmp_path / "batches" / "batch_id=0")) == 1
    (tmp_path / "bad.jsonl").write_text('{"id": "a"}\n\n{"id": \n')
    with pytest.raises(Exception):  # noqa: B017
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "id string").collect()
    (tmp_path / "one.png").write_bytes(b"\x89PNG\r\n\x1a\n...")
    (tmp_path / "two.png").write_bytes(b"nothing")
    found = {r.path.rsplit("/", 1)[1]: r.error for r in files.read_images(spark, str(tmp_path / "*.png")).collect()}
    assert found["one.png"] is None and found["two.png"].title == "ValueError"
    path = files.replace_snapshot(df, str(tmp_path / "table"))
    assert spark.read.parquet(path).count() == 2


def test_manifests(spark):
    kind = "project string, doc_id string, entries map<string,string>"
    new = spark.createDataFrame([("p", "d1", {"a": "1"})], kind)
    old = spark.createDataFrame([("p", "d1", {"a": "0"}), ("p", "d2", {"a": "2"})], kind)
    got = {r.doc_id: (r.entries["a"], r.legacy) for r in files.read_manifests(new, old).collect()}
    assert got == {"d1": ("1", False), "d2": ("2", True)}


def test_plugins(spark):
    assert plugins.from_config("splitter", {"model": "default"}).split_sentences("a. b") == ["a. b"]
    with pytest.raises(ValueError, match="unknown translator"):
        plugins.from_config("translator", {"model": "none"})
    gone = []
    cache = plugins.ResourceCache(1, gone.append)
    first = cache.get("translator", {"model": "tagging"}, "EN", "FR")
    assert cache.get("translator", {"model": "tagging"}, "EN", "FR") is first
    assert cache.get("translator", {"model": "tagging"}, "EN", "DE") is not first and gone == [first]
    audio = spark.createDataFrame([("a", b"one\ntwo"), ("b", b"\xff")], "id string, content binary")
    found = {r.id: r for r in plugins.transcribe_with(audio, {"model": "SCRIPT"}).collect()}
    assert len(found["a"].segments) == 2 and found["b"].error.title == "UnicodeDecodeError"


def test_search(spark):
    vectors = spark.createDataFrame([("novel", [1.0, 0.0]), ("monkey", [0.0, 1.0])], "doc_id string, vector array<float>")
    asked = spark.createDataFrame([(0, [0.9, 0.1]), (1, [0.2, 0.9])], "query_id int, vector array<float>")
    assert {(r.query_id, r.doc_id) for r in search.nearest(vectors, asked, 1).collect()} == {(0, "novel"), (1, "monkey")}
    with pytest.raises(ValueError, match="queries"):
        search.nearest(vectors, asked, 1, most_queries=1)


def test_search_takes_every_query(spark):
    vectors = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0])], "doc_id string, vector array<float>")
    asked = spark.range(10_001).select(F.col("id").alias("query_id"), F.array(F.col("id") % 2 + F.lit(0.5), F.lit(1.0)).cast("array<float>").alias("vector"))
    found = search.nearest(vectors, asked, 1)
    assert found.count() == 10_001 and found.where((F.col("query_id") % 2 == 1) != (F.col("doc_id") == "x")).count() == 0
    few = asked.where("query_id < 50")
    assert sorted(search.nearest(vectors, few, 2, block_queries=7).collect()) == sorted(search.nearest(vectors, few, 2).collect())


def test_registry():
    @registry.operator("test.add")
    def add(a, b, c=0):
        return a + b + c

    assert list(registry.discover(["test\\..*"])) == ["test.add"] and registry.discover(["test"]) == {}
    assert registry.call("test.add", {"a": 1, "b": 2, "other": 9}, c=3) == 6
    with pytest.raises(TypeError, match="missing"):
        registry.call("test.add", {"a": 1})
    assert registry.EngineConfig.from_environment({"DOCWEAVE_PAGES_PER_BATCH": "7"}).pages_per_batch == 7


def test_tasks(spark):
    table = spark.createDataFrame([], tasks.SCHEMA)
    table = tasks.create(table, spark.createDataFrame([("t1", "translate", "{}"), ("t2", "ping", "{}")], "id string, name string, args string"))
    change = spark.createDataFrame([("t1", "DONE", "3", None, 1.0, None)], "id string, state string, result string, error string, progress double, completed_at timestamp")
    table = tasks.update(table, change)
    again = tasks.update(table, change.withColumn("result", F.lit("4")))
    assert {r.id: (r.state, r.result) for r in again.collect()} == {"t1": ("DONE", "3"), "t2": ("CREATED", None)}
    assert [r.id for r in tasks.pending(again).collect()] == ["t2"]
