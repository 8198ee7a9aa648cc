"""Updates in order, joins by place, error rows, staged models and their number of calls."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docweave.functions import forms, media, values
from docweave.operators import predicates, regroup, upsert
from docweave.plans import pipelines, plugins, preprocessing


def test_updates_of_one_document_are_applied_in_order(spark):
    docs = spark.createDataFrame([("a", "x", ["t"]), ("b", "y", None)], "id string, content string, tags array<string>")
    texts = spark.createDataFrame([("a", 2, "last"), ("a", 1, "first")], "id string, at int, content string")
    assert {r.id: r.content for r in upsert.update_content(docs, texts, order="at").collect()} == {"a": "last", "b": "y"}
    tags = spark.createDataFrame([("a", "u"), ("a", "t"), ("a", "u"), ("b", "v")], "id string, tag string")
    out = {r.id: r.tags for r in upsert.add_tags(docs, tags).collect()}
    assert out == {"a": ["t", "u"], "b": ["v"]}


def test_places_must_meet(spark):
    left = spark.createDataFrame([(0, 0, "a"), (0, 1, "b")], "batch int, pos int, doc string")
    good = spark.createDataFrame([(0, 1, "B"), (0, 0, "A")], "batch int, pos int, found string")
    assert sorted((r.doc, r.found) for r in regroup.zip_results(left, good, ["batch", "pos"]).collect()) == [("a", "A"), ("b", "B")]
    for bad in (good.limit(1), good.union(good.limit(1)), good.withColumn("pos", F.col("pos") + 1)):
        with pytest.raises(PySparkException):
            regroup.zip_results(left, bad, ["batch", "pos"]).collect()
    known = spark.createDataFrame([("a", 1)], "doc string, size int")
    assert regroup.require_keys(left.where("doc = 'a'"), known, "doc").count() == 1
    with pytest.raises(PySparkException):
        regroup.require_keys(left, known, "doc").collect()


def test_files_that_fail_are_rows(spark):
    files = spark.createDataFrame([("1", "image/png", bytearray(b"p\0q")), ("2", "audio/wav", bytearray(b"x")), ("3", "text/html", bytearray(b"")), ("4", "application/pdf", bytearray(b"one\ftwo")), ("5", "image/png", None)], "id string, content_type string, content binary")
    pages, errors = preprocessing.page_images(files, [".png", ".pdf"], [".html", ".pdf"])
    assert sorted((r.id, r.page_number, bytes(r.image)) for r in pages.collect()) == [("1", 1, b"p"), ("1", 2, b"q"), ("4", 1, b"one"), ("4", 2, b"two")]
    assert sorted((r.id, r.error.title) for r in errors.collect()) == [("2", "UnsupportedFile"), ("3", "ValueError"), ("5", "MissingContent")]


def test_media_types_from_a_table(tmp_path):
    table = tmp_path / "mime.types"
    table.write_text("application/x-made-up  madeup\n")
    assert media.types_of(".madeup", (str(table),)) == ["application/x-made-up"]
    with pytest.raises(ValueError):
        media.types_of(".madeup")


def test_transcription_stages(spark):
    audio = spark.createDataFrame([("a", bytearray(b"one\ntwo")), ("b", bytearray(b"\xff")), ("c", None), ("d", bytearray(b"x"))], "id string, content binary")
    found = {r.id: r for r in plugins.transcribe_with(audio, {"model": "SCRIPT"}, files_per_batch=2).collect()}
    assert [s.text for s in found["a"].segments] == ["one", "two"] and found["d"].error is None
    assert found["b"].error.title == "UnicodeDecodeError" and found["c"].error.title == "ValueError"


def test_models_run_once(spark):
    """All outputs of a dataflow read what its model gave, which is kept."""
    pages = spark.createDataFrame([(str(i), f"<p>{i}</p>", 1) for i in range(5)], "id string, html string, n_pages int")
    good, bad, report = pipelines.extract(pages)
    assert (good.count(), bad.count(), report.first().processed_docs) == (5, 0, 5)
    for df in (good, bad, report):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "InMemoryRelation" in plan


def test_forms():
    assert forms.camel("content_text_length") == "contentTextLength" and forms.camel("docs") == "docs"


def test_fields_of_plain_arrays(spark):
    df = spark.createDataFrame([("a", ["x"], 3)], "id string, tags array<string>, n int")
    assert predicates.search(df, {"term": {"tags.name": "x"}}).count() == 0
    assert predicates.search(df, {"term": {"tags": "x"}}).count() == 1


def test_progress_scale_is_checked():
    for start, end in ((-0.1, 0.5), (0.5, 0.5), (0.2, 1.1)):
        with pytest.raises(ValueError):
            values.progress_scaled(F.lit(0.5), start, end)
