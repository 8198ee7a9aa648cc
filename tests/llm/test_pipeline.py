"""The pipeline's stages, each against what its operator finds on its own input."""

import hashlib
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from docweave.llm import common
from docweave.llm.common import shared_folder, written
from tests.llm.test_minhash import brute_classes
from tests.llm.test_phrases_and_lines import brute_lines, brute_phrases

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    folder, docs = shared_folder(spark), spark.read.parquet(f"{DATA}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, DATA), name, folder)
        before, rows = texts, docs.collect()
        if name != "bpe":
            assert docs.columns == columns
            texts = {r.doc_id: r.text for r in rows}
            assert len(texts) == len(rows) and set(texts) <= set(before)
        if name == "toxicity":
            assert all(before[i] == t for i, t in texts.items()) and len(texts) < len(before)
        if name == "line_dedup":
            cut = brute_lines(list(before.items()), 2)
            assert texts == {i: t for i, (t, n, gone) in cut.items() if not gone or gone < n}
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "near_dedup":
            assert set(texts) == set(brute_classes(list(before.items())).values())
        if name == "decontamination":
            found = brute_phrases(list(before.items()), items, 10)
            assert set(texts) == {i for i, x in found.items() if not x[1]}
        if name == "bpe":
            library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            assert {r.doc_id for r in rows} == set(texts)
            for r in rows:
                ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
                assert (r.n_tokens, r.ids) == (len(ids), " ".join(map(str, ids)))
                assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_driver_gives_memory_back(spark, monkeypatch):
    """After a table is written the driver's JVM returns the native memory that it holds unused."""
    reports, give_back = [], common.give_back
    monkeypatch.setattr(common, "_given_back", -1e9)
    monkeypatch.setattr(common, "give_back", lambda s: reports.append(give_back(s)))
    for name in ("first", "second"):
        assert written(spark.range(3), name, f"{shared_folder(spark)}/given").count() == 3
    assert re.search(r"Trim native heap: RSS\+Swap: \w+->\w+", reports[0]), reports
    assert len(reports) == 2 and common._given_back > 0
