"""Equality of words and texts, row numbers, and columns whose names clash with inner ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import bpe, languages, line_runs, minhash, neighbours, phrase_index, quality, queries, rolling, suffix_array, suffix_trees, toxicity
from docweave.llm.common import with_row_id

DATA = "/root/testdata/sf0.001"


def thue_morse(n, zero="a", one="b"):
    return "".join((zero, one)[bin(i).count("1") % 2] for i in range(n))


def test_words_that_polynomials_confuse(spark):
    """Polynomials modulo 2**64 take these two words for one."""
    x, y = thue_morse(2048), thue_morse(2048, "b", "a")
    docs = spark.createDataFrame([(1, x), (2, y)], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()} == {1: 1, 2: 2}
    around = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"{around} {x} {around}"), (2, f"{around} {y} {around}")], "doc_id long, text string")
    assert [r.n_removed for r in suffix_trees.dedup_words(docs).collect()] == [0, 0]
    docs = spark.createDataFrame([(1, x), (2, y[512:1536])], "doc_id long, text string")
    assert sum(r.n_removed for r in suffix_array.dedup_bytes(docs, length=1000).collect()) <= 3072


def test_names_of_words_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(rolling, "word_hashes", lambda data, starts, ends, salt=0: (ends - starts).astype(np.uint64))
    data = np.frombuffer(b"ab cd ab c", np.uint8)
    starts, ends, _ = rolling.words(data, np.array([0, len(data)]))
    assert suffix_trees.exact_names(data, starts, ends).tolist() == [0, 1, 0, 2]


def test_row_numbers_differ_and_stay(spark, tmp_path):
    spark.range(500).repartition(7).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    once = {r.id: r.rid for r in with_row_id(table).collect()}
    assert len(set(once.values())) == 500
    assert {r.id: r.rid for r in with_row_id(table.where("id % 3 = 0")).repartition(3).collect()}.items() <= once.items()
    twice = with_row_id(table.withColumn("e", F.explode(F.array(F.lit(1), F.lit(2)))))
    assert len({r.rid for r in twice.collect()}) == 1000


CLASHES = ["__rid", "__gone", "__c", "__w", "__hits", "_metadata", "__path", "rid", "h", "n", "band", "node"]


@pytest.fixture(scope="module")
def clashing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clash") / "documents")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs.select("*", *(F.concat(F.lit("own"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES)).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def kept_as_they_were(rows):
    assert rows
    for r in rows:
        for c in CLASHES:
            assert r[c] == f"own{r.doc_id}", c


@pytest.mark.parametrize("keeps", [
    lambda d, s: line_runs.dedup_line_runs(d),
    lambda d, s: minhash.one_of_each(d),
    lambda d, s: phrase_index.find_phrases(d, s.read.parquet(f"{DATA}/benchmark.parquet")),
    lambda d, s: toxicity.without_toxic(d, toxicity.fit(d, s.read.parquet(f"{DATA}/labels.parquet"))),
])
def test_own_columns_are_kept(spark, clashing, keeps):
    kept_as_they_were(keeps(clashing, spark).collect())


@pytest.mark.parametrize("run", [
    lambda d, s: suffix_trees.dedup_words(d, keep_text=False),
    lambda d, s: suffix_array.dedup_bytes(d, keep_text=False),
    lambda d, s: minhash.near_duplicates(d),
    lambda d, s: bpe.encode_documents(d, queries.vocabulary_path(), keep_text=False),
    lambda d, s: languages.held_out_languages(d),
    lambda d, s: quality.held_out_scores(d, s.read.parquet(f"{DATA}/labels.parquet")),
    lambda d, s: toxicity.held_out_scores(d, s.read.parquet(f"{DATA}/labels.parquet")),
    lambda d, s: phrase_index.find_near(d, s.read.parquet(f"{DATA}/benchmark.parquet")),
])
def test_clashing_columns_are_not_read(spark, clashing, run):
    run(clashing, spark).collect()


@pytest.mark.parametrize("operator", [suffix_trees.dedup_words, suffix_array.dedup_bytes])
def test_a_text_of_megabytes(spark, operator):
    r = np.random.default_rng(1)
    words = np.array([f"word{i}" for i in range(50_000)])
    text = " ".join(words[r.integers(0, len(words), 600_000)])
    passage = " ".join(f"passage{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"{text} {passage} end"), (2, f"start {passage}"), (3, "short")], "doc_id long, text string")
    got = {x.doc_id: x.n_removed for x in operator(docs, keep_text=False).collect()}
    most = 60 if operator is suffix_trees.dedup_words else len(passage) + 1
    assert most - 1 <= got[1] <= most and most - 1 <= got[2] <= most and got[3] == 0


def test_neighbours_of_one_vector(spark):
    assert neighbours.nearest(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>"), spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")).count() == 0
