"""Classifiers on held-out labels, their parts against plain computations, and edge cases."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from docweave.llm import languages, quality, toxicity
from docweave.llm.common import fold
from docweave.llm.queries import op3_toxicity, op4_quality, op7_languages
from docweave.llm.samples import labelled_sample

DATA = "/root/testdata/sf0.01"
EDGES = [(1, None), (2, ""), (3, "   \n"), (4, "123 !!"), (5, "word"), (5, "word"), (6, "very long " * 30_000)]


def auc(rows):
    order = sorted(rows)
    ranks, i = {}, 0
    while i < len(order):
        j = i
        while j < len(order) and order[j][0] == order[i][0]:
            j += 1
        ranks[order[i][0]] = (i + j + 1) / 2
        i = j
    good = [s for s, y in rows if y]
    return (sum(ranks[s] for s in good) - len(good) * (len(good) + 1) / 2) / (len(good) * (len(rows) - len(good)))


def edges(spark):
    return spark.createDataFrame([(*e, "x", 1) for e in EDGES], "doc_id long, text string, score string, predicted int")


@pytest.mark.parametrize(("query", "label", "mod", "rest", "threshold", "least"), [(op3_toxicity, "toxic", 3, 1, 0.7, 0.9), (op4_quality, "quality", 5, 0, 0.3, 0.85)])
def test_held_out(spark, query, label, mod, rest, threshold, least):
    got = query(spark, DATA)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    assert got.count() == docs.count()
    assert got.where((F.col("held_out") != (fold(F.col("doc_id"), mod) == rest)) | (F.col("predicted") != (F.col("score") >= threshold).cast("int")) | ~F.col("score").between(0, 1)).count() == 0
    rows = [(r.score, r.y) for r in got.where("held_out").join(labels.select("doc_id", F.col(label).alias("y")), "doc_id").collect()]
    assert auc(rows) >= least


def test_languages_held_out(spark):
    got = op7_languages(spark, DATA).where("held_out").join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    docs = spark.createDataFrame([(i, ("good fine words here " if i % 2 else "BAD!! AWFUL!! ") * 20, "en" if i % 2 else "de") for i in range(80)], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (1 - F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = quality.fit(docs, labels)
    found = quality.score_documents(edges(spark), model).collect()
    assert len(found) == len(EDGES) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1 and len({r.score for r in found if r.doc_id == 5}) == 1
    votes = toxicity.fit(docs, labels, terms=50)
    found = toxicity.score_documents(edges(spark), votes, evidence=True).collect()
    assert len(found) == len(EDGES) and all(0 <= r.score <= 1 for r in found)
    bad = toxicity.score_documents(docs.where("doc_id < 2"), votes, evidence=True).orderBy("doc_id").collect()
    assert bad[0].score > 0.7 > bad[1].score and all(e.label == 1 for e in bad[0].evidence)
    field = languages.fit(docs)
    found = {r.doc_id: r for r in languages.identify(edges(spark), field).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and found[5].lang_pred in ("de", "en")


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score_documents(docs, quality.fit(docs, none)).collect()[0].score == 0.5
    assert toxicity.score_documents(docs, toxicity.fit(docs, none)).collect()[0].score == 0.5
    assert languages.identify(docs, languages.fit(docs)).collect()[0].lang_pred == "und"
    assert quality.score_documents(docs.where("false"), quality.fit(docs, none)).count() == 0
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.score_documents(docs, quality.fit(docs, one)).count() == 1
    assert toxicity.score_documents(docs, toxicity.fit(docs, one)).count() == 1


def test_shares_are_of_all_labels(spark):
    """A capped sample has the priors and class weights of all labelled rows."""
    docs = spark.createDataFrame([(i, ("good fine words here " if i % 10 else "BAD!! AWFUL!! ") * 20 + f"w{i % 7}") for i in range(400)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 10 > 0).cast("int").alias("quality"), (F.col("doc_id") % 10 == 0).cast("int").alias("toxic"))
    labels = labels.union(labels)
    for most in (20, 1000):
        assert abs(quality.fit(docs, labels, per_class=most).prior - 361 / 402) < 1e-9
        assert abs(toxicity.fit(docs, labels, per_class=most, terms=50).prior - 41 / 402) < 1e-9
    empty = docs.withColumn("text", F.lit("123"))
    found = [toxicity.score_documents(empty, toxicity.fit(docs, labels, per_class=most, terms=50)).first().score for most in (20, 1000)]
    assert all(s < 0.5 for s in found)


def test_small_classes_are_learned_whole():
    """A class with less text than ten dictionaries is trained on; without training all its texts give a piece."""
    r = random.Random(3)
    texts = [" ".join(r.choices(["alpha", "beta", "gamma", "delta", "epsilon", "zeta"], k=80)).encode() + f" only{i}".encode() * 3 for i in range(300)]
    found = quality._dictionary(texts, 20_000, 3)
    assert found[:4] == b"\x37\xa4\x30\xec" and len(found) <= 20_000
    few = [bytes([97 + i]) * (10 if i % 2 else 500) for i in range(6)]
    made = quality._dictionary(few, 600, 3)
    assert len(made) <= 600 and all(made.count(bytes([97 + i])) >= 10 for i in range(6))
    assert quality._dictionary([], 600, 3) == quality._dictionary([b""], 600, 3) == b"no sample of this class"


def test_nearest_examples_are_exact():
    r = random.Random(2)
    terms = [f"t{i}" for i in range(30)]
    examples = [Counter(r.choices(terms, k=r.randint(1, 12))) for _ in range(300)]
    idf = {t: 1 + r.random() for t in terms}
    index = toxicity.BlockMaxIndex(examples, [0] * 300, list(range(300)), idf, block=16)

    def cosine(a, b):
        w = [{t: (1 + math.log(c)) * idf[t] for t, c in x.items()} for x in (a, b)]
        return sum(w[0][t] * w[1].get(t, 0) for t in w[0]) / math.sqrt(sum(v * v for v in w[0].values()) * sum(v * v for v in w[1].values()))

    for _ in range(40):
        asked = Counter(r.choices(terms, k=r.randint(1, 10)))
        near, found = index.nearest(*index.vector(asked), 7)
        best = sorted((cosine(asked, e) for e in examples), reverse=True)[:7]
        assert np.allclose(found, [b for b in best if b > 0][: len(found)], atol=1e-5) and len(found) == sum(b > 0 for b in best)
        assert np.allclose([cosine(asked, examples[i]) for i in near], found, atol=1e-5)


def test_forward_backward():
    r = np.random.default_rng(0)
    emissions, moves, borders = r.normal(size=(333, 3)), r.normal(size=(3, 3)), np.array([0, 0, 1, 50, 50, 333])
    got = languages.marginals(emissions, moves, borders, 7)[0]
    for a, z in zip(borders[:-1], borders[1:], strict=True):
        n = z - a
        if n:
            forward, back = np.zeros((n, 3)), np.ones((n, 3))
            forward[0] = np.exp(emissions[a])
            for i in range(1, n):
                forward[i] = (forward[i - 1] @ np.exp(moves)) * np.exp(emissions[a + i])
                forward[i] /= forward[i].sum()
            for i in range(n - 2, -1, -1):
                back[i] = np.exp(moves) @ (np.exp(emissions[a + i + 1]) * back[i + 1])
                back[i] /= back[i].sum()
            both = forward * back
            assert np.allclose(both / both.sum(1, keepdims=True), got[a:z])


def test_code_switching():
    field = languages.LanguageField(["de", "en"], 1 << 12)
    field.train(["der die und nicht eine zu", "the and of with this from"] * 20, [0, 1] * 20)
    found, size, _ = field.label_words(languages.lowered(pa.array(["the and of und nicht eine der"])))
    assert [int(p.argmax()) for p in found] == [1, 1, 1, 0, 0, 0, 0]


def test_quality_plainly(spark):
    """Scores from two compressors made on the spot."""
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.fit(docs, labels)
    got = {(r.doc_id, r.score) for r in quality.score_documents(docs, model).collect()}
    expected = set()
    for r in docs.collect():
        data = (r.text or "").encode()
        sizes = [len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False).compress(data)) for d in (model.bad, model.good)]
        x = model.slope * (sizes[0] - sizes[1]) / (len(data) + 16) + model.shift
        expected.add((r.doc_id, round(1 / (1 + math.exp(-x)) if data.strip() else model.prior, 9)))
    assert {(i, round(x, 9)) for i, x in got} == expected


def test_sample_is_drawn_among_short_texts(spark):
    docs = spark.createDataFrame([(i, "x" * (50 if i % 2 else 5)) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 4 // 2) for i in range(40)], "doc_id long, toxic int")
    rows, counts = labelled_sample(docs, labels, "toxic", 6, 10)
    assert sorted(y for _, y in rows) == [0] * 6 + [1] * 6 and counts == {0: 20, 1: 20}
