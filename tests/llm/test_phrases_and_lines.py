import hashlib
import random
import re

from pyspark.sql import functions as F

from docweave.llm.line_runs import dedup_line_runs
from docweave.llm.phrase_index import find_near, find_phrases

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_phrases(docs, items, length):
    windows = {}
    for item, text in items:
        w = tokens(text)
        for i in range(max(1, len(w) - length + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + length]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for doc_id, text in docs:
        w, hit, found = tokens(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= names
        out[doc_id] = (len(w), len(hit), sorted(found))
    return out


def check_phrases(spark, docs, items, length):
    expected = brute_phrases(docs, items, length)
    got = find_phrases(spark.createDataFrame(docs, "doc_id long, text string").withColumn("rid", F.lit("x")), spark.createDataFrame(items, "item_id long, text string"), length)
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got.collect()} == expected
    return expected


def test_phrases_small(spark):
    r = random.Random(5)
    vocabulary = ["a", "B", "c1", "é", "the", "THE", "of", "日本"]
    docs = [(i, " ".join(r.choices(vocabulary, k=r.randint(0, 60)))) for i in range(50)] + [(100, None), (101, ""), (102, "...")]
    items = [(i, ", ".join(r.choices(vocabulary, k=r.randint(0, 9)))) for i in range(40)] + [(90, None), (91, "unseen words only"), (92, "a")]
    found = check_phrases(spark, docs, items, 4)
    assert any(x[1] for x in found.values()) and any(not x[1] for x in found.values())


def test_phrases_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    found = check_phrases(spark, docs, items, 10)
    assert any(x[1] for x in found.values())


def test_phrases_empty(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in find_phrases(docs, none).collect()] == [0]
    assert find_phrases(docs.where("false"), none).count() == 0


def test_near(spark):
    docs = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "alpha x x x x x x x x x x beta"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("q", "alpha beta gamma")], "item_id string, text string")
    assert {r.doc_id for r in find_near(docs, items, 3, 2).collect()} == {1}


def test_near_against_brute_force(spark):
    """A match has the two rarest terms of a window as far apart as in it, give or take the slop."""
    r = random.Random(11)
    vocabulary = [f"t{i}" for i in range(40)]
    docs = [(i, " ".join(r.choices(vocabulary, k=r.randint(0, 50)))) for i in range(60)]
    items = [(i, " ".join(r.sample(vocabulary, k=r.randint(2, 6)))) for i in range(30)]
    counts = {t: sum(tokens(d).count(t) for _, d in docs) for t in vocabulary}
    expected = set()
    for _, item in items:
        w = tokens(item)
        for window in {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))}:
            (_, k1, x), (_, k2, y) = sorted((counts[t], k, t) for k, t in enumerate(window))[:2]
            for doc_id, text in docs:
                at = tokens(text)
                starts = [[p - k for p, t in enumerate(at) if t == term] for k, term in ((k1, x), (k2, y))]
                if any(abs(a - b) <= 2 for a in starts[0] for b in starts[1]):
                    expected.add((doc_id, window))
    got = find_near(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 4, 2).collect()
    assert {(x.doc_id, tuple(x.words)) for x in got} == expected and len(got) == len(expected) > 20


def brute_lines(docs, min_lines, min_chars=250):
    first, alone, places = {}, {}, []
    for doc_id, text in sorted((d for d in docs if d[1] is not None)):
        lines = text.split("\n")
        content = [i for i, x in enumerate(lines) if x.strip()]
        for j in range(len(content) - min_lines + 1):
            first.setdefault(tuple(lines[i] for i in content[j : j + min_lines]), (doc_id, j))
        for i in content:
            alone.setdefault(lines[i], (doc_id, i))
        places.append((doc_id, lines, content))
    out = {d[0]: (None, 0, 0) for d in docs}
    for doc_id, lines, content in places:
        gone = set()
        for j in range(len(content) - min_lines + 1):
            if first[tuple(lines[i] for i in content[j : j + min_lines])] != (doc_id, j):
                gone.update(content[j : j + min_lines])
        gone.update(i for i in content if len(lines[i]) >= min_chars and alone[lines[i]] != (doc_id, i))
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(content), len(gone))
    return out


def test_lines(spark):
    r = random.Random(9)
    for min_lines in (1, 2, 3, 5):
        pool = [f"line {i}" for i in range(12)] + ["", "  ", "é", "long " * 50, "longer " * 40]
        docs = [(i, "\n".join(r.choices(pool, k=r.randint(0, 14)))) for i in range(40)] + [(90, None), (91, ""), (92, "\n\n"), (93, "a\na\na\na\na\na")]
        frame = spark.createDataFrame([(*d, "kept", 7) for d in docs], "doc_id long, text string, rid string, key int")
        got = dedup_line_runs(frame, min_lines)
        assert got.columns == ["doc_id", "text", "rid", "key", "n_lines", "n_removed"]
        assert {x.doc_id: (x.text, x.n_lines, x.n_removed) for x in got.collect()} == brute_lines(docs, min_lines)
    assert dedup_line_runs(frame.where("false")).count() == 0
    same = spark.createDataFrame([(1, "x\ny"), (1, "x\ny")], "doc_id long, text string")
    assert sorted(x.text for x in dedup_line_runs(same).collect()) == ["", "x\ny"]


def test_digest_of_items(spark):
    from docweave.llm.queries import op6_phrase_index

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    expected = brute_phrases(docs, items, 10)
    for r in op6_phrase_index(spark, DATA).collect():
        n_words, n_hit, found = expected[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n_words, n_hit, len(found), n_hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
