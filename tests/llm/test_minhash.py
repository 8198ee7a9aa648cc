import random
import re
from collections import Counter

import numpy as np

from docweave.llm.minhash import components, near_duplicates, signatures

DATA = "/root/testdata/sf0.001"


def bag(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def brute_classes(docs, similarity=0.8):
    bags = [(d, bag(t)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, p) in enumerate(bags):
        for b, q in bags[:i]:
            total = sum((p | q).values())
            if total and sum((p & q).values()) / total >= similarity:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in parent}


def classes(spark, docs):
    frame = spark.createDataFrame([(*d, "kept") for d in docs], "doc_id long, text string, rid string")
    got = near_duplicates(frame).collect()
    assert len(got) == len(docs)
    assert Counter(r.class_id for r in got if r.keeps) == Counter(set(r.class_id for r in got))
    return {r.doc_id: r.class_id for r in got}


def test_small(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for group in range(12):
        base = r.choices(words, k=r.randint(20, 120))
        for _ in range(r.randint(1, 8)):
            copy = list(base)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(words)
            docs.append((len(docs), " ".join(copy)))
        docs.append((len(docs), " ".join(base)))
        docs.append((len(docs), "\n".join(base)))
    docs += [(900, None), (901, ""), (902, "  "), (903, "two words"), (904, "two  words"), (905, "a " * 800), (906, "a " * 700)]
    expected = brute_classes(docs)
    assert classes(spark, docs) == expected
    assert expected[904] == 903 and expected[906] == 905 and expected[901] == 901


def test_chain_needs_blocks(spark):
    """Neighbours of a chain are near, its ends are not, and all may share buckets."""
    words = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join([f"x{i}_{j}" if i * 4 <= j < 0 else w for j, w in enumerate(words[:100])] if i == 0 else [f"y{j}" if j < i * 3 else w for j, w in enumerate(words[:100])])) for i in range(12)]
    assert classes(spark, docs) == brute_classes(docs)


def test_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    expected = brute_classes(docs)
    assert len(set(expected.values())) < len(docs)
    assert {r.doc_id: r.class_id for r in near_duplicates(spark.read.parquet(f"{DATA}/documents.parquet")).collect()} == expected


def test_empty_and_repeated(spark):
    frame = spark.createDataFrame([(1, "one two three four five six"), (1, "one two three four five six")], "doc_id long, text string")
    assert near_duplicates(frame.where("false")).count() == 0
    assert sorted(r.keeps for r in near_duplicates(frame).collect()) == [False, True]


def test_signatures_are_unbiased():
    r = np.random.default_rng(1)
    for a, b in (([1, 1, 1, 5, 2], [1, 1, 3, 2, 2]), ([9, 1], [3, 1])):
        a, b, agree = np.array(a), np.array(b), []
        for _ in range(200):
            h = r.integers(0, 2**63, len(a), dtype=np.uint64)
            s = signatures(np.r_[np.zeros(len(a), int), np.ones(len(b), int)], np.r_[h, h], np.r_[a, b], 2, 64)
            agree.append((s[0] == s[1]).mean())
        assert abs(np.mean(agree) - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.02


def test_components(spark, tmp_path):
    links = [(i, i + 1) for i in range(20)] + [(100, 200), (300, 100)]
    got = components(spark.createDataFrame(links, "x long, y long"), str(tmp_path))
    assert {r.node: r.least for r in got.collect()} == {i: 0 for i in range(21)} | {100: 100, 200: 100, 300: 100}
