"""Both substring operators against brute force."""

import hashlib
import random
import re

import pytest

from docweave.llm.suffix_array import dedup_bytes
from docweave.llm.suffix_trees import dedup_words, prefix_parts

DATA = "/root/testdata/sf0.001"


def brute(sequences, length):
    seen = {}
    for s in sequences:
        for i in range(len(s) - length + 1):
            w = tuple(s[i : i + length])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            if seen[tuple(s[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


def planted(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{r.randint(0, 400)}" for _ in range(400)] + ["é", "日本", "a"]
    passages = [" ".join(r.choices(vocabulary, k=r.randint(5, 60))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [r.choice(passages) if r.random() < 0.5 else " ".join(r.choices(vocabulary, k=r.randint(0, 30))) for _ in range(r.randint(1, 5))]
        texts.append(r.choice(["\n", " ", "\t "]).join(parts))
    near = texts[3].split()
    near[len(near) // 2 : len(near) // 2 + 1] = ["changed"]
    return [*texts, texts[0], texts[0], " ".join(near), "", None, "x", "a " * 500, "same same " * 120, "z" * 900]


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "kept", i) for i, t in enumerate(texts)], "doc_id long, text string, rid string, h long")


@pytest.mark.parametrize(("seed", "hot"), [(1, 20_000), (2, 20_000), (3, 3)])
def test_words(spark, seed, hot):
    texts = planted(seed)
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    got = {r.doc_id: r for r in dedup_words(rows(spark, texts), length=12, k=4, hot=hot).collect()}
    assert len(got) == len(texts)
    for i, (words, gone) in enumerate(zip(split, brute(split, 12), strict=True)):
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (len(words), sum(gone), kept)
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize(("seed", "block", "hot"), [(1, 10, 20_000), (2, 20, 20_000), (3, 40, 20_000), (4, 5, 3)])
def test_bytes(spark, seed, block, hot):
    texts = planted(seed)
    data = [(t or "").encode() for t in texts]
    got = {r.doc_id: r for r in dedup_bytes(rows(spark, texts), length=40, k=8, block=block, block_bytes=2000, hot=hot).collect()}
    assert len(got) == len(texts)
    for i, (whole, gone) in enumerate(zip(data, brute(data, 40), strict=True)):
        kept = bytes(b for b, g in zip(whole, gone, strict=True) if not g)
        spans = len(re.findall("1+", "".join("01"[g] for g in gone)))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(whole), sum(gone), spans)
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts.items()}
    expected = dict(zip(split, brute(split.values(), 35), strict=True))
    got = {r.doc_id: r.n_removed for r in dedup_words(docs).collect()}
    assert got == {i: sum(g) for i, g in expected.items()}
    assert sum(got.values()) > 0


def test_empty_table_and_repeated_row(spark):
    assert dedup_words(rows(spark, [])).count() == 0
    assert dedup_bytes(rows(spark, [])).count() == 0
    same = spark.createDataFrame([(1, "b" * 250), (1, "b" * 250), (2, "c" * 150)], "doc_id long, text string")
    assert sorted(r.n_removed for r in dedup_bytes(same).collect()) == [0, 250, 250]


def test_parts_hold_equal_prefixes():
    import numpy as np

    r = np.random.default_rng(1)
    names = r.integers(0, 3, 500)
    suffix = np.arange(480)
    parts = list(prefix_parts(names, suffix, 10, 20))
    assert sorted(np.concatenate(parts)) == list(range(480))
    home = {}
    for p, part in enumerate(parts):
        for i in part:
            assert home.setdefault(tuple(names[i : i + 10]), p) == p


def joined_contexts(df):
    """Rows made by the join of contexts with what repeats of them, in the plan that ran."""
    made, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif "QueryStage" in kind:
            plans.append(plan.plan())
        else:
            if "Join" in kind and "ctx#" in plan.simpleString(100):
                made.append(plan.metrics().apply("numOutputRows").value())
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return made


@pytest.mark.parametrize("words", [True, False])
@pytest.mark.parametrize("hot", [3, 20_000])
def test_contexts_are_joined_once(spark, words, hot):
    from docweave.llm import anchors, suffix_array, suffix_trees
    from docweave.llm.common import with_row_id

    r = random.Random(5)
    unit = (lambda n: [f"w{r.randint(0, 10**6)}" for _ in range(n)]) if words else (lambda n: r.choices("abcdefgh", k=n))
    passage, space = unit(60), " " if words else ""
    # many copies of the passage; some texts share a part of it, so that its anchors have several contents
    sequences = [passage] * 40 + [passage[:45] + unit(20) for _ in range(4)] + [unit(20) + passage[20:] for _ in range(4)] + [unit(60)]
    # one unit changed amid a longer copy: a content with two runs of repeated windows
    spoiled = passage[:15] + unit(1) + passage[16:]
    docs = rows(spark, [space.join(s) for s in [*sequences, spoiled]])
    units = anchors.Units(20, 4, words)
    index = (lambda c: suffix_trees.repeated_windows(c, 20)) if words else (lambda c: suffix_array.repeated_windows(c, 20, 10))
    places = with_row_id(docs.select("text")).mapInArrow(lambda it: anchors._contexts(it, units), anchors._CONTEXTS).count()
    _, ranges = anchors.find_repeats(docs, units, index, 1 << 20, hot)
    assert ranges.collect()
    assert 0 < sum(joined_contexts(ranges)) <= places
