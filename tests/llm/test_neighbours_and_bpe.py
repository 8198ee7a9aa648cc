import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from docweave.llm.bpe import TokenAutomaton, decode_ids, encode_documents, tokenizer
from docweave.llm.neighbours import fit, nearest, perturbed

DATA = "/root/testdata/sf0.1"
PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", "   ", "it's İstanbul ΣΑΣ ΟΔΟΣ", "x<|endoftext|>y <|startoftext|><|endoftext|>", "日本語テキスト 12345 🙂🙂 ½ ²", "é ẛ̣ Å a\x00b", "!!!!!!!!????....,,,,", "'s't're'll'S'LL", "mississippi " * 50,
    "a" * 5000, "İ" * 10, "a\x1cb \x1d\x1e c\x85d\xa0e f​g", "ﬁ ẞ ǅ 힣", "long text " * 40_000,
]


def test_bpe_equals_library(spark):
    library = Tokenizer.from_file(PATH)
    table = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = TEXTS + table
    frame = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in encode_documents(frame, PATH).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (got[i].ids, got[i].decoded, got[i].n_tokens) == (" ".join(map(str, ids)), decoded, len(ids)), t
        assert got[i].ids_sha256 == hashlib.sha256(got[i].ids.encode()).hexdigest()
    assert encode_documents(frame.where("false"), PATH).count() == 0
    assert decode_ids(PATH, map(int, got[3].ids.split())) == got[3].decoded


def test_automaton_has_one_path():
    """On random merges, the only path equals merging by rank."""
    r = random.Random(4)
    for _ in range(30):
        merges, known = [], ["a", "b", "c", "a.", "b.", "c."]
        while len(merges) < 25:
            u, v = r.choice([k for k in known if not k.endswith(".")]), r.choice(known)
            if u + v not in known:
                merges.append((u, v))
                known.append(u + v)
        automaton = TokenAutomaton(["a", "b", "c", "a.", "b.", "c."], merges, ".")
        rank = {m: i for i, m in enumerate(merges)}
        for _ in range(60):
            word = "".join(r.choices("abc", k=r.randint(1, 12)))
            parts = [*word[:-1], word[-1] + "."]
            while len(parts) > 1:
                best = min(range(len(parts) - 1), key=lambda i: (rank.get((parts[i], parts[i + 1]), 999), i))
                if (parts[best], parts[best + 1]) not in rank:
                    break
                parts[best : best + 2] = ["".join(parts[best : best + 2])]
            assert [automaton.label[x] for x in automaton.encode(word)] == parts


def test_long_word_stays_linear():
    assert len(tokenizer(PATH).encode("ab" * 100_000)[1].split()) > 1


def brute(vectors, asked, k):
    usable = {i: np.array(v, float) for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in asked:
        if q in usable:
            scores = sorted(((-float(usable[q] @ v), i) for i, v in usable.items() if i != q))[:k]
            out[q] = [i for _, i in scores]
    return out


def test_recall(spark):
    vectors = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    expected = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = {}
    for r in nearest(vectors, vectors.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.rank == len(got[r.query_id])
    assert all(len(v) == 20 for v in got.values()) and set(got) == set(expected)
    assert np.mean([len(set(got[q]) & set(expected[q])) / 20 for q in expected]) >= 0.9


def test_neighbour_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.9, 0.1]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [float("inf"), 1.0]), (9, [-1.0, 0.0]), (9, [-1.0, 0.0]), (None, [1.0, 1.0]), (10, [5.0, 0.0])]
    frame = spark.createDataFrame([(*r, "kept") for r in rows], "vec_id long, embedding array<float>, score string")
    got = {}
    for r in nearest(frame, frame, 3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {1: [10, 2, 3], 2: [10, 1, 3], 3: [10, 1, 2], 9: [2, 3, 1], 10: [1, 2, 3]}
    assert nearest(frame.where("false"), frame, 3).count() == 0 and nearest(frame, frame.where("false"), 3).count() == 0


def test_large_buckets_are_salted(spark):
    r = np.random.default_rng(3)
    rows = [(i, [1.0, *(0.001 * r.normal(size=7)).tolist()]) for i in range(300)] + [(1000 + i, r.normal(size=8).tolist()) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = [i for i, _ in rows if i % 50 == 0]
    expected = brute(rows, asked, 5)
    got = {}
    for x in nearest(frame, frame.where("vec_id % 50 = 0"), 5, tables=3, bits=4, block_rows=40).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.vec_id)
    assert np.mean([len(set(got[q]) & set(expected[q])) / 5 for q in expected]) >= 0.9


def test_probes_come_nearest_first():
    """The generated buckets are those of least distance among all with steps of one slot."""
    x = np.random.default_rng(2).uniform(-3, 3, size=(5, 4))
    found = perturbed(x, 30)
    for q in range(5):
        base = np.floor(x[q])
        every = [base + np.array(m) for m in itertools.product((-1, 0, 1), repeat=4)]
        cost = lambda slots: sum(max(0.0, s - y, y - s - 1) ** 2 for s, y in zip(slots, x[q], strict=True))  # noqa: B023, E731
        assert np.allclose([cost(s) for s in found[q]], sorted(map(cost, every))[:30])
        assert len({tuple(s) for s in found[q]}) == 30


def test_copies_take_one_place(spark):
    """Rows of one vec_id, more than k and alike or not, leave the other places to other ids."""
    rows = [(1, [1.0, 0.0])] + [(2, [5.0, 0.0])] * 30 + [(3, [4.0, 0.001 * i]) for i in range(30)] + [(10 + i, [2.0 - 0.1 * i, 1.0]) for i in range(10)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id) for r in nearest(frame, frame.where("vec_id = 1"), 5).orderBy("rank").collect()]
    assert got == list(enumerate([2, 3, 10, 11, 12], 1))


def test_random_vectors(spark):
    """Vectors without clusters are the hardest to probe for."""
    r = np.random.default_rng(8)
    rows = [(i, r.normal(size=64).tolist()) for i in range(2100)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = brute(rows, [i for i, _ in rows if i % 50 == 0], 20)
    got = {}
    for x in nearest(frame, frame.where("vec_id % 50 = 0"), 20).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.vec_id)
    assert set(got) == set(expected) and np.mean([len(set(got[q]) & set(expected[q])) / 20 for q in expected]) >= 0.9


def test_clusters_are_probed(spark, monkeypatch):
    """Near vectors that lie close together are found among a fifth of all."""
    r = np.random.default_rng(6)
    centres = 10 * r.normal(size=(60, 16))
    vectors = centres[np.arange(2400) % 60] + 0.05 * r.normal(size=(2400, 16))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    rows = list(enumerate(vectors.tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    made = []
    monkeypatch.setattr("docweave.llm.neighbours.fit", lambda *a, f=fit: made.append(f(*a)) or made[-1])
    expected, got = brute(rows, [i for i, _ in rows if i % 100 == 0], 10), {}
    for x in nearest(frame, frame.where("vec_id % 100 = 0"), 10).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.vec_id)
    home, visits = made[0].buckets(vectors), made[0].visited(vectors[::100])
    seen = [set().union(*(np.flatnonzero(np.isin(home[:, t], visits[q, t])).tolist() for t in range(6))) for q in range(len(visits))]
    assert np.mean([len(x) for x in seen]) < 0.2 * len(rows)
    assert np.mean([len(set(got[q]) & set(expected[q])) / 10 for q in expected]) >= 0.9
