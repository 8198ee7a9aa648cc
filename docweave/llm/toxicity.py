"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The index holds a bounded sample of labelled texts.  Its terms are the words and word starts
whose document frequencies differ between the two labels (with all terms the nearest are texts of
the same topic, whatever their label: the README has the figures); postings are cut into blocks of
examples, each with the greatest weight of every term.  For a text the blocks are taken in the
order of their upper bounds until no other block can hold one of the k nearest, so the k nearest
are exact.  Their votes, weighted by distance, are calibrated to a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import fold, small_batches
from docweave.llm.samples import labelled_sample, logistic_fit, share_of

_WORD = re.compile(r"[^\W\d_]+")


def _terms(word: str, starts: tuple[int, ...]) -> list[str]:
    """A word and its starts of the given lengths, which also stand for its compounds."""
    return [word, *(f"{word[:n]}*" for n in starts if len(word) >= n)]


def log_likelihood(a: float, n1: int, b: float, n0: int) -> float:
    """How far the share of texts with a term differs between the labels (G squared)."""
    def part(k, n, p):
        return (k * math.log(k / (n * p)) if k else 0.0) + ((n - k) * math.log((n - k) / (n * (1 - p))) if n - k else 0.0)

    p = (a + b) / (n1 + n0)
    return 2 * (part(a, n1, p) + part(b, n0, p)) if 0 < p < 1 else 0.0


class BlockMaxIndex:
    """Inverted index over example texts with the greatest weight of each term in each block."""

    def __init__(self, examples: list[Counter], labels: list[int], ids: list[int], idf: dict[str, float], block: int = 64):
        self.names = sorted(idf)
        self.number = {t: i for i, t in enumerate(self.names)}
        self.idf = np.array([idf[t] for t in self.names])
        self.labels, self.ids, self.block = np.array(labels, np.int64), np.array(ids, np.int64), block
        n_blocks = max(1, -(-len(examples) // block))
        #: Weights by term, block and place; both the examples and the terms are bounded in number.
        self.weights = np.zeros((len(idf), n_blocks, block), np.float32)
        for i, counts in enumerate(examples):
            at, weight = self.vector(counts)
            self.weights[at, i // block, i % block] = weight
        self.greatest = self.weights.max(2) if len(idf) else np.zeros((0, n_blocks), np.float32)

    def vector(self, counts: dict) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and unit-length TF-IDF weights of the terms that the index knows."""
        at = np.array(sorted(self.number[t] for t in counts if t in self.number), np.int64)
        if not len(at):
            return at, np.zeros(0)
        weight = np.array([1 + math.log(counts[self.names[i]]) for i in at]) * self.idf[at]
        return at, weight / np.sqrt((weight**2).sum())

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the greatest cosine above 0 (ties to the earlier), and the cosines."""
        bound = weight @ self.greatest[at]
        order = np.argsort(-bound, kind="stable")
        best, cosine, least = np.zeros(0, np.int64), np.zeros(0), 0.0
        for i in range(0, len(order), 8):  # eight blocks at a time
            blocks = order[i : i + 8]
            # weights are single precision, hence the margin
            blocks = blocks[(bound[blocks] > 0) & ((len(best) < k) | (bound[blocks] >= least - 1e-6))]
            if not len(blocks):
                break
            scores = np.tensordot(weight, self.weights[at[:, None], blocks], 1)
            examples = (blocks[:, None] * self.block + np.arange(self.block)).reshape(-1)
            scores = scores.reshape(-1)
            found = np.flatnonzero((scores > max(least - 1e-9, 0.0)) & (examples != without))
            best, cosine = np.r_[best, examples[found]], np.r_[cosine, scores[found]]
            kept = np.lexsort((best, -cosine))[:k]
            best, cosine = best[kept], cosine[kept]
            least = cosine[-1] if len(best) == k else 0.0
        return best, cosine


class NeighbourVotes:
    """Fitted index and calibration."""

    def __init__(self, index: BlockMaxIndex, starts: tuple[int, ...], k: int, prior: float):
        self.index, self.starts, self.k, self.prior = index, starts, k, prior
        self.slope, self.shift = 1.0, 0.0
        self._known: dict[str, tuple[str, ...]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_known": {}}

    def counts(self, text: str | None) -> Counter:
        """Counts of the index's terms in a whole text."""
        words, out = Counter(_WORD.findall((text or "").lower())), Counter()
        known, number = self._known, self.index.number
        for word, n in words.items():
            terms = known.get(word)
            if terms is None:
                terms = tuple(t for t in _terms(word, self.starts) if t in number)
                if len(word) <= 64:
                    if len(known) >= 300_000:
                        known.clear()
                    known[word] = terms
            for t in terms:
                out[t] += n
        return out

    def vote(self, counts: dict, without: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """Share of the distance-weighted votes for label 1, with the prior as a weak vote, and the evidence."""
        at, weight = self.index.vector(counts)
        near, cosine = self.index.nearest(at, weight, self.k, without) if len(at) else (at, weight)
        votes = 1 / (1.05 - np.minimum(cosine, 1.0))
        return float((votes @ self.index.labels[near] + self.prior) / (votes.sum() + 1)), near, cosine

    def score(self, text: str | None) -> tuple[float, np.ndarray, np.ndarray]:
        share, near, cosine = self.vote(self.counts(text))
        x = math.log(share / (1 - share))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * x + self.shift)))), near, cosine


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 1500, terms: int = 600, k: int = 15, starts: tuple[int, ...] = (4, 5, 6), longest: int = 30_000, train=None) -> NeighbourVotes:
    """Indexes at most ``per_class`` labelled texts of each class (up to ``longest`` characters).

    The index's terms are the ``terms`` words and word starts that tell the labels apart best in
    the sample; the scores are calibrated leaving each example out of its own vote.  Prior and
    class weights are the labels' shares of all permitted labelled ids, not of the sample.
    """
    rows, counts = labelled_sample(docs, labels, label, per_class, longest, train)
    rows = [(t or "", y) for t, y in rows]
    n1, n0 = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    found = (Counter(), Counter())  # texts of each label by term
    for text, y in rows:
        found[y].update({t for word in set(_WORD.findall(text.lower())) for t in _terms(word, starts)})
    frequent = {t: (found[1][t], found[0][t]) for c in found for t in c if found[1][t] + found[0][t] >= 3}
    gains = {t: log_likelihood(a, max(n1, 1), b, max(n0, 1)) for t, (a, b) in frequent.items()}
    chosen = sorted((t for t in gains if gains[t] > 10.83), key=lambda t: (-gains[t], t))[:terms]
    idf = {t: 1 + math.log((len(rows) + 1) / (sum(frequent[t]) + 1)) for t in chosen}
    prior = share_of(counts)
    del found, frequent, gains  # all terms of the sample; only the chosen ones are counted by text
    bags = []
    for text, _ in rows:
        bag: Counter = Counter()
        for word, n in Counter(_WORD.findall(text.lower())).items():
            for t in _terms(word, starts):
                if t in idf:
                    bag[t] += n
        bags.append(bag)
    model = NeighbourVotes(BlockMaxIndex(bags, [y for _, y in rows], list(range(len(rows))), idf), starts, k, prior)
    if n1 and n0:
        share = np.array([model.vote(c, i)[0] for i, c in enumerate(bags)])
        model.slope, model.shift = logistic_fit(np.log(share / (1 - share)), np.array([y for _, y in rows]), counts)
        model.slope = max(model.slope, 0.0)
    return model


def score_documents(docs: DataFrame, model: NeighbourVotes, threshold: float = 0.7, evidence: bool = False) -> DataFrame:
    """doc_id, score and predicted (1 if score >= threshold) for every row of ``docs``; with ``evidence`` also its nearest examples.

    Row by row, without a shuffle: whole texts, repeated rows give repeated results, null and
    empty texts and texts without a known term get the score of no neighbours.  Evidence is an
    array of (example, label, cosine), nearest first, ties to the earlier example.  An empty table
    gives an empty result; further columns are not read.
    """
    kind = pa.list_(pa.struct([("example", pa.int64()), ("label", pa.int64()), ("cosine", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [model.score(t) for t in batch.column("text").to_pylist()]
            arrays, names = [batch.column("doc_id"), pa.array([x[0] for x in found], pa.float64())], ["doc_id", "score"]
            if evidence:
                arrays.append(pa.array([[{"example": int(model.index.ids[i]), "label": int(model.index.labels[i]), "cosine": float(c)} for i, c in zip(x[1], x[2], strict=True)] for x in found], kind))
                names.append("evidence")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, score double" + (", evidence array<struct<example:long,label:long,cosine:double>>" if evidence else "")
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: NeighbourVotes, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores under ``threshold``; null and empty texts have the score of no neighbours, repeated rows fare alike, an empty table stays empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            clean = [model.score(t)[0] < threshold for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Learns from rows outside fold 1 of 3 and scores all rows."""
    model = fit(docs, labels, train=fold(F.col("doc_id"), 3) != 1, **options)
    return score_documents(docs, model).withColumn("held_out", fold(F.col("doc_id"), 3) == 1)
