"""Quality scores from compression: which of two dictionaries makes a text smaller.

Two zstandard dictionaries are built, one from good and one from bad labelled texts.  A text's
score is the difference of its two compressed sizes over its plain size, calibrated by a
logistic curve.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import fold, small_batches
from docweave.llm.samples import labelled_sample, logistic_fit, share_of


class CompressionClassifier:
    """Fitted dictionaries and calibration; small enough to be sent with the tasks."""

    def __init__(self, good: bytes, bad: bytes, level: int, slope: float, shift: float, prior: float):
        self.good, self.bad, self.level, self.slope, self.shift, self.prior = good, bad, level, slope, shift, prior
        self._compressors = None

    def __getstate__(self):
        return self.__dict__ | {"_compressors": None}

    def difference(self, data: bytes) -> float:
        """(size with the bad dictionary - size with the good one) / plain size."""
        if self._compressors is None:
            made = []
            for content in (self.bad, self.good):
                known = zstandard.ZstdCompressionDict(content)
                known.precompute_compress(level=self.level)
                made.append(zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False))
            self._compressors = made
        bad, good = self._compressors
        return (len(bad.compress(data)) - len(good.compress(data))) / (len(data) + 16)

    def score(self, text: str | None) -> float:
        """Probability of label 1; the labels' share for a text without content."""
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data.strip():
            return self.prior
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * self.difference(data) + self.shift))))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1500, dictionary_bytes: int = 112_640, level: int = 3, longest: int = 30_000, train=None) -> CompressionClassifier:
    """Fits on at most ``per_class`` labelled rows of each class, texts of up to ``longest`` characters.

    Two thirds of the sample build the dictionaries (see ``_dictionary`` for classes too small to
    train on) and a third calibrates the scores, with
    the labels' shares of all permitted labelled ids as prior and class weights.  ``train`` is a
    predicate that says which rows may be learned from.
    """
    rows, counts = labelled_sample(docs, labels, label, per_class, longest, train)
    texts = {k: [(r[0] or "").encode("utf-8", "surrogatepass") for r in rows if r[1] == k] for k in (0, 1)}
    prior = share_of(counts)
    parts = {k: ([t for i, t in enumerate(v) if i % 3] or v, v[::3]) for k, v in texts.items()}
    content = {k: _dictionary(v[0], dictionary_bytes, level) for k, v in parts.items()}
    model = CompressionClassifier(content[1], content[0], level, 0.0, math.log(prior / (1 - prior)), prior)
    if texts[0] and texts[1]:
        xs = [(model.difference(t), k) for k, v in parts.items() for t in v[1] if t.strip()]
        model.slope, model.shift = logistic_fit(np.array([x for x, _ in xs]), np.array([k for _, k in xs]), counts)
    return model


def _dictionary(samples: list[bytes], size: int, level: int) -> bytes:
    """A trained dictionary; where zstandard can't train one, a piece of each sampled text.

    Pieces are equal parts of ``size``; what short texts leave of theirs goes to the longer ones.
    """
    try:
        return zstandard.train_dictionary(size, samples, level=level).as_bytes()
    except (zstandard.ZstdError, ValueError):
        pieces, left = [], size
        for i, text in enumerate(sorted(samples, key=len)):
            pieces.append(text[: max(0, left // (len(samples) - i) - 1)])
            left -= len(pieces[-1]) + 1
        return b"\n".join(p for p in pieces if p) or b"no sample of this class"


def score_documents(docs: DataFrame, model: CompressionClassifier, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted (1 if score >= threshold) for every row of ``docs``.

    Row by row, without a shuffle: whole texts, repeated rows give repeated results, null, empty
    and blank texts get the labels' share as their score, an empty table gives an empty result,
    and further columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            scores = [model.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Learns from rows outside fold 0 of 5 and scores all rows."""
    model = fit(docs, labels, train=fold(F.col("doc_id"), 5) != 0, **options)
    return score_documents(docs, model).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
