"""Language identification: a linear-chain conditional random field over the words of a text.

Every word gets a label from hashed features: its letters as a whole (lexicon), its starts and
ends (affixes) and its letter trigrams.  Transition weights between neighbouring words are
learned too, so code-switched texts are labelled piecewise.  Forward-backward gives each word's
label probabilities; a text's language has the largest share of its letters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm import rolling
from docweave.llm.common import fold, small_batches
from docweave.llm.samples import sample_ids



def lowered(column) -> pa.Array:
    """Lower-cased texts with every character that is no letter made a space."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.replace_substring_regex(pc.utf8_lower(column), r"[^\pL]+", " ")


class Features:
    """Hashed feature numbers of all words of a batch: ``buckets`` in all."""

    affixes = (1, 2, 3, 4)
    gram = 3

    def __init__(self, buckets: int):
        self.buckets = buckets

    def words(self, column):
        """Word features (word, feature), the trigram features of all bytes, where each word's begin and end, and row borders."""
        data, offsets = rolling.text_buffers(column)
        starts, ends, borders = rolling.words(data, offsets)
        prefix = rolling.byte_prefix(data)
        n = np.uint64(self.buckets)
        columns = [prefix.hash(starts, ends) % n]
        for i in self.affixes:
            columns.append(rolling.mix(prefix.hash(starts, np.minimum(starts + i, ends)) + np.uint64(2 * i)) % n)
            columns.append(rolling.mix(prefix.hash(np.maximum(ends - i, starts), ends) + np.uint64(2 * i + 1)) % n)
        grams = rolling.mix(prefix.grams(self.gram) + np.uint64(99)) % n
        return np.stack(columns, 1).astype(np.int64), grams.astype(np.int64), starts, ends, borders

    def emissions(self, column, weights: np.ndarray):
        """word, label: sums of feature weights; with letter bytes of each word and row borders."""
        fixed, grams, starts, ends, borders = self.words(column)
        out = np.zeros((len(starts), weights.shape[1]), np.float32)
        for j in range(fixed.shape[1]):
            out += weights[fixed[:, j]]
        if len(grams):
            sums = np.zeros((len(grams) + 1, weights.shape[1]), np.float64)
            np.cumsum(weights[grams], 0, out=sums[1:])
            last = np.minimum(np.maximum(ends - self.gram + 1, starts), len(grams))
            first = np.minimum(starts, len(grams))
            out += (sums[last] - sums[first]) / np.maximum(last - first, 1)[:, None]
        return out, ends - starts, borders


def marginals(emissions: np.ndarray, transitions: np.ndarray, borders: np.ndarray, chunk: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each word, and of each neighbouring pair's second word the step's factors.

    Forward and backward passes run over chunks of all texts at once: products of the step
    matrices inside the chunks, then over the chunks of a text, then back into them.
    """
    n, k = emissions.shape
    lengths = np.diff(borders)
    chunks = -(-lengths // chunk)
    first = np.cumsum(chunks) - chunks
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(n) - borders[row]
    slot, step = first[row] + place // chunk, place % chunk
    grown = np.exp(emissions - emissions.max(1, keepdims=True)).astype(np.float64)
    padded = np.ones((int(chunks.sum()), chunk, k))
    padded[slot, step] = grown
    filled = np.zeros((len(padded), chunk), bool)
    filled[slot, step] = True
    moves = np.exp(transitions)
    starts = np.zeros(len(padded), bool)
    starts[first[lengths > 0]] = True
    # inside each chunk: the product of its steps, as a matrix from the label before it
    product = np.broadcast_to(np.eye(k), (len(padded), k, k)).copy()
    for s in range(chunk):
        move = np.where((starts & (s == 0))[:, None, None], np.eye(k), moves)
        new = (product @ move) * padded[:, s, None, :]
        new /= new.sum((1, 2), keepdims=True)
        product = np.where(filled[:, s, None, None], new, product)
    # over the chunks of each text: forward and backward messages at the chunks' borders
    begin = np.full((len(padded), k), 1.0 / k)
    end = np.full((len(padded), k), 1.0)
    longest = int(chunks.max()) if len(chunks) else 0
    order = np.argsort(-chunks, kind="stable")
    for j in range(1, longest):
        on = order[: int((chunks > j).sum())]
        at = first[on] + j
        v = np.einsum("ni,nij->nj", begin[at - 1], product[at - 1])
        begin[at] = v / v.sum(1, keepdims=True)
        back = first[on] + chunks[on] - 1 - j
        v = np.einsum("nij,nj->ni", product[back + 1], end[back + 1])
        end[back] = v / v.sum(1, keepdims=True)
    # back into the chunks
    forward = np.empty((len(padded), chunk, k))
    v = begin
    for s in range(chunk):
        stepped = np.where((starts & (s == 0))[:, None], v, v @ moves) * padded[:, s]
        v = np.where(filled[:, s, None], stepped / stepped.sum(1, keepdims=True), v)
        forward[:, s] = v
    out = np.empty((len(padded), chunk, k))
    v = end
    for s in range(chunk - 1, -1, -1):
        out[:, s] = forward[:, s] * v
        stepped = (padded[:, s] * v) @ moves.T
        # the first word of a text has no step before it, and its message is not used
        v = np.where(filled[:, s, None], stepped / stepped.sum(1, keepdims=True), v)
    picked = out[slot, step]
    return picked / picked.sum(1, keepdims=True), forward[slot, step]


class LanguageField:
    """Learned weights; of bounded size, sent with the tasks."""

    def __init__(self, labels: list[str], buckets: int):
        self.labels, self.features = labels, Features(buckets)
        self.weights = np.zeros((buckets, len(labels)), np.float32)
        self.transitions = np.zeros((len(labels), len(labels)))

    def train(self, texts: list[str], labels: list[int], rounds: int = 30, rate: float = 0.3, ridge: float = 1e-6) -> None:
        """Adaptive gradient steps on the log-likelihood of the texts' label chains."""
        fixed, grams, starts, ends, borders = self.features.words(lowered(pa.array(texts, pa.large_string())))
        lengths, k = np.diff(borders), len(self.labels)
        if not len(starts) or k < 2:
            return
        gold = np.repeat(np.array(labels), lengths)
        target = np.eye(k)[gold]
        # each text counts alike up to 100 words, so that long ones don't rule
        per = np.repeat(np.minimum(1.0, 100 / np.maximum(lengths, 1)), lengths)[:, None]
        spans = np.minimum(np.maximum(ends - self.features.gram + 1, starts), len(grams)) - np.minimum(starts, len(grams))
        owner = np.repeat(np.arange(len(starts)), spans)
        inner = np.repeat(np.minimum(starts, len(grams)), spans) + np.arange(len(owner)) - np.repeat(np.cumsum(spans) - spans, spans)
        flat = np.r_[fixed.reshape(-1), grams[inner]]
        source = np.r_[np.repeat(np.arange(len(starts)), fixed.shape[1]), owner]
        value = np.r_[np.ones(fixed.size), 1 / spans[owner]]
        second = np.flatnonzero(np.r_[False, np.ones(len(starts) - 1, bool)] & ~np.isin(np.arange(len(starts)), borders))
        past, past_moves = np.full(self.weights.shape, 1e-8), np.full((k, k), 1e-8)
        for _ in range(rounds):
            emissions = np.stack([np.bincount(source, self.weights[flat, j] * value, len(starts)) for j in range(k)], 1)
            found, forward = marginals(emissions, self.transitions, borders)
            error = (target - found) * per
            gradient = np.stack([np.bincount(flat, error[source, j] * value, len(self.weights)) for j in range(k)], 1) - ridge * self.weights
            past += gradient**2
            # expected and seen moves between neighbours
            pair = forward[second - 1][:, :, None] * np.exp(self.transitions) * (np.exp(emissions[second] - emissions[second].max(1, keepdims=True)) * _backward(found, forward, second))[:, None, :]
            pair /= pair.sum((1, 2), keepdims=True)
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[second - 1], gold[second]), per[second, 0])
            move = seen - (pair * per[second][:, :, None]).sum(0) - 1e-3 * self.transitions
            past_moves += move**2
            self.weights += (rate * gradient / np.sqrt(past)).astype(np.float32)
            # held within e**3, as texts of one label alone would grow them without end
            self.transitions = np.clip(self.transitions + 0.1 * rate * move / np.sqrt(past_moves), -1.5, 1.5)

    def label_words(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label probabilities of the words, their lengths in bytes, and row borders."""
        emissions, size, borders = self.features.emissions(column, self.weights)
        return marginals(emissions, self.transitions, borders)[0], size, borders

    def predict(self, column) -> tuple[list[str], np.ndarray]:
        """The label with the largest share of each text's letters, and that share; ``und`` without a letter."""
        found, size, borders = self.label_words(column)
        row = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
        shares = np.stack([np.bincount(row, found[:, j] * size, len(borders) - 1) for j in range(len(self.labels))], 1) if len(self.labels) else np.zeros((len(borders) - 1, 1))
        total = shares.sum(1)
        best = shares.argmax(1)
        names = [self.labels[b] if t > 0 else "und" for b, t in zip(best, total, strict=True)]
        return names, np.where(total > 0, shares.max(1) / np.maximum(total, 1e-300), 0.0).clip(0, 1)


def _backward(found: np.ndarray, forward: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Backward messages, up to a factor, from probabilities and forward messages."""
    return found[at] / np.maximum(forward[at], 1e-300)


def fit(docs: DataFrame, per_label: int = 150, longest: int = 10_000, buckets: int = 1 << 16, rounds: int = 20, train=None) -> LanguageField:
    """Learns from ``per_label`` ids of each non-null lang that have a text of up to ``longest`` characters, all where there are fewer; an empty table teaches nothing."""
    short = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") <= longest))
    if train is not None:
        short = short.where(train)
    ids = sample_ids(short.select("doc_id", "lang"), "lang", per_label).select("doc_id").distinct()
    # at most per_label ids for each language, so they may be broadcast
    rows = short.join(F.broadcast(ids), "doc_id").collect()
    rows = sorted(rows, key=lambda r: (r.doc_id, r.lang, r.text))
    labels = sorted({r.lang for r in rows})
    field = LanguageField(labels, buckets)
    field.train([r.text for r in rows], [labels.index(r.lang) for r in rows], rounds)
    return field


def identify(docs: DataFrame, field: LanguageField) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) for every row of ``docs``.

    Row by row, without a shuffle: whole texts; repeated rows give repeated results; a text that
    is null or has no letter is ``und`` with score 0; with nothing learned all are; of equally
    likely labels the first in alphabetical order counts; an empty table gives an empty result;
    further columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            if field.labels:
                names, score = field.predict(lowered(batch.column("text")))
            else:
                names, score = ["und"] * len(batch), np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out_languages(docs: DataFrame, **options) -> DataFrame:
    """Learns from rows outside fold 0 of 5 and labels all rows."""
    field = fit(docs, train=fold(F.col("doc_id"), 5) != 0, **options)
    return identify(docs, field).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
