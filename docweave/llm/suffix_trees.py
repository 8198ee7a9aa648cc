"""Substring dedup over words: prefix-partitioned suffix trees.

The suffixes of all texts are split by a content-defined prefix (the anchor) into groups, and in
a group by ever longer word prefixes until each part fits a bounded block.  In each part the
suffixes are ordered and their common prefixes give the subtree; an internal node of at least
``length`` words has as leaves the places of a repeated run of words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docweave.llm import rolling
from docweave.llm.anchors import Contents, Units, find_repeats, gather, runs, union_of_ranges
from docweave.llm.common import small_batches


def dedup_words(docs: DataFrame, length: int = 35, k: int = 8, block_bytes: int = 1 << 20, hot: int = 20_000, keep_text: bool = True) -> DataFrame:
    """Removes each word that lies in a run of ``length`` words which also starts anywhere else.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Returns one row for each row of ``docs``:
    doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space), and with
    ``keep_text`` also kept and the removed spans (first and last word).  Windows are judged on
    the input, so of several copies none is kept.  Null and empty texts have no words; a repeated
    row is another text, so its long runs repeat; texts under ``length`` words keep all.  An
    empty table gives an empty result; further columns are not read.
    """
    numbered, ranges = find_repeats(docs, Units(length, k, True), lambda c: repeated_windows(c, length), block_bytes, hot)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string, removed array<struct<first:long,last:long>>" if keep_text else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            data, offsets = rolling.text_buffers(batch.column("text"))
            starts, ends, borders = rolling.words(data, offsets)
            words, removed, digests, kept, spans = [], [], [], [], []
            for i, (a, z) in enumerate(zip(borders[:-1], borders[1:], strict=True)):
                found = batch.column("ranges")[i].values
                gone = union_of_ranges(found if found is not None else (), int(z - a))
                stay = np.flatnonzero(~gone) + a
                left = joined(data[offsets[i] : offsets[i + 1]], starts[stay] - offsets[i], ends[stay] - offsets[i])
                words.append(int(z - a))
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                if keep_text:
                    kept.append(left.decode("utf-8", "replace"))
                    edge = np.flatnonzero(np.diff(np.r_[0, gone.view(np.int8), 0]))
                    spans.append([{"first": int(x), "last": int(y) - 1} for x, y in zip(edge[::2], edge[1::2], strict=True)])
            arrays = [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                arrays += [pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))]
                names += ["kept", "removed"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return numbered.join(ranges, "rid", "left").mapInArrow(run, schema)


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The given words, which are in order, with one space between them."""
    if not len(starts):
        return b""
    out, marks = np.full(len(data) + 1, 0x20, np.uint8), np.zeros(len(data) + 2, np.int8)
    out[:-1] = data
    out[ends] = 0x20  # the byte behind each word becomes its space
    marks[starts] += 1
    marks[ends + 1] -= 1
    return out[np.cumsum(marks, dtype=np.int8)[:-1] > 0][:-1].tobytes()


def exact_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal only for equal bytes: hashes propose, the bytes decide."""
    names, first, of = np.unique(rolling.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    like, size = first[of], ends - starts
    same = bool((size == size[like]).all())
    for i in range(0, len(starts) if same else 0, 1 << 17):
        some = slice(i, i + (1 << 17))
        same = same and np.array_equal(gather(data, starts[some], ends[some]), gather(data, starts[like[some]], ends[like[some]]))
    if same:
        return of.astype(np.int64)
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(data[a:z].tobytes(), len(numbers)) for a, z in zip(starts, ends, strict=True)], np.int64)


def repeated_windows(contents: Contents, length: int, most_suffixes: int = 1 << 20):
    """Windows of the contents that are leaves of internal nodes of at least ``length`` words."""
    starts, ends, borders = rolling.words(contents.data, contents.offsets)
    names = exact_names(contents.data, starts, ends)
    first = borders[:-1]
    of = np.repeat(np.arange(len(first)), contents.windows)
    window = np.arange(len(of)) - np.repeat(np.cumsum(contents.windows) - contents.windows, contents.windows)
    suffix = first[of] + window
    weight = contents.n[of]
    repeated = np.zeros(len(of), bool)
    for part in prefix_parts(names, suffix, length, most_suffixes):
        repeated[part] = deep_leaves(names, suffix[part], weight[part], length)
    return runs(repeated, of, window)


def prefix_parts(names: np.ndarray, suffix: np.ndarray, length: int, most: int) -> Iterator[np.ndarray]:
    """Splits suffixes by word prefixes, longer ones where more than ``most`` share one."""
    pending = [(np.arange(len(suffix)), 0)]
    while pending:
        part, depth = pending.pop()
        if len(part) <= most or depth == length:
            yield part
            continue
        word = names[suffix[part] + depth]
        order = np.argsort(word, kind="stable")
        cuts = np.flatnonzero(np.diff(word[order])) + 1
        small: list[np.ndarray] = []
        size = 0
        for piece in np.split(order, cuts):
            if len(piece) > most:
                pending.append((part[piece], depth + 1))
            elif size + len(piece) > most:
                pending.append((part[np.concatenate(small)], length))
                small, size = [piece], len(piece)
            else:
                small.append(piece)
                size += len(piece)
        if small:
            pending.append((part[np.concatenate(small)], length))


def subtree(names: np.ndarray, suffix: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of the suffix tree in order, and for each whether it shares ``length`` words with the one before.

    The leaves are ordered by prefix doubling over the places that the suffixes reach.
    """
    n = len(names)
    rank, width = names, 1
    while width < length:
        step = min(width, length - width)
        ahead = np.full(n, -1, np.int64)
        ahead[: n - step] = rank[step:]
        key = rank * np.int64(n + 1) + ahead + 1
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        width += step
    order = np.argsort(rank[suffix], kind="stable")
    path = rank[suffix][order]
    return order, np.r_[False, path[1:] == path[:-1]] if len(path) else np.zeros(0, bool)


def deep_leaves(names: np.ndarray, suffix: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes hang below an internal node of at least ``length`` words.

    A leaf of weight two or more stands for as many equal contents and so is such a node.
    """
    local = np.unique(suffix[:, None] + np.arange(length)) if len(suffix) * 4 < len(names) else None
    if local is not None:  # work on the words that these suffixes reach
        kept = names[local]
        # a gap between reached places must not join them
        gap = np.flatnonzero(np.diff(local) != 1) + 1
        kept = np.insert(kept, gap, names.max() + 1 + np.arange(len(gap)))
        place = np.searchsorted(local, suffix)
        names, suffix = kept, place + np.searchsorted(gap, place, "right")
    order, shared = subtree(names, suffix, length)
    deep = shared.copy()
    deep[:-1] |= shared[1:]
    out = np.zeros(len(suffix), bool)
    out[order] = deep
    return out | (weight > 1)


#: The result of op2 in DuckDB's SQL.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM d WHERE len(ws) >= 35),
w AS (SELECT doc_id, i, count(*) OVER (PARTITION BY array_to_string(list_slice(ws, i, i + 34), ' ')) AS n FROM s),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM w, (SELECT unnest(generate_series(0, 34)) AS k) WHERE n > 1),
t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
a AS (SELECT t.doc_id, count(*) AS n_words, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY t.i) FILTER (WHERE gone.i IS NULL) AS kept FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.i = t.i GROUP BY t.doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN a USING (doc_id)
"""
