"""Substring dedup over bytes: threshold-bounded interval expansion on a Burrows-Wheeler transform.

Around each anchor the distinct contents are read as chains of blocks of ``block`` bytes, so a
string of ``length`` bytes is ``length / block`` symbols of one chain.  From the transform of
the chains, a breadth-first backward extension derives the common prefix lengths by increasing
value and stops at ``length``; the neighbours in suffix order whose common prefix it has not
bounded by then share at least ``length`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docweave.llm import rolling
from docweave.llm.anchors import Contents, Units, find_repeats, runs, union_of_ranges
from docweave.llm.common import small_batches


def dedup_bytes(docs: DataFrame, length: int = 200, k: int = 32, block: int = 50, block_bytes: int = 1 << 20, hot: int = 20_000, keep_text: bool = True) -> DataFrame:
    """Removes each byte that lies in a string of ``length`` bytes which also starts anywhere else.

    Texts are UTF-8 bytes and matches never cross rows.  Returns one row for each row of
    ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the
    remaining bytes), and with ``keep_text`` also kept (binary) and spans (first and last byte).
    Strings are judged on the input, so of several copies none is kept; overlaps count.  Null
    texts are empty; a repeated row is another text; texts under ``length`` bytes keep all.  An
    empty table gives an empty result; further columns are not read.
    """
    if length % block:
        raise ValueError("length must be a multiple of block")
    numbered, ranges = find_repeats(docs, Units(length, k, False), lambda c: repeated_windows(c, length, block), block_bytes, hot)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary, spans array<struct<first:long,last:long>>" if keep_text else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            data, offsets = rolling.text_buffers(batch.column("text"))
            columns: list[list] = [[] for _ in range(6)]
            for i, (a, z) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                found = batch.column("ranges")[i].values
                whole, spans, gone = data[a:z], [], 0
                if found is not None:
                    marks = union_of_ranges(found, len(whole))
                    edge = np.flatnonzero(np.diff(np.r_[0, marks.view(np.int8), 0]))
                    spans = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
                    gone = int(marks.sum())
                    whole = whole[~marks]
                left = whole.tobytes()
                values = (len(left) + gone, gone, len(spans), hashlib.sha256(left).hexdigest(), left, [{"first": x, "last": y - 1} for x, y in spans])
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
            most = 6 if keep_text else 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns[:most], kinds, strict=False))], names=["doc_id", *names[:most]])

    return numbered.join(ranges, "rid", "left").mapInArrow(run, schema)


def repeated_windows(contents: Contents, length: int, block: int):
    """Windows of the contents that share ``length`` bytes with another place, or stand for equal contents."""
    windows, first = contents.windows.astype(np.int64), contents.offsets[:-1]
    grams = rolling.Ranges(contents.data, (block,)).grams(block)
    of = np.repeat(np.arange(len(first)), windows)
    window = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    # the chains: windows that are whole blocks apart follow one another
    chained = np.minimum(windows, block)
    chain_of = np.repeat(np.arange(len(first)), chained)
    residue = np.arange(len(chain_of)) - np.repeat(np.cumsum(chained) - chained, chained)
    symbols = (windows[chain_of] - 1 - residue) // block + length // block
    base = np.cumsum(symbols + 1) - symbols - 1
    chain = np.repeat(np.arange(len(symbols)), symbols)
    step = np.arange(len(chain)) - np.repeat(np.cumsum(symbols) - symbols, symbols)
    values = grams[first[chain_of[chain]] + residue[chain] + step * block]
    text = np.empty(len(chain) + len(symbols), np.int64)
    text[base + symbols] = np.arange(len(symbols))  # each chain has an end mark of its own
    text[base[chain] + step] = len(symbols) + np.unique(values, return_inverse=True)[1]
    start = np.cumsum(chained) - chained
    place = base[start[of] + window % block] + window // block
    bounded, where = bounded_prefixes(text, length // block)
    share = ~bounded  # of each suffix and the one before it
    share[0] = False
    both = share.copy()
    both[:-1] |= share[1:]
    return runs(both[where[place]] | (contents.n[of] > 1), of, window)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` symbols, by doubling; equal ones stay in text order."""
    n = len(text)
    rank, width = text, 1
    while width < depth:
        step = min(width, depth - width)
        ahead = np.full(n, -1, np.int64)
        ahead[: n - step] = rank[step:]
        rank = np.unique(rank * np.int64(n + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        width += step
    return np.argsort(rank, kind="stable")


def bounded_prefixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Which neighbours in suffix order share fewer than ``depth`` symbols, and each suffix's place in that order.

    Backward extension: from the interval of each string of l symbols come the intervals of all
    strings of l + 1 symbols that end in it; the border behind a new interval, if no shorter
    string has set it, is a common prefix of l symbols.  Only intervals that set a border go on.
    """
    n = len(text)
    order = suffix_order(text, depth)
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    transform = text[order - 1]  # the symbol before each suffix
    back = np.empty(n, np.int64)
    back[np.argsort(transform, kind="stable")] = np.arange(n)
    bounded = np.zeros(n + 1, bool)
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(depth):
        sizes = high - low
        source = np.repeat(np.arange(len(low)), sizes)
        inside = np.arange(len(source)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[source]
        to = back[inside]
        line = np.argsort(to, kind="stable")
        to, source, symbol = to[line], source[line], transform[inside[line]]
        new = np.r_[True, (source[1:] != source[:-1]) | (symbol[1:] != symbol[:-1]) | (to[1:] != to[:-1] + 1)]
        begin = np.flatnonzero(new)
        low, high = to[begin], to[np.r_[begin[1:], len(to)] - 1] + 1
        fresh = ~bounded[high]
        bounded[high] = True
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
    return bounded[:n], where


#: The result of op8 in DuckDB's SQL, on the hexadecimal digits of the bytes.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, h, unnest(generate_series(1, length(h) // 2 - 199)) AS i FROM d WHERE length(h) >= 400),
w AS (SELECT doc_id, i, md5_number(substring(h, 2 * i - 1, 400)) AS m FROM s),
r AS (SELECT doc_id, i FROM w SEMI JOIN (SELECT m FROM w GROUP BY m HAVING count(*) > 1) USING (m)),
e AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prv FROM r),
b AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e WHERE prv IS NULL OR i - prv > 200),
z AS (SELECT doc_id, i + 200 AS j, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e WHERE nxt IS NULL OR nxt - i > 200),
spans AS (SELECT b.doc_id, b.i, z.j, b.k, lag(z.j, 1, 1) OVER (PARTITION BY b.doc_id ORDER BY b.k) AS from_, row_number() OVER (PARTITION BY b.doc_id ORDER BY b.k DESC) AS last FROM b JOIN z ON b.doc_id = z.doc_id AND b.k = z.k),
a AS (SELECT doc_id, count(*) AS n_spans, sum(j - i) AS n_removed, string_agg(substring(h, (2 * from_ - 1)::BIGINT, (2 * (i - from_))::BIGINT), '' ORDER BY k) || max(CASE WHEN last = 1 THEN substring(h, (2 * j - 1)::BIGINT) END) AS kept FROM spans JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN a USING (doc_id)
"""
