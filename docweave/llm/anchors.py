"""Finding repeated windows: the frame that the two substring operators share.

A window is a run of ``length`` consecutive units (words or bytes) of one text.  Every window is
dealt to one anchor, a content-defined k-gram in it, so that equal windows meet under equal
anchors at equal places; a run of windows with one anchor is a context.  The steps:

1. contexts of all texts (anchor hash, content hash, place), written to the shared folder;
2. anchors that occur once are dropped; counting is pre-aggregated before the shuffle;
3. contexts with equal content are one weighted context; where an anchor has only one, all its
   windows repeat.  The contents of the others are fetched, one per weighted context;
4. an operator's own index finds the repeated windows of the contents of each anchor;
5. the places of every context get its repeated windows, as ranges of units for each text.  The
   runs of windows of a content are one row, so that this join gives a row for each place.

Joins are keyed by hashes of content or by rows and left to adaptive skew handling; groups are
never collected except in step 4, whose groups hold distinct contents around one anchor.  Anchors
that occur more than ``hot`` times are left out of step 4: the windows of their contents are
counted by two hashes instead, pre-aggregated, so that no task holds such a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm import rolling
from docweave.llm.common import shared_folder, small_batches, with_row_id, written

_CONTEXTS = "rid long, start int, windows int, h long, ctx long"
_CONTENTS = "h long, ctx long, n long, windows int, content binary"
_WINDOWS = "h long, a long, b long, n long, ctx long, first int"
_REPEATS = "h long, ctx long, runs array<struct<first:int,last:int>>"


@dataclass(frozen=True)
class Units:
    """What a text is made of: how to cut it, and how long windows and anchors are."""

    length: int
    k: int
    words: bool

    def places(self, data: np.ndarray, offsets: np.ndarray):
        """Row borders in units, start and end bytes of the units (None for bytes)."""
        if not self.words:
            return offsets, None, None
        starts, ends, borders = rolling.words(data, offsets)
        return borders, starts, ends

    def cut(self, data: np.ndarray, offsets: np.ndarray, salt: int = 0) -> tuple[rolling.Ranges, np.ndarray]:
        """Hashes of ranges of units (of k, and from a window to a context), and row borders in units."""
        borders, starts, ends = self.places(data, offsets)
        symbols = rolling.word_hashes(data, starts, ends, salt) if self.words else data
        return rolling.Ranges(symbols, (self.k, self.length, 2 * self.length - self.k), salt), borders

    def pieces(self, data: np.ndarray, offsets: np.ndarray, most: int = 1 << 20):
        """The batch, or a long text alone in it in pieces that share no window and miss none; with each piece's first unit."""
        if len(offsets) != 2 or len(data) <= 2 * most:
            yield data, offsets, 0
            return
        _, starts, ends = self.places(data, offsets)
        n, step = (len(starts), most // 8) if self.words else (len(data), most)
        for a in range(0, n - self.length + 1, step):
            z = min(a + step + self.length - 1, n)
            part = data[starts[a] : ends[z - 1]] if self.words else data[a:z]
            yield part, np.array([0, len(part)]), a


@dataclass
class Contents:
    """Distinct contents of some anchors: parts of one byte array, in anchor order."""

    h: np.ndarray
    ctx: np.ndarray
    n: np.ndarray
    windows: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def find_repeats(docs: DataFrame, units: Units, index: Callable[[Contents], tuple[np.ndarray, np.ndarray, np.ndarray]], block_bytes: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """(docs with rid, ranges of repeated windows as rid and an array of (first, last) units).

    ``index`` gets contents of whole anchors, about ``block_bytes`` at a time, and returns the
    repeated windows as (number of the content, first window, last window), in order of content.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    docs = with_row_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = written(docs.select("rid", "text").mapInArrow(lambda it: _contexts(it, units), _CONTEXTS), "contexts", folder)
    anchors = found.groupBy("h").agg(F.count("*").alias("times"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi")).where("times > 1").select("h", (F.col("lo") != F.col("hi")).alias("mixed"), (F.col("times") > hot).alias("many"))
    repeated = written(found.join(anchors, "h"), "repeated", folder, found.count(), 1 << 18)

    mixed = repeated.where("mixed").groupBy("h", "ctx", "many").agg(F.count("*").alias("n"), F.min(F.struct("rid", "start", "windows")).alias("at"))

    def wanted(where: str) -> DataFrame:
        """docs with the contents that are wanted of them; all columns go along, so that this join and the caller's share one shuffle of the texts."""
        some = mixed.where(where).select("at.rid", F.struct("at.start", "at.windows", "h", "ctx", "n").alias("w"))
        return docs.join(some.groupBy("rid").agg(F.collect_list("w").alias("wanted")), "rid")

    contents = wanted("NOT many").mapInArrow(lambda it: _contents(it, units), _CONTENTS)
    blocks = contents.repartition("h").sortWithinPartitions("h")
    verdicts = blocks.mapInArrow(lambda it: _verdicts(it, index, block_bytes), _REPEATS)
    counted = written(wanted("many").mapInArrow(lambda it: _windows(it, units), _WINDOWS), "windows", folder, repeated.count(), 1 << 18)
    again = counted.groupBy("h", "a", "b").agg(F.sum("n").alias("times")).where("times > 1").select("h", "a", "b")
    verdicts = verdicts.unionByName(_runs_of(counted.join(again, ["h", "a", "b"])))

    def units_of(first, last):
        return F.struct((F.col("start") + first).alias("first"), (F.col("start") + last + F.lit(units.length - 1)).alias("last"))

    whole = repeated.where("NOT mixed").select("rid", F.array(units_of(F.lit(0), F.col("windows") - 1)).alias("ranges"))
    parts = repeated.where("mixed").select("rid", "start", "h", "ctx").join(verdicts, ["h", "ctx"])
    parts = parts.select("rid", F.transform("runs", lambda run: units_of(run["first"], run["last"])).alias("ranges"))
    ranges = whole.unionByName(parts).groupBy("rid").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    return docs, ranges


def _runs_of(windows: DataFrame) -> DataFrame:
    """Windows (h, ctx, first) as one row for each content, with its runs of consecutive windows.

    A content has at most as many windows as fit around one anchor, so no group grows with the number of places.
    """
    run = F.col("first") - F.row_number().over(Window.partitionBy("h", "ctx").orderBy("first"))
    found = windows.select("h", "ctx", "first", run.alias("run")).groupBy("h", "ctx", "run").agg(F.min("first").alias("first"), F.max("first").alias("last"))
    return found.groupBy("h", "ctx").agg(F.collect_list(F.struct("first", "last")).alias("runs"))


def _contexts(batches: Iterable[pa.RecordBatch], units: Units) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        for data, offsets, ahead in units.pieces(*rolling.text_buffers(batch.column("text"))):
            ranges, borders = units.cut(data, offsets)
            short = ranges.grams(units.k)
            if not len(short):
                continue
            grams = np.full(borders[-1], np.uint64(2**64 - 1))
            grams[: len(short)] = short
            row, at, start, windows = rolling.owned_windows(grams, borders, units.k, units.length)
            if len(row):
                ctx = ranges.hash(start, start + windows + units.length - 1)
                rid = np.asarray(batch.column("rid"))[row]
                arrays = [rid, (start - borders[row] + ahead).astype(np.int32), windows.astype(np.int32), grams[at].view(np.int64), ctx.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["rid", "start", "windows", "h", "ctx"])


def _wanted(batch: pa.RecordBatch, borders: np.ndarray):
    """Of each wanted content: first unit and number of windows; h, ctx and n."""
    lists = batch.column("wanted")
    rows = np.repeat(np.arange(len(batch)), np.asarray(lists.value_lengths()))
    start, windows, h, ctx, n = lists.flatten().flatten()
    return borders[rows] + np.asarray(start), np.asarray(windows), h, ctx, n


def _contents(batches: Iterable[pa.RecordBatch], units: Units) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        data, offsets = rolling.text_buffers(batch.column("text"))
        borders, starts, ends = units.places(data, offsets)
        first, windows, h, ctx, n = _wanted(batch, borders)
        last = first + windows + units.length - 2
        if units.words:
            first, last = starts[first], ends[last]
        else:
            last = last + 1
        sizes = np.zeros(len(first) + 1, np.int32)
        np.cumsum(last - first, out=sizes[1:])
        content = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(sizes), pa.py_buffer(gather(data, first, last))])
        yield pa.RecordBatch.from_arrays([h, ctx, n, pa.array(windows), content], names=["h", "ctx", "n", "windows", "content"])


def _windows(batches: Iterable[pa.RecordBatch], units: Units) -> Iterator[pa.RecordBatch]:
    """Two hashes of each window of the wanted contents."""
    for batch in small_batches(_contents(batches, units), "content"):
        data, offsets = rolling.text_buffers(batch.column("content"))
        windows = np.asarray(batch.column("windows"))
        of = np.repeat(np.arange(len(windows)), windows)
        place = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        hashes = []
        for salt in (1, 2):
            ranges, borders = units.cut(data, offsets, salt)
            at = borders[of] + place
            hashes.append(pa.array(ranges.hash(at, at + units.length).view(np.int64)))
        take = pa.array(of)
        h, ctx, n = (batch.column(c).take(take) for c in ("h", "ctx", "n"))
        yield pa.RecordBatch.from_arrays([h, *hashes, n, ctx, pa.array(place.astype(np.int32))], names=["h", "a", "b", "n", "ctx", "first"])


def gather(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The ranges [first, last) of ``data``, one after the other."""
    sizes = last - first
    ahead = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return data[np.repeat(first, sizes) + ahead]


def _verdicts(batches: Iterable[pa.RecordBatch], index, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Runs the index over whole anchors at a time; the rows come sorted by anchor."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in small_batches(batches, "content", block_bytes):
        held.append(batch)
        size += batch.column("content").nbytes
        if size >= block_bytes:
            table = pa.Table.from_batches(held).combine_chunks()
            h = np.asarray(table.column("h"))
            cut = int(np.searchsorted(h, h[-1], "left"))  # the last anchor may go on
            if cut:
                yield _indexed(table.slice(0, cut), index)
                table = table.slice(cut)
            held, size = table.to_batches(), table.column("content").nbytes
    if held:
        yield _indexed(pa.Table.from_batches(held), index)


def _indexed(table: pa.Table, index) -> pa.RecordBatch:
    data, offsets = rolling.text_buffers(table.column("content").combine_chunks())
    h, ctx, n, windows = (np.asarray(table.column(c)) for c in ("h", "ctx", "n", "windows"))
    which, first, last = index(Contents(h, ctx, n, windows, data, offsets))
    # the runs come in order of content: one row for each content that has any
    begin = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(which) else which
    found = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (first, last)], names=["first", "last"])
    listed = pa.ListArray.from_arrays(pa.array(np.r_[begin, len(which)].astype(np.int32)), found)
    return pa.RecordBatch.from_arrays([pa.array(h[which[begin]]), pa.array(ctx[which[begin]]), listed], names=["h", "ctx", "runs"])


def runs(repeated: np.ndarray, of: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive repeated windows of one content as (content, first, last); rows in order."""
    at = np.flatnonzero(repeated)
    if not len(at):
        return at, at, at
    of, window = of[at], window[at]
    new = np.r_[True, (of[1:] != of[:-1]) | (window[1:] != window[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)] - 1
    return of[first], window[first], window[last]


def union_of_ranges(ranges, n: int) -> np.ndarray:
    """Marks units 0..n-1 that lie in any of the (first, last) ranges."""
    marks = np.zeros(n + 1, np.int32)
    if len(ranges):
        first, last = (np.asarray(x) for x in ranges.flatten())
        np.add.at(marks, first, 1)
        np.add.at(marks, last + 1, -1)
    return np.cumsum(marks[:-1]) > 0
