"""Near-duplicate documents: BagMinHash signatures, banding and verified multiset overlap.

A text is the multiset of its runs of five words.  For a shingle with count c, the weights
0..c are cut into dyadic ranges; each range of each shingle is a Poisson process of its own
whose points carry a register and a place in the range, and a point counts if its place is below
c.  The least point of each register is the signature: two registers agree with the probability
of the multisets' weighted Jaccard similarity.  Only points up to the time by which all registers
are likely full are generated; texts with an empty register go on to a later time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm import rolling
from docweave.llm.common import fresh, shared_folder, small_batches, with_row_id, written

_STEP, _LEVEL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(column, size: int, salts: tuple[int, ...] = (0,)) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row of each run of ``size`` words in text order, and its hash for each salt.

    A text of fewer words, but not none, is one run.
    """
    data, offsets = rolling.text_buffers(column)
    starts, ends, borders = rolling.words(data, offsets)
    lengths = np.diff(borders)
    n = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    row = np.repeat(np.arange(len(n)), n)
    at = borders[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    held = np.minimum(lengths, size)[row]
    out = []
    for salt in salts:
        words = np.r_[rolling.word_hashes(data, starts, ends, salt), np.zeros(size, np.uint64)]
        hashes = rolling.mix(held.astype(np.uint64) + np.uint64(salt))
        for j in range(size):
            hashes = rolling.blend(hashes, np.where(j < held, words[at + j], np.uint64(0)), salt)
        out.append(rolling.mix(hashes))
    return row, out


def counted(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of the shingles, in order of row and hash."""
    order = np.argsort(hashes)
    kind = np.uint16 if len(row) and row[-1] < 1 << 16 else np.int64
    order = order[np.argsort(row[order].astype(kind), kind="stable")]
    row, hashes = row[order], hashes[order]
    first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])]) if len(row) else np.zeros(0, np.int64)
    return row[first], hashes[first], np.diff(np.r_[first, len(row)])


def bags(column, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of the shingles of each text, in order of row and hash."""
    row, (hashes,) = shingles(column, size)
    return counted(row, hashes)


def signatures(row: np.ndarray, hashes: np.ndarray, count: np.ndarray, n_rows: int, registers: int, slack: float = 3.0) -> np.ndarray:
    """row, register: time of the least point; infinite for rows without shingles."""
    out = np.full((n_rows, registers), np.inf)
    flat = out.reshape(-1)
    weight = np.bincount(row, count, n_rows)
    until = np.where(weight > 0, (np.log(registers) + slack) / np.maximum(weight, 1), 0.0)
    todo = weight > 0
    while todo.any():
        some = todo[row]
        r, h, c = row[some], hashes[some], count[some]
        level = 0
        while len(r):
            low, size = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
            _points(flat, r, rolling.mix(h + np.uint64((level * int(_LEVEL)) % 2**64)), c, until[r], low, size, registers)
            level += 1
            more = c > (1 << (level - 1))
            r, h, c = r[more], h[more], c[more]
        todo &= np.isinf(out).any(1)
        until = until * 4
    return out


def _points(flat, row, seed, count, until, low: int, size: int, registers: int) -> None:
    """Runs the processes of one dyadic range of all shingles up to each row's time."""
    time, rate, i = np.zeros(len(row)), registers * size, 0
    while len(row):
        i += 1
        x = rolling.mix(seed + np.uint64((i * int(_STEP)) % 2**64))
        time = time - np.log(((x >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) / rate
        go = np.flatnonzero(time <= until)
        row, seed, count, until, time, x = row[go], seed[go], count[go], until[go], time[go], x[go]
        y = rolling.mix(x + _LEVEL)
        register = ((y >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        place = low + ((y & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        counts = place < count
        np.minimum.at(flat, (row * registers + register)[counts], time[counts])


def sketch(batches: Iterable[pa.RecordBatch], shingle: int, registers: int) -> Iterator[pa.RecordBatch]:
    """doc_id, rid, a digest of the multiset (a, b, n) and its registers, 16 bits each; rows without words are left out."""
    for batch in small_batches(batches):
        every, (first, second) = shingles(batch.column("text"), shingle, (0, 1))
        row, hashes, count = counted(every, first)
        kept = np.unique(row)
        if not len(kept):
            continue
        n_rows = len(batch)
        # sums over the multiset, of two hashes that have nothing in common
        begin = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        digests = [np.zeros(n_rows, np.uint64) for _ in range(2)]
        for d, h in zip(digests, (first, second), strict=True):
            d[kept] = np.add.reduceat(rolling.mix(h + _STEP), begin)
        total = np.bincount(row, count, n_rows).astype(np.int64)
        times = signatures(row, hashes, count, n_rows, registers)[kept].view(np.uint64)
        packed = (rolling.mix(times) >> np.uint64(48)).astype(">u2").tobytes()
        offsets = pa.py_buffer((np.arange(len(kept) + 1) * 2 * registers).astype(np.int32))
        binary = pa.Array.from_buffers(pa.binary(), len(kept), [None, offsets, pa.py_buffer(packed)])
        ids = [batch.column(c).take(pa.array(kept)) for c in ("doc_id", "rid")]
        yield pa.RecordBatch.from_arrays([*ids, *(pa.array(d[kept].view(np.int64)) for d in digests), pa.array(total[kept]), binary], names=["doc_id", "rid", "a", "b", "n", "registers"])


def overlaps(bag: tuple[np.ndarray, np.ndarray, np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of pairs of rows of (row, hash, count) in row order."""
    row, hashes, count = bag
    out = np.zeros(len(left))
    most = int(max(left.max(initial=-1), right.max(initial=-1))) + 1
    at = np.searchsorted(row, np.arange(most + 1))
    sizes = (at[left + 1] - at[left]) + (at[right + 1] - at[right])
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum() + 1, 1 << 19))
    for i, j in zip(cuts, [*cuts[1:], len(left)], strict=True):
        if i == j:
            continue
        first, last = np.r_[at[left[i:j]], at[right[i:j]]], np.r_[at[left[i:j] + 1], at[right[i:j] + 1]]
        n = last - first
        item = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        pair = np.repeat(np.r_[np.arange(j - i), np.arange(j - i)], n)
        order = np.lexsort((hashes[item], pair))
        pair, h, c = pair[order], hashes[item][order], count[item][order]
        same = np.flatnonzero((pair[1:] == pair[:-1]) & (h[1:] == h[:-1]))
        shared = np.bincount(pair[same], np.minimum(c[same], c[same + 1]), j - i)
        out[i:j] = shared / np.maximum(np.bincount(pair, c, j - i) - shared, 1)
    return out


def similarities(left, right, shingle: int) -> np.ndarray:
    """Weighted Jaccard similarity of the shingle multisets of two columns of texts, row by row."""
    (r1, h1, c1), (r2, h2, c2) = bags(left, shingle), bags(right, shingle)
    n = len(left)
    row, hashes, count = np.r_[r1, r2], np.r_[h1, h2], np.r_[c1, c2]
    order = np.lexsort((hashes, row))
    row, hashes, count = row[order], hashes[order], count[order]
    same = np.flatnonzero((row[1:] == row[:-1]) & (hashes[1:] == hashes[:-1])) if len(row) else np.zeros(0, np.int64)
    shared = np.bincount(row[same], np.minimum(count[same], count[same + 1]), n)
    total = np.bincount(row, count, n) - shared
    return np.where(total > 0, shared / np.maximum(total, 1), 0.0)


#: A text: the least doc_id and row of those with its words.
_NODE = "struct<doc_id:long,rid:long>"


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, bands: int = 32, rows: int = 4, block_texts: int = 2000) -> DataFrame:
    """Classes of near-duplicate documents: doc_id, class_id, keeps and rid for each row of ``docs``.

    Two texts are linked if the multisets of their runs of ``shingle`` words (split by white
    space) have a weighted Jaccard similarity of at least ``similarity``; a class is what links
    connect, class_id its least doc_id, and ``keeps`` marks its first row by doc_id.  Rows with
    equal multisets are one text from the start.  Candidates share a band of ``rows`` registers
    (of ``bands`` bands a pair of 0.8 misses all with a probability under 1e-7) and every link is
    verified on the texts.  Each bucket has a head, the text with most mates in all buckets.
    Each text meets the one head with which it shares most buckets, then the heads of its other
    buckets that are in other classes, then, where a bucket still holds several classes, the
    texts of its surroundings in blocks of similar size, about ``block_texts`` texts each, where
    a pair's registers allow the similarity.
    Null texts and texts without words are in no class but their own, texts under ``shingle``
    words are one shingle, an empty table gives an empty result; further columns are not read.
    ``docs`` is read several times, see ``with_row_id``.
    """
    folder = shared_folder(docs.sparkSession)
    docs = with_row_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    sketched = written(docs.mapInArrow(lambda it: sketch(it, shingle, bands * rows), "doc_id long, rid long, a long, b long, n long, registers binary"), "sketches", folder)
    n = sketched.count()
    texts = sketched.groupBy("a", "b", "n").agg(F.min(F.struct("doc_id", "rid")).alias("node"))
    members = written(sketched.select("doc_id", "rid", "a", "b", "n").join(texts, ["a", "b", "n"]).select("doc_id", "rid", "node"), "members", folder, n)
    own = written(sketched.join(members.where("rid = node.rid").select("rid", "node"), "rid").select("node", "n", "registers"), "texts", folder, n)
    band = F.expr(f"transform(sequence(0, {bands - 1}), i -> xxhash64(i, substring(registers, i * {2 * rows} + 1, {2 * rows})))")
    placed = own.select("node", "n", F.explode(band).alias("band"))
    sizes = placed.groupBy("band").agg(F.count("*").alias("times")).where("times > 1")
    buckets = written(placed.join(sizes, "band"), "buckets", folder, n)
    # the text with most mates in all buckets is nearest to what a family of copies was made from
    mates = buckets.groupBy("node").agg(F.sum("times").alias("mates"))
    heads = buckets.select("node", "n", "band").join(mates, "node").groupBy("band").agg(F.max(F.struct("mates", "node", "n")).alias("head"))
    buckets = written(buckets.select("node", "n", "band").join(heads, "band"), "headed", folder, n)
    met = buckets.where((F.col("node") != F.col("head.node")) & (F.least("n", "head.n") >= similarity * F.greatest("n", "head.n")))
    met = met.groupBy(F.col("node").alias("x"), F.col("head.node").alias("y")).agg(F.count("*").alias("shared"), F.max("head.mates").alias("mates"))
    met = written(met, "met", folder, n)
    first = met.groupBy("x").agg(F.max(F.struct("shared", "mates", "y")).alias("best")).select("x", "best.y")
    links = written(_verified(docs, first, shingle, similarity), "links", folder, n)
    classes = components(links, f"{folder}/first", n)
    # the other heads, as far as they are in other classes and the registers allow the similarity
    rest = met.join(first.withColumnRenamed("y", "tried"), "x").where("y != tried").select("x", "y")
    rest = _apart(rest, classes)
    rest = _likely(rest, own, similarity, bands * rows)
    links = written(links.unionByName(_verified(docs, rest, shingle, similarity)), "more_links", folder, n)
    classes = components(links, f"{folder}/second", n)
    at = buckets.select("node", "band", F.col("head.node").alias("y")).join(classes, "node", "left").select("node", "band", "y", F.coalesce("least", "node").alias("class"))
    at = written(at, "classed", folder, n)
    mixed = at.groupBy("band").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi").select("band")
    joined = written(at.join(mixed, "band", "left_semi").select(F.col("node").alias("x"), "y", "class"), "mixed", folder, n)
    groups = components(joined.where("x != y").select("x", "y").distinct(), f"{folder}/groups", n)
    found = _in_blocks(docs, own, joined, groups, shingle, similarity, block_texts, bands * rows)
    links = written(links.unionByName(found), "all_links", folder, n)
    labels = components(links, f"{folder}/last", n)
    classed = members.join(labels, "node", "left").select("rid", F.coalesce("least", "node").alias("first"))
    out = docs.select("doc_id", "rid").join(classed, "rid", "left")
    alone = F.col("first").isNull()
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"), (alone | (F.col("first.rid") == F.col("rid"))).alias("keeps"), "rid")


def _apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose ends are in different classes; a node without a row is a class of its own."""
    for end in ("x", "y"):
        pairs = pairs.join(classes.select(F.col("node").alias(end), F.col("least").alias(f"{end}_class")), end, "left")
    return pairs.where(F.coalesce("x_class", "x") != F.coalesce("y_class", "y")).select("x", "y")


def _needed(similarity: float, registers: int) -> float:
    """Share of equal registers that a pair of that similarity falls below with a probability under 1e-5."""
    return similarity - 4.3 * (similarity * (1 - similarity) / registers) ** 0.5


def _likely(pairs: DataFrame, own: DataFrame, similarity: float, registers: int) -> DataFrame:
    """The pairs whose registers allow the similarity."""
    need = _needed(similarity, registers)

    def run(batches):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u2").reshape(-1, registers) for c in ("registers", "other"))
            yield batch.select(["x", "y"]).filter(pa.array((left == right).mean(1) >= need))

    signed = own.select("node", "registers")
    both = pairs.join(signed.withColumnRenamed("node", "x"), "x").join(signed.select(F.col("node").alias("y"), F.col("registers").alias("other")), "y")
    return both.select("x", "y", "registers", "other").mapInArrow(run, f"x {_NODE}, y {_NODE}")


def _in_blocks(docs: DataFrame, own: DataFrame, joined: DataFrame, groups: DataFrame, shingle: int, similarity: float, block_texts: int, registers: int) -> DataFrame:
    """Links x, y between different classes of one group (what shared buckets connect).

    A size step holds the texts that may be similar enough by their number of shingles; texts go
    to the blocks of their own and the next lower step, and steps of many texts or long ones are
    cut into parts, each pair of which is a block of its own.
    """
    nodes = joined.select(F.col("x").alias("node"), "class").distinct().join(groups, "node").join(own, "node")
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / similarity)))
    placed = nodes.withColumn("step", F.explode(F.array(step, step - 1)))
    # a block holds the shingles of two parts, at 16 bytes each
    many = F.greatest(F.count("*") / F.lit(block_texts), F.sum("n") / F.lit(1 << 20))
    sizes = placed.groupBy("least", "step").agg(F.ceil(many).alias("parts"), F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi").drop("lo", "hi")
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    cut = placed.join(sizes, ["least", "step"]).withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    blocks = cut.select("node", "class", "n", "registers", F.struct("least", "step", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")).alias("block"))
    need = _needed(similarity, registers)

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x, y = _links_of_block(table, shingle, similarity, need)
        node = table.column("node").combine_chunks()
        return pa.table({"x": node.take(pa.array(x, pa.int64())), "y": node.take(pa.array(y, pa.int64()))})

    texts = docs.select(F.col("rid").alias("__rid"), "text")
    return blocks.join(texts, F.col("node.rid") == F.col("__rid")).drop("__rid").groupBy("block").applyInArrow(search, f"x {_NODE}, y {_NODE}").distinct()


def _links_of_block(table: pa.Table, shingle: int, similarity: float, need: float) -> tuple[list[int], list[int]]:
    """Links that join classes, as rows of the block: the likeliest pairs first, until no pair of two classes is left."""
    n = np.asarray(table.column("n"))
    registers = np.frombuffer(b"".join(table.column("registers").to_pylist()), ">u2").reshape(len(n), -1).astype(np.uint16)
    names = table.column("class").combine_chunks().field("rid")
    label = np.unique(np.asarray(names), return_inverse=True)[1].astype(np.int64)
    left, right, equal = [], [], []
    for i in range(0, len(n), 64):
        same = (registers[i : i + 64, None] == registers[None, i:]).mean(2)
        p, q = np.nonzero(same >= need)
        q = q + i
        ok = (p + i < q) & (label[p + i] != label[q]) & (np.minimum(n[p + i], n[q]) >= similarity * np.maximum(n[p + i], n[q]))
        left.append(p[ok] + i)
        right.append(q[ok])
        equal.append(same[p[ok], q[ok] - i])
    x, y, score = np.concatenate(left), np.concatenate(right), np.concatenate(equal)
    bag: list = []
    for i, part in enumerate(table.column("text").combine_chunks().to_pylist() if len(x) else []):
        _, h, c = bags(pa.array([part]), shingle)
        bag.append((np.full(len(h), i), h, c))
    found_x, found_y, most = [], [], 3
    order = np.argsort(-score, kind="stable")
    x, y = x[order], y[order]
    while len(x):
        # the best few pairs of each text
        ends, at = np.r_[x, y], np.r_[np.arange(len(x)), np.arange(len(x))]
        line = np.lexsort((at, ends))
        begin = np.r_[True, ends[line][1:] != ends[line][:-1]]
        rank = np.arange(len(line)) - np.maximum.accumulate(np.where(begin, np.arange(len(line)), 0))
        turn = np.zeros(len(x), bool)
        turn[at[line[rank < most]]] = True
        near = overlaps(tuple(np.concatenate(c) for c in zip(*bag, strict=True)), x[turn], y[turn]) >= similarity - 1e-12
        for a, b in zip(x[turn][near], y[turn][near], strict=True):
            if label[a] != label[b]:
                found_x.append(int(a))
                found_y.append(int(b))
                label[label == label[b]] = label[a]
        left_over = ~turn & (label[x] != label[y])
        x, y, most = x[left_over], y[left_over], most * 3
    return found_x, found_y


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, but for the later members of each class.

    ``docs`` is read several times, see ``with_row_id``.
    """
    rid = fresh("__rid", docs)
    later = near_duplicates(docs, **options).where("NOT keeps").select(F.col("rid").alias(rid))
    return with_row_id(docs, rid).join(later, rid, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def _verified(docs: DataFrame, pairs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs whose texts are similar enough."""

    def run(batches):
        for batch in small_batches(batches):
            near = similarities(batch.column("text"), batch.column("other"), shingle) >= similarity - 1e-12
            yield batch.select(["x", "y"]).filter(pa.array(near))

    texts = docs.select("rid", "text")
    with_x = pairs.select("x", "y", F.col("x.rid").alias("rid")).join(texts, "rid").drop("rid")
    both = with_x.join(texts.select("rid", F.col("text").alias("other")), F.col("y.rid") == F.col("rid"))
    return both.select("x", "y", "text", "other").mapInArrow(run, f"x {_NODE}, y {_NODE}")


def components(links: DataFrame, folder: str, rows: int | None = None) -> DataFrame:
    """node, least: the least node that links (x, y) connect each node to.

    Each round passes the label of every node's label to its neighbours and to the nodes that
    these have as labels, so trees are hooked at their roots and halved at the same time.
    """
    edges = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    edges = written(edges, "edges", folder, rows)
    n = edges.count()
    labels = written(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("least")), "labels0", folder, n, 1 << 16)
    turn = 0
    while True:
        turn += 1
        far = labels.join(labels.select(F.col("node").alias("least"), F.col("least").alias("far")), "least").select("node", "least", "far")
        passed = edges.join(far.select(F.col("node").alias("y"), F.col("far").alias("new")), "y").groupBy("x").agg(F.min("new").alias("new"))
        known = far.join(passed.withColumnRenamed("x", "node"), "node").select("node", "least", F.least("far", "new").alias("new"))
        hooked = known.select(F.explode(F.array(F.struct("node", "new"), F.struct(F.col("least").alias("node"), F.col("new")))).alias("s")).select("s.*")
        new = labels.withColumnRenamed("least", "old").join(hooked.groupBy("node").agg(F.min("new").alias("least")), "node")
        new = written(new, f"labels{turn}", folder, n, 1 << 16)
        labels = new.select("node", "least")
        if new.where("old != least").isEmpty():
            return labels
