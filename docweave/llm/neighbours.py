"""Nearest neighbours by multiprobe p-stable hashing.

Each table hashes a vector by ``bits`` random projections cut into slots of one width with a
random shift (p-stable hashing for the Euclidean distance).  A query visits, in each table, a set
number of buckets: its own and those that differ from it by a slot up or down in some of the
projections, in the order of their estimated success.  That is the sum of the squared distances
from its projections to the perturbed slots, as Gaussian projections make it the log-likelihood
that a near vector lies there.  The candidates of all tables are merged and ranked by exact inner
products.

For the largest inner product all vectors get one more component that makes their lengths equal;
the nearest by Euclidean distance then have the largest inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm import rolling
from docweave.llm.common import shared_folder, written


@dataclass
class Tables:
    """Hash functions and number of probes; of bounded size, sent with the tasks."""

    planes: np.ndarray  # table, bit, component
    shifts: np.ndarray  # table, bit
    width: float
    longest: float
    probes: int = 1

    def project(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """vector, table, bit: projections in slot widths; queries have no extra component."""
        extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0.0, self.longest**2 - (vectors**2).sum(1)))
        if query:
            lengths = np.linalg.norm(vectors, axis=1)
            vectors = vectors * (self.longest / np.where(lengths > 0, lengths, 1))[:, None]
        full = np.concatenate([vectors, extra[:, None]], 1)
        tables, bits, size = self.planes.shape
        flat = full @ self.planes.reshape(-1, size).T
        return flat.reshape(len(full), tables, bits) / self.width + self.shifts

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """vector, table: the bucket of each vector, as a number."""
        slots = np.floor(self.project(vectors, False)).astype(np.int64)
        return np.stack([bucket_number(slots[:, t], t) for t in range(slots.shape[1])], 1)

    def visited(self, vectors: np.ndarray, probes: int | None = None) -> np.ndarray:
        """query, table, probe: the buckets that each query visits, the likeliest first."""
        x = self.project(vectors, True)
        return np.stack([bucket_number(perturbed(x[:, t], probes or self.probes), t) for t in range(x.shape[1])], 1)


def bucket_number(slots: np.ndarray, table: int) -> np.ndarray:
    """A number for the slots along the last axis; where two buckets share one they are searched together."""
    out = np.full(slots.shape[:-1], np.uint64(table + 1))
    for b in range(slots.shape[-1]):
        out = rolling.mix(out * np.uint64(0x9E3779B97F4A7C15) + slots[..., b].astype(np.uint64))
    return out.view(np.int64)


def block_of(numbers: np.ndarray, blocks: int) -> np.ndarray:
    return (rolling.mix(numbers.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def perturbed(x: np.ndarray, probes: int) -> np.ndarray:
    """query, probe, bit: the slots of the ``probes`` buckets with the least squared distance from each query, nearest first.

    Each projection stays in its slot or goes one down or up.  The best sets of steps over the
    first projections are extended by one projection at a time; as no step has a negative cost,
    a set that is not among the best so far can't lead to one of the best in the end.
    """
    base = np.floor(x)
    down, up = (x - base) ** 2, (base + 1 - x) ** 2
    score, steps = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
    for b in range(x.shape[1]):
        score = np.concatenate([score, score + down[:, b, None], score + up[:, b, None]], 1)
        steps = np.concatenate([steps, steps + 3**b, steps + 2 * 3**b], 1)
        if score.shape[1] > probes:
            best = np.argpartition(score, probes - 1, 1)[:, :probes]
            score, steps = np.take_along_axis(score, best, 1), np.take_along_axis(steps, best, 1)
    steps = np.take_along_axis(steps, np.argsort(score, 1, kind="stable"), 1)
    moves = np.array([0, -1, 1])
    return np.stack([base[:, None, b].astype(np.int64) + moves[steps // 3**b % 3] for b in range(x.shape[1])], 2)


def _usable(vectors: DataFrame) -> DataFrame:
    """Vectors that are not null, zero or holding null or non-finite components."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good & F.exists("embedding", lambda x: x != 0))


def fit(vectors: DataFrame, tables: int, bits: int, recall: float, k: int, sample: int, most_probes: int, seed: int) -> Tables | None:
    """Chooses slot width and number of probes on at most ``sample`` vectors, those whose hash is least."""
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size, longest = vectors.agg(F.max(F.size("embedding")), F.max(squares)).first()
    if size is None:
        return None
    rows = vectors.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample).collect()
    some = np.array([list(r[1]) + [0.0] * (size - len(r[1])) for r in rows], np.float64)
    r = np.random.default_rng(seed)
    planes = r.normal(size=(tables, bits, size + 1))
    spread = (some @ planes[:, :, :size].reshape(-1, size).T).std()
    shifts = r.uniform(size=(tables, bits))
    asked = some[: min(200, len(some))]
    exact = asked @ some.T
    exact[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    near = np.argsort(-exact, 1)[:, : min(k, max(1, len(some) - 1))]
    for width in (2.0, 3.0, 4.0, 6.0, 9.0):  # the finest slots with which so many probes suffice
        found = Tables(planes, shifts, max(width * float(spread), 1e-9), longest**0.5)
        turn = np.sort(_turns(found, asked, some, near, most_probes), axis=None)
        found.probes = min(int(turn[max(0, int(np.ceil(recall * turn.size)) - 1)]) + 1, most_probes)
        if found.probes < most_probes:
            break
    return found


def _turns(found: Tables, asked: np.ndarray, some: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """The probe that finds each neighbour, in the table where that is first; ``most`` if none does."""
    home, turn = found.buckets(some), np.full(near.shape, most)
    for i in range(0, len(asked), 50):
        for q, probes in enumerate(found.visited(asked[i : i + 50], most)):
            for t, numbers in enumerate(probes):
                order = np.argsort(numbers, kind="stable")
                wanted = home[near[i + q], t]
                at = order[np.minimum(np.searchsorted(numbers, wanted, sorter=order), len(order) - 1)]
                turn[i + q] = np.minimum(turn[i + q], np.where(numbers[at] == wanted, at, most))
    return turn


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, tables: int = 6, bits: int = 10, recall: float = 0.92, sample: int = 4000, most_probes: int = 4096, block_rows: int = 8192, seed: int = 5) -> DataFrame:
    """The ``k`` nearest of ``vectors`` for each of ``queries``: query_id, rank, vec_id, score.

    Nearness is the inner product of the original vectors in double precision, ties to the
    smaller vec_id; a query's own vec_id is no candidate.  Both tables have vec_id and embedding.
    Every vector is indexed; only the slot width and the number of probes, at most
    ``most_probes`` for each table, come from a sample of ``sample`` vectors, enough for
    ``recall`` on it.  A query whose buckets hold fewer than ``k`` others is compared with all.
    Vectors that are null, zero, or hold null or non-finite components take no part; where
    lengths differ, missing components count as zero.  Repeated rows (same vec_id and components)
    count once, of different vectors with one vec_id the nearest counts.  Of equal vectors only
    the k + 1 smallest vec_ids are indexed, as no others can be among the nearest.  Empty tables
    give an empty result; further columns are not read.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    folder = shared_folder(spark)
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" == dict(queries.dtypes)["embedding"] else "array<double>"
    vectors, queries = (_usable(d.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))) for d in (vectors, queries))
    found = fit(vectors, tables, bits, recall, k, sample, most_probes, seed)
    if found is None:
        return spark.createDataFrame([], schema)
    size = found.planes.shape[2] - 1

    def matrix(lists: pa.Array) -> np.ndarray:
        if (np.asarray(lists.value_lengths()) == size).all():
            return np.asarray(lists.flatten()).astype(np.float64).reshape(-1, size)
        return np.array([(x + [0.0] * size)[:size] for x in lists.to_pylist()], np.float64).reshape(-1, size)

    def place(batches) -> Iterator[pa.RecordBatch]:
        """Each vector once for each table, with its bucket."""
        for batch in batches:
            if batch.num_rows:
                for numbers in found.buckets(matrix(batch.column("embedding"))).T:
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(numbers)), batch.column("vec_id"), batch.column("embedding")], names=["bucket", "vec_id", "embedding"])

    def visit(batches, blocks: int) -> Iterator[pa.RecordBatch]:
        """Each query once for each block (of ``blocks``, 0 if each bucket is one), with the buckets it visits there."""
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                numbers = found.visited(matrix(part.column("embedding"))).reshape(part.num_rows, -1)
                for query, own in enumerate(np.sort(numbers, 1)):
                    block = block_of(own, blocks) if blocks else own
                    order = np.argsort(block, kind="stable")
                    first = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0])
                    lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(own)].astype(np.int32)), pa.array(own[order]))
                    at = pa.array(np.full(len(first), query))
                    yield pa.RecordBatch.from_arrays([pa.array(block[order][first]), *(part.column(c).take(at) for c in ("vec_id", "embedding")), lists], names=["block", "vec_id", "embedding", "buckets"])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        """Exact inner products of a block's queries with the vectors of the buckets they visit: the k best of each query."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if left.num_rows and right.num_rows:
            left, right = left.combine_chunks(), right.combine_chunks()
            order = np.argsort(np.asarray(left.column("bucket")), kind="stable")
            bucket, vec_id = (np.asarray(left.column(c))[order] for c in ("bucket", "vec_id"))
            v = matrix(left.column("embedding").chunk(0))[order]
            by_id = np.argsort(vec_id, kind="stable")
            starts = np.flatnonzero(np.r_[True, vec_id[by_id][1:] != vec_id[by_id][:-1]])
            for batch in right.to_batches(max_chunksize=256):
                q, own = matrix(batch.column("embedding")), np.asarray(batch.column("vec_id"))
                lists = batch.column("buckets")
                row, asked = np.repeat(np.arange(len(q)), np.asarray(lists.value_lengths())), np.asarray(lists.flatten())
                line = np.argsort(asked, kind="stable")
                row, asked = row[line], asked[line]
                product = np.full((len(q), len(v)), -np.inf)
                names, first = np.unique(asked, return_index=True)
                begin, end = np.searchsorted(bucket, names, "left"), np.searchsorted(bucket, names, "right")
                for a, z, i, j in zip(first, [*first[1:], len(asked)], begin, end, strict=True):
                    if i < j:  # only the vectors of buckets that are visited are compared
                        product[row[a:z], i:j] = q[row[a:z]] @ v[i:j].T
                product[own[:, None] == vec_id[None, :]] = -np.inf
                # each id's greatest product, so that vectors of one id take one of the k places
                most = product if len(starts) == len(vec_id) else np.maximum.reduceat(product[:, by_id], starts, axis=1)
                # the matrix product may differ in its last bits from the sum that is returned
                least = np.partition(most, -k, 1)[:, -k, None] - 1e-9 if most.shape[1] > k else -np.inf
                r, c = np.nonzero((product >= least) & (product > -np.inf))
                out.append(_best(own[r], vec_id[c], np.concatenate([(q[r[i : i + 65536]] * v[c[i : i + 65536]]).sum(1) for i in range(0, len(r), 65536)] or [np.zeros(0)]), k))
        query, ids, scores = map(np.concatenate, zip(*out, strict=True))
        first = np.flatnonzero(np.r_[True, np.diff(query) != 0]) if len(query) else np.zeros(0, np.int64)
        hits = pa.ListArray.from_arrays(pa.array(np.r_[first, len(query)].astype(np.int32)), pa.StructArray.from_arrays([pa.array(ids), pa.array(scores)], ["vec_id", "score"]))
        return pa.table({"query_id": pa.array(query[first]), "hits": hits})

    # a row for each of at most k + 1 ids of a vector; Spark limits each group before it is shuffled
    alike = Window.partitionBy("embedding").orderBy("vec_id")
    single = vectors.distinct().withColumn("n", F.row_number().over(alike)).where(F.col("n") <= k + 1).drop("n")
    left = written(single.mapInArrow(place, f"bucket long, vec_id long, embedding {kind}"), "vectors", folder)
    asked = queries.distinct()
    # blocks hold some buckets each, and there are some tens of them however few vectors there are
    count = left.count()
    block_rows = min(block_rows, max(512, count // 64))
    blocks = max(1, -(-count // block_rows))
    nothing = F.lit(-1).cast("long")
    cell = lambda block, part, share: F.struct(block.alias("block"), part.alias("part"), share.alias("share")).alias("cell")
    visits = asked.mapInArrow(lambda it: visit(it, blocks), f"block long, vec_id long, embedding {kind}, buckets array<long>")
    visits = visits.select(cell(F.col("block"), nothing, nothing), "vec_id", "embedding", "buckets")
    # a large bucket is cut into parts of its own, and the queries that visit it into shares
    large = written(left.groupBy("bucket").agg(F.count("*").alias("rows")).where(F.col("rows") > block_rows), "large", folder)
    if large.isEmpty():
        inside = left
    else:
        inside = left.join(large.select("bucket"), "bucket", "left_anti")

    def with_block(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(block_of(np.asarray(batch.column("bucket")), blocks)), *batch.columns], names=["block", *batch.schema.names])

    placed = inside.mapInArrow(with_block, f"block long, bucket long, vec_id long, embedding {kind}").select(cell(F.col("block"), nothing, nothing), "bucket", "vec_id", "embedding")
    if not large.isEmpty():
        probes = asked.mapInArrow(lambda it: visit(it, 0), f"bucket long, vec_id long, embedding {kind}, buckets array<long>").join(large, "bucket")
        probes = written(probes, "probes", folder)
        shares = probes.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(block_rows)).alias("shares"))
        cut = large.join(shares, "bucket").withColumn("parts", F.ceil(F.col("rows") / F.lit(block_rows))).drop("rows")
        salt = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        more = left.join(cut, "bucket").withColumn("share", every("shares"))
        placed = placed.unionByName(more.select(cell(F.col("bucket"), salt("parts"), F.col("share")), "bucket", "vec_id", "embedding"))
        more = probes.drop("rows").join(cut, "bucket").withColumn("part", every("parts"))
        visits = visits.unionByName(more.select(cell(F.col("bucket"), F.col("part"), salt("shares")), "vec_id", "embedding", "buckets"))
    answer = "query_id long, hits array<struct<vec_id:long,score:double>>"
    hits = placed.groupBy("cell").cogroup(visits.groupBy("cell")).applyInArrow(search, answer)
    hits = written(_ranked(hits.select("query_id", F.inline("hits")), k), "hits", folder)
    # queries whose buckets hold fewer than k others meet all vectors, block by block
    full = hits.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = written(asked.join(full, "vec_id", "left_anti"), "short", folder)
    if not short.isEmpty():
        spread = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
        left = single.select(spread.alias("cell"), F.lit(0).cast("long").alias("bucket"), "vec_id", "embedding")
        visits = short.select("vec_id", "embedding", F.array(F.lit(0).cast("long")).alias("buckets"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks).cast("long") - 1)).alias("cell"))
        rest = left.groupBy("cell").cogroup(visits.select("vec_id", "cell", "buckets", "embedding").groupBy("cell")).applyInArrow(search, answer)
        hits = _ranked(hits.select("query_id", "vec_id", "score").unionByName(rest.select("query_id", F.inline("hits"))), k)
    return hits


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each query, each id once."""
    merged = hits.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the k ids with the greatest scores, ties to the smaller id, each id once."""
    order = np.lexsort((-scores, ids, query))
    query, ids, scores = query[order], ids[order], scores[order]
    once = np.r_[True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])] if len(ids) else np.zeros(0, bool)
    query, ids, scores = query[once], ids[once], scores[once]
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    start = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(start, np.diff(np.r_[start, len(query)]))
    return query[rank < k], ids[rank < k], scores[rank < k]
