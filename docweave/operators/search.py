"""Exact nearest rows by cosine distance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.values import cosine_distance


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 2, most_queries: int | None = None, block_queries: int = 10_000) -> DataFrame:
    """query_id, doc_id, distance, rank of the ``k`` nearest vectors to each query.

    Blocks of about ``block_queries`` queries are broadcast over blocks of vectors; the rank filter
    is applied in each task before the shuffle.  Only a caller that states ``most_queries`` has
    longer query sets refused.
    """
    asked = queries.count()
    if most_queries is not None and asked > most_queries:
        raise ValueError(f"more than {most_queries} queries; send them in parts")
    blocks = max(1, -(-asked // block_queries))
    found = None
    for i in range(blocks):
        # rows of one query_id stay in one block
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i)
        ranked = _nearest(vectors, part, k)
        found = ranked if found is None else found.unionByName(ranked)
    return found


def _nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    pairs = vectors.select("doc_id", "vector").crossJoin(F.broadcast(queries.select("query_id", F.col("vector").alias("__q"))))
    scored = pairs.select("query_id", "doc_id", cosine_distance(F.col("__q"), F.col("vector")).alias("distance"))
    order = Window.partitionBy("query_id").orderBy("distance", "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
