"""Work batches: order-dependent folds over documents, without a global sort in one task.

Every operator takes an integral order column that is unique within a stream.  Running sums go
over blocks of that column: totals of blocks (pre-aggregated), a running sum of the totals, then
running sums inside the blocks, so no task holds more than a block of rows or one row a block.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a block in values of the order column.
BLOCK = 1 << 16


def running_sums(df: DataFrame, streams: list[str], order: str, sums: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """Adds for each name the sum of its expression over the stream's rows up to this one."""
    keys = [*streams, "__block"]
    part = df.withColumns({"__block": F.floor(F.col(order) / block), **{f"__v_{n}": e for n, e in sums.items()}})
    totals = part.groupBy(*keys).agg(*(F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums))
    before = Window.partitionBy(*streams).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, *(F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in sums))
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = part.join(totals, keys)
    return joined.withColumns({n: F.sum(f"__v_{n}").over(inside) + F.col(f"__b_{n}") for n in sums}).select(*df.columns, *sums)


def row_numbers(df: DataFrame, streams: list[str], order: str, block: int = BLOCK) -> DataFrame:
    """Adds rn, from 1."""
    return running_sums(df, streams, order, {"rn": F.lit(1)}, block)


def by_length(df: DataFrame, length: str, limit: int, streams: list[str], order: str) -> DataFrame:
    """Length batching: adds batch_id.

    The running length is never reset, so once it is over ``limit`` each further document is a
    batch of its own; a first document over the limit is in batch 1, as batch 0 is then empty.
    """
    summed = running_sums(df, streams, order, {"__cum": F.col(length)})
    return running_sums(summed, streams, order, {"batch_id": (F.col("__cum") > limit).cast("long")}).drop("__cum")


def by_length_reset(df: DataFrame, length: str, limit: int, streams: list[str], order: str) -> DataFrame:
    """Length batching as intended: a batch is closed before the document that would pass the limit.

    A sequential fold in one task for each stream over its orders and lengths alone.
    """
    slim = df.select(*streams, F.col(order).alias("__o"), F.col(length).cast("long").alias("__n"))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*(f"`{s}` {kinds[s]}" for s in streams), "__o long", "batch_id long"])

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__o")
        batch, held, out = 0, 0, []
        for i, n in enumerate(rows["__n"]):
            if i and held + n > limit:
                batch, held = batch + 1, 0
            held += n
            out.append(batch)
        return rows.assign(batch_id=out)[[*streams, "__o", "batch_id"]]

    ids = slim.groupBy(*streams).applyInPandas(fold, schema)
    return df.join(ids.withColumnRenamed("__o", order), [*streams, order])


def by_pages(df: DataFrame, pages: str, target: int, streams: list[str], order: str, block: int = BLOCK) -> DataFrame:
    """Greedy page batching: adds batch_id.

    A batch is closed before a document if it has at least ``target`` pages, so every batch has a
    document and may overshoot.  The fold's state is the pages held, of which all from ``target``
    up act alike; each block of documents gives its outcome for every state in which it may begin,
    the outcomes are chained along the stream, and the blocks run again from their true state.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    keys = [*streams, "__block"]
    slim = df.select(*streams, F.floor(F.col(order) / block).alias("__block"), F.col(order).cast("long").alias("__o"), F.greatest(F.col(pages), F.lit(0)).cast("long").alias("__n"))
    columns = ", ".join([*(f"`{s}` {kinds[s]}" for s in streams), "__block long"])

    def step(state: int, n: int) -> tuple[int, int]:
        closed = int(state >= target)
        return closed, min(target, (0 if closed else state) + n)

    def outcomes(rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        state, closed = np.arange(target + 1), np.zeros(target + 1, np.int64)
        for n in rows.sort_values("__o")["__n"]:
            full = state >= target
            closed += full
            state = np.minimum(target, np.where(full, 0, state) + n)
        return rows[keys].head(1).assign(closed=[closed.tolist()], state=[state.tolist()])

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows, state, batch, out = rows.sort_values("__block"), 0, 0, []
        for closed, after in zip(rows["closed"], rows["state"], strict=True):
            out.append((batch, state))
            batch, state = batch + int(closed[state]), int(after[state])
        return rows[keys].assign(__batch=[b for b, _ in out], __state=[s for _, s in out])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__o")
        batch, state, out = int(rows["__batch"].iloc[0]), int(rows["__state"].iloc[0]), []
        for n in rows["__n"]:
            closed, state = step(state, int(n))
            batch += closed
            out.append(batch)
        return rows.assign(batch_id=out)[[*keys, "__o", "batch_id"]]

    made = slim.groupBy(*keys).applyInPandas(outcomes, f"{columns}, closed array<long>, state array<long>")
    begin = made.groupBy(*streams).applyInPandas(chain, f"{columns}, __batch long, __state long")
    ids = slim.join(begin, keys).groupBy(*keys).applyInPandas(run, f"{columns}, __o long, batch_id long")
    return df.join(ids.drop("__block").withColumnRenamed("__o", order), [*streams, order])


def by_document_runs(pages: DataFrame, document: str, target: int, streams: list[str], order: str) -> DataFrame:
    """Inference batching: greedy batching of runs of pages of one document, never cutting a run; adds batch_id."""
    firsts = Window.partitionBy(*streams, document).orderBy(order)
    begins = pages.withColumn("__new", (F.col(order) - F.lag(order).over(firsts) != 1).cast("int"))
    # a run begins where the document's page before it isn't the one before in the stream
    runs = begins.withColumn("__run", F.sum(F.coalesce("__new", F.lit(0))).over(firsts.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = runs.groupBy(*streams, document, "__run").agg(F.count("*").alias("__n"), F.min(order).alias("__first"))
    ids = by_pages(sizes, "__n", target, streams, "__first").select(*streams, document, "__run", "batch_id")
    return runs.join(ids, [*streams, document, "__run"]).select(*pages.columns, "batch_id")


def by_characters(df: DataFrame, length: str, target: int, streams: list[str], order: str) -> DataFrame:
    """Bulk batching: a bulk begins at each document, but for the first, of at least ``target`` characters; adds batch_id.

    The size counter of a bulk never grows, so small documents never close one.
    """
    numbered = row_numbers(df, streams, order)
    return running_sums(numbered, streams, order, {"batch_id": ((F.col("rn") > 1) & (F.col(length) >= target)).cast("long")}).drop("rn")


def by_characters_counted(df: DataFrame, length: str, target: int, streams: list[str], order: str) -> DataFrame:
    """Bulk batching as intended: a bulk is closed before the document that would bring it to ``target``."""
    return by_length_reset(df, length, target - 1, streams, order)


def by_count(df: DataFrame, size: int, streams: list[str], order: str) -> DataFrame:
    """Chunks of ``size`` documents of each stream; adds batch_id."""
    return row_numbers(df, streams, order).withColumn("batch_id", F.floor((F.col("rn") - 1) / size)).drop("rn")


def micro_batches(sentences: DataFrame, size: int, batch: str = "batch_id", order: str = "seq") -> DataFrame:
    """Chunks of ``size`` sentences of each batch, which cross its documents but never the batch's end; adds micro_batch."""
    return row_numbers(sentences, [batch], order).withColumn("micro_batch", F.floor((F.col("rn") - 1) / size)).drop("rn")


def group_batches(df: DataFrame, per_task: int, batch: str = "batch_id") -> DataFrame:
    """Batches of one activity; adds task_id."""
    return df.withColumn("task_id", F.floor(F.col(batch) / per_task))


def shards(batch: Column, offset: Column, prefix: str = "batch_", per_shard: int = 1000) -> Column:
    """Path of a batch file whose ids go on after ``offset`` earlier ones."""
    number = batch + offset
    return F.concat(F.floor(number / per_shard).cast("string"), F.lit(f"/{prefix}"), number.cast("string"), F.lit(".jsonl"))
