"""Taking documents apart and putting them together in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def explode_parts(df: DataFrame, parts: Column, name: str = "part") -> DataFrame:
    """A row for each part with its place from 0; rows without parts vanish."""
    return df.select(*df.columns, F.posexplode(parts).alias("pos", name))


def explode_pages(df: DataFrame, pages: str = "n_pages") -> DataFrame:
    """A row for each page, numbered from 1; files without pages vanish."""
    return df.where(F.col(pages) > 0).select(*df.columns, F.explode(F.sequence(F.lit(1), F.col(pages))).alias("page_number"))


def join_parts(df: DataFrame, keys: list[str], part: str = "part", pos: str = "pos", separator: str = " ") -> DataFrame:
    """Parts of each key in order, joined; a document's parts meet in one task, which its length bounds."""
    ordered = F.array_sort(F.collect_list(F.struct(pos, part)))
    return df.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x[part]), separator).alias("content"), F.count("*").alias("n_parts"))


def speaker_text(df: DataFrame, keys: list[str], order: str, text: str = "text", speaker: str = "speaker", inner: str = "\n", outer: str = "\n\n") -> DataFrame:
    """Transcript text: segments of one speaker in a row joined by ``inner``, these by ``outer``; a missing speaker is one too."""
    at = Window.partitionBy(*keys).orderBy(order)
    change = (~F.col(speaker).eqNullSafe(F.lag(speaker).over(at)) & (F.row_number().over(at) > 1)).cast("int")
    runs = df.withColumn("__change", change).withColumn("__run", F.sum("__change").over(at.rowsBetween(Window.unboundedPreceding, 0)))
    texts = runs.groupBy(*keys, "__run").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), inner).alias("__text"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__run", "__text"))), lambda x: x["__text"]), outer)
    return texts.groupBy(*keys).agg(whole.alias("content"), F.count("*").alias("n_paragraphs"))


def pages_of_documents(pages: DataFrame, detections: str = "detections", failed: str = "failed") -> DataFrame:
    """One artifact row for each document with a page that was read: status and the pages with detections in order.

    A document is partial if any of its pages failed; one whose every page failed has no row.
    """
    good = F.when(~F.col(failed), F.struct("page_number", detections))
    found = pages.groupBy("id").agg(F.array_sort(F.collect_list(good)).alias("__pages"), F.max(F.col(failed).cast("int")).alias("__bad"), F.sum((~F.col(failed)).cast("long")).alias("n_success_pages")).where("n_success_pages > 0")
    return found.select("id", F.when(F.col("__bad") == 1, "partial").otherwise("complete").alias("status"), F.filter("__pages", lambda p: F.size(p[detections]) > 0).alias("pages"), "n_success_pages")


def models_by_language(models: DataFrame) -> DataFrame:
    """(model, languages) turned round: language and its sorted models."""
    return models.select("model", F.explode("languages").alias("language")).groupBy("language").agg(F.sort_array(F.collect_list("model")).alias("models"))


def zip_results(inputs: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """Results beside their inputs by place (batch and position); a place that only one side has, or has twice, fails the query."""
    def once(df: DataFrame, mark: str) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        one = df.groupBy(*keys).agg(F.count("*").alias("__n"), F.first(F.struct(*rest)).alias(mark))
        return one.withColumn(mark, F.when(F.col("__n") == 1, F.col(mark)).otherwise(_refused(df.schema, rest, "several rows for one place", keys))).drop("__n")

    def _refused(schema, rest, message, keys):
        kind = "struct<" + ",".join(f"`{c}`:{schema[c].dataType.simpleString()}" for c in rest) + ">"
        return F.raise_error(F.concat_ws(" ", F.lit(message), *(F.col(k).cast("string") for k in keys))).cast(kind)

    both = once(inputs, "__i").join(once(results, "__r"), keys, "full")
    for mark, df in (("__i", inputs), ("__r", results)):
        rest = [c for c in df.columns if c not in keys]
        both = both.withColumn(mark, F.when(F.col(mark).isNotNull(), F.col(mark)).otherwise(_refused(df.schema, rest, "one side has no row for place", keys)))
    return both.select(*keys, "__i.*", "__r.*")


def require_keys(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Joins ``known`` by a key that every row must find; a missing one fails the query."""
    found = df.join(known.withColumn("__found", F.lit(True)), key, "left")
    missing = F.raise_error(F.concat(F.lit("nothing is known of "), F.col(key).cast("string"))).cast("boolean")
    return found.where(F.when(F.col("__found"), F.lit(True)).otherwise(missing)).drop("__found")
