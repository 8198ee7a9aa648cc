"""Merging results into documents. Updates are keyed by document id; documents without one stay as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import values


def _merged(docs: DataFrame, updates: DataFrame, column: str, step, fields: list[str], key: str, order: str | None) -> DataFrame:
    """Applies the updates of each document one after the other, by ``order`` (by their values where none is given).

    ``step`` makes the column's new value from the old one and an update.
    """
    first = [F.col(order).alias("__order")] if order else []
    held = updates.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*first, *fields))).alias("__updates"))
    new = F.aggregate("__updates", F.col(column), step)
    joined = docs.join(held, key, "left")
    return joined.withColumn(column, F.when(F.col("__updates").isNotNull(), new).otherwise(F.col(column))).select(*docs.columns)


def last_updates(updates: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of several updates of one key, the last; of equal texts in a row before it, the earliest, as later ones change nothing."""
    at = Window.partitionBy(*keys).orderBy(order)
    runs = updates.withColumn("__new", (~F.col("content").eqNullSafe(F.lag("content").over(at))).cast("int")).withColumn("__run", F.sum("__new").over(at.rowsBetween(Window.unboundedPreceding, 0)))
    best = runs.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in updates.columns if c not in keys]), F.struct(-F.col("__run"), F.col(order))).alias("__u"))
    return best.select(*keys, "__u.*")


def upsert_translations(docs: DataFrame, translations: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """translations: (id, translation); the first element of the language pair is replaced, else append."""
    return _merged(docs, translations, "content_translated", lambda old, u: values.upsert(old, u["translation"]), ["translation"], key, order)


def append_translations(docs: DataFrame, translations: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    return _merged(docs, translations, "content_translated", lambda old, u: values.append(old, u["translation"]), ["translation"], key, order)


def put_translation_map(docs: DataFrame, translations: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """translations: (id, language, content) for the older layout with a map of language to text."""
    return _merged(docs, translations, "content_translated", lambda old, u: values.map_put(old, u["language"], u["content"]), ["language", "content"], key, order)


def add_tags(docs: DataFrame, tags: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """tags: (id, tag)."""
    return _merged(docs, tags, "tags", lambda old, u: values.set_add(old, u["tag"]), ["tag"], key, order)


def update_content(docs: DataFrame, contents: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """contents: (id, content); of several the last counts."""
    return _merged(docs, contents, "content", lambda old, u: u["content"], ["content"], key, order)


def merge_manifests(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("project", "doc_id")) -> DataFrame:
    """Artifact manifests: (project, doc_id, entries map of type to JSON); the new entries win, other types stay."""
    left, right = old.withColumnRenamed("entries", "__old"), new.withColumnRenamed("entries", "__new")
    kept = F.map_filter(F.coalesce("__old", F.create_map().cast("map<string,string>")), lambda k, _: ~F.coalesce(F.array_contains(F.map_keys("__new"), k), F.lit(False)))
    return left.join(right, list(keys), "full").select(*keys, F.map_concat(kept, F.coalesce("__new", F.create_map().cast("map<string,string>"))).alias("entries"))
