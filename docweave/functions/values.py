"""Arrays, texts, progress and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def set_add(tags: Column, tag: Column) -> Column:
    """``tags`` with ``tag`` behind them unless they have it; null is empty."""
    have = F.coalesce(tags, F.array().cast("array<string>"))
    return F.when(F.array_contains(have, tag), have).otherwise(F.array_append(have, tag))


def append(items: Column, item: Column) -> Column:
    return F.when(items.isNull(), F.array(item)).otherwise(F.array_append(items, item))


def upsert(items: Column, item: Column) -> Column:
    """Translation upsert: the first element of the same language pair is replaced, unless its content is equal; else append."""
    same = lambda t: (t["source_language"] == item["source_language"]) & (t["target_language"] == item["target_language"])
    at = F.array_position(F.transform(items, lambda t: F.coalesce(same(t), F.lit(False))), F.lit(True))
    put = F.transform(items, lambda t, i: F.when((i == at - 1) & ~t["content"].eqNullSafe(item["content"]), item).otherwise(t))
    return F.when(items.isNull(), F.array(item)).when(at > 0, put).otherwise(F.array_append(items, item))


def map_put(items: Column, key: Column, value: Column) -> Column:
    """The map with ``key`` set to ``value``; null is empty."""
    one = F.create_map(key, value)
    return F.when(items.isNull(), one).otherwise(F.map_concat(F.map_filter(items, lambda k, v: k != key), one))


def translations_of_map(source_language: Column, items: Column, translator: str = "unknown") -> Column:
    """The older layout, a map of language to text, as an array of translations in order of language."""
    entries = F.array_sort(F.map_entries(items))
    return F.transform(entries, lambda e: F.struct(source_language.alias("source_language"), e["key"].alias("target_language"), F.lit(translator).alias("translator"), e["value"].alias("content")))


def content_in(language: Column, own: Column, content: Column, translations: Column) -> Column:
    """A document's content in a language: its own, or the first translation to it, or null."""
    return F.when(own == language, content).otherwise(F.get(F.filter(translations, lambda t: t["target_language"] == language), 0)["content"])


def content_in_map(language: Column, own: Column, content: Column, items: Column) -> Column:
    return F.when(own == language, content).otherwise(F.try_element_at(items, language))


def classified_tag(model: str, label: Column) -> Column:
    return F.concat(F.lit(f"classified:{model}:"), label)


def confidence(score: Column) -> Column:
    return F.exp(score)


def sentences(text: Column) -> Column:
    """Parts between line ends and full stops followed by a space; the stand-in sentence splitter."""
    return F.filter(F.split(text, r"\. |\n"), lambda s: s != "")


def progress_fraction(current: Column, most: Column) -> Column:
    return F.when(most == 0, F.lit(0.0)).otherwise(current / most)


def progress_scaled(progress: Column, start: float = 0.0, end: float = 1.0) -> Column:
    if not 0 <= start < end:
        raise ValueError(f"a progress scale starts at 0 or later and before its end, not at {start} of {end}")
    if not start < end <= 1.0:
        raise ValueError(f"a progress scale ends at 1 at the latest, not at {end}")
    return F.lit(start) + progress * (end - start)


def dot(a: Column, b: Column) -> Column:
    double = lambda x: F.transform(x, lambda v: v.cast("double"))
    return F.aggregate(F.zip_with(double(a), double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
