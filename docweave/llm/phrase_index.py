"""Benchmark decontamination: a positional inverted index and phrase search, in DataFrame operations.

The terms of the benchmark are counted in the training texts; each phrase is then sought from its
rarest term and the term behind it, and the index stores the postings (term, next term, row,
place) of those rarest terms.  A list, shifted by its term's place in the phrase, gives candidate
starts; the other terms are compared in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import fresh, shared_folder, with_row_id, written

#: What separates words after A-Z are lower-cased (fixed values of the contract).
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased; null has none."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.filter(F.split(lower, _BETWEEN), lambda x: x != ""), F.array().cast("array<string>"))


def phrases(items: DataFrame, length: int) -> DataFrame:
    """Windows of ``length`` words of each item; an item of fewer words, but not none, is one window.

    One row for each different window: words, items (the sorted different item_ids as text).
    """
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (length - 1), F.lit(1)))
    windows = words.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, length))).alias("words"))
    return windows.groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def postings(numbered: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, next, rid, pos) of every occurrence of the given terms in ``numbered`` (rid, text)."""
    w = words_of(F.col("text"))
    tokens = numbered.select("rid", w.alias("w")).select("rid", F.posexplode(F.arrays_zip(F.col("w").alias("term"), F.slice("w", 2, F.size("w")).alias("next"))).alias("pos", "t"))
    return tokens.select(F.col("t.term").alias("term"), F.col("t.next").alias("next"), "rid", "pos").join(terms, "term", "left_semi")


def counts_of(numbered: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often each of the terms occurs in ``numbered`` (text); counted before the shuffle."""
    tokens = numbered.select(F.explode(words_of(F.col("text"))).alias("term"))
    return tokens.join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """For each window its rarest term that has a neighbour behind it: term, next, place, words, items.

    Windows with a term that no text has cannot occur and are left out.
    """
    terms = windows.select("words", "items", F.posexplode("words").alias("k", "term")).join(counts, "term")
    usable = F.when((F.col("k") < F.size("words") - 1) | (F.size("words") == 1), F.struct("n", "k", "term"))
    best = terms.groupBy("words").agg(F.min(usable).alias("best"), F.count("*").alias("known"), F.first("items").alias("items")).where(F.col("known") == F.size("words"))
    return best.select(F.col("best.term").alias("term"), F.get("words", F.col("best.k") + 1).alias("next"), F.col("best.k").alias("k"), "words", "items")


def find_phrases(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """Marks the words of ``docs`` that lie in an occurrence of a window of ``items``.

    Returns for each row of ``docs`` its columns and n_words, n_hit (words in any occurrence),
    items (sorted item_ids, as text, with occurring windows), and spans (start and words of each
    occurrence).  Null and empty texts have no words; repeated rows are judged each; null or
    empty items have no windows; of equally rare terms the first in the window is sought; an
    empty table of either kind gives no hits; columns of ``docs`` with one of these four names
    are replaced, all others are kept.  ``docs`` is read several times, see ``with_row_id``.
    """
    folder = shared_folder(docs.sparkSession)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "n_hit", "items", "spans")]
    rid, at, seen, hit = (fresh(c, docs) for c in ("__rid", "__c", "__w", "__hits"))
    docs = with_row_id(docs, rid)
    numbered = docs.select(F.col(rid).alias("rid"), "text")
    windows = written(phrases(items, length), "phrases", folder)
    n = windows.count()
    terms = windows.select(F.explode("words").alias("term")).distinct()
    sought = written(anchors(windows, counts_of(numbered, terms)), "anchors", folder, n)
    index = written(postings(numbered, sought.select("term").distinct()), "postings", folder)
    # items of one word have no term behind theirs
    alone = F.size("words") == 1
    met = index.join(sought.where(~alone), ["term", "next"]).select("rid", "pos", "k", "words", "items")
    met = met.unionByName(index.join(sought.where(alone).drop("next"), "term").select("rid", "pos", "k", "words", "items"))
    found = met.where(F.col("pos") >= F.col("k")).select("rid", F.struct((F.col("pos") - F.col("k")).alias("start"), "words", "items").alias("c"))
    found = found.groupBy(F.col("rid").alias(rid)).agg(F.collect_list("c").alias(at))
    out = docs.join(found, rid, "left").withColumn(seen, words_of(F.col("text")))
    hits = F.filter(F.coalesce(F.col(at), F.array()), lambda c: F.slice(F.col(seen), c["start"] + 1, F.size(c["words"])) == c["words"])
    out = out.withColumn(hit, hits)
    places = F.array_distinct(F.flatten(F.transform(hit, lambda c: F.sequence(c["start"], c["start"] + F.size(c["words"]) - 1))))
    return out.select(
        *own,
        F.size(seen).cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform(hit, lambda c: c["items"])))).alias("items"),
        F.transform(hit, lambda c: F.struct(c["start"].alias("start"), c["words"].alias("words"))).alias("spans"),
    )


def find_near(docs: DataFrame, items: DataFrame, length: int = 10, slop: int = 5) -> DataFrame:
    """Proximity matches: (doc_id, words) where the two rarest terms of a window are as far apart as in it, give or take ``slop`` words."""
    folder = shared_folder(docs.sparkSession)
    numbered = with_row_id(docs.select("doc_id", "text"))
    windows = written(phrases(items, length).where(F.size("words") > 1), "phrases", folder)
    counts = counts_of(numbered, windows.select(F.explode("words").alias("term")).distinct())
    terms = windows.select("words", F.posexplode("words").alias("k", "term")).join(counts, "term")
    rare = terms.groupBy("words").agg(F.array_sort(F.collect_list(F.struct("n", "k", "term"))).alias("r")).where(F.size("r") > 1)
    rare = written(rare.select("words", F.col("r")[0].alias("x"), F.col("r")[1].alias("y")), "rare", folder)
    index = written(postings(numbered, rare.select(F.explode(F.array("x.term", "y.term")).alias("term")).distinct()), "postings", folder)
    shifted = lambda end: index.join(rare.select("words", f"{end}.term", F.col(f"{end}.k").alias("k")), "term").select("rid", "words", (F.col("pos") - F.col("k")).alias(f"at_{end}"))
    x = shifted("x").withColumn("cell", F.explode(F.array(*(F.floor(F.col("at_x") / (slop + 1)) + d for d in (-1, 0, 1)))))
    y = shifted("y").withColumn("cell", F.floor(F.col("at_y") / (slop + 1)))
    near = x.join(y, ["rid", "words", "cell"]).where(F.abs(F.col("at_x") - F.col("at_y")) <= slop).select("rid", "words").distinct()
    return numbered.select("rid", "doc_id").join(near, "rid").select("doc_id", "words")


#: The result of op6 in DuckDB's SQL.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, list_slice(ws, i, i + 9) AS win FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT doc_id, n, i, list_slice(ws, i, i + n - 1) AS win FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM d, sizes WHERE len(ws) >= n)),
h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (win)),
p AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS i FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""
