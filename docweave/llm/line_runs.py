"""Line dedup: a suffix array over line numbers by distributed prefix doubling, in DataFrame operations.

Every line that occurs twice gets a rank in the order of its hash; all others end their suffixes.
Each doubling round ranks suffixes by the pair (own rank, rank of the suffix ``step`` lines on),
and drops those whose pair is alone, as no longer common prefix can hold them.  When ranks stand
for ``min_lines`` lines, suffixes of one rank are an interval of the suffix array whose common
prefix is at least that long: the places of a repeated run.  Its first place stays; the lines of
the others are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import fresh, shared_folder, with_row_id, written


def dedup_line_runs(docs: DataFrame, min_lines: int = 2, min_chars: int = 250) -> DataFrame:
    """Deletes the later copies of repeated runs of at least ``min_lines`` lines, or of one line of ``min_chars`` characters.

    Lines end at ``\\n``; blank ones (nothing but white space) are no part of a run, do not
    interrupt it and stay.  Copies are ordered by doc_id, then row, then line; a run is judged on
    the input.  Returns the columns of ``docs`` for each of its rows with the kept lines as text,
    and n_lines (lines with content) and n_removed.  A null text stays null with no lines; an
    empty text stays empty; of repeated rows the first stays; an empty table gives an empty
    result; further columns are passed on (n_lines and n_removed are replaced).  ``docs`` is read
    several times, see ``with_row_id``.
    """
    folder = shared_folder(docs.sparkSession)
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rid, cut = fresh("__rid", docs), fresh("__gone", docs)
    docs = with_row_id(docs.select(*(F.col(f"`{c}`") for c in own)), rid)
    content = lambda x: F.trim(F.regexp_replace(x, r"\s", " ")) != ""
    line = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    lines = docs.select(F.col(rid).alias("rid"), "doc_id", F.posexplode(F.filter(line, lambda s: content(s["line"]))).alias("i", "l"))
    # two hashes, so that equal keys mean equal lines at any size
    key = F.struct(F.xxhash64("l.line").alias("a"), F.xxhash64(F.lit("line"), "l.line").alias("b"))
    long = (F.length("l.line") >= min_chars).alias("long")
    suffixes = written(lines.select("rid", "doc_id", "i", F.col("l.pos").alias("pos"), long, key.alias("key")), "lines", folder)
    n = suffixes.count()
    active, length = _ranked(suffixes, folder, 1, n), 1
    alone = active.where("long AND NOT first").select("rid", "i")
    while length < min_lines:
        step = min(length, min_lines - length)
        ahead = active.select("rid", (F.col("i") - step).alias("i"), F.col("rank").alias("then"))
        pairs = active.withColumnRenamed("rank", "own").join(ahead, ["rid", "i"])
        length += step
        active = _ranked(pairs.select("rid", "doc_id", "i", "pos", "long", F.struct("own", "then").alias("key")), folder, length, n)
    later = active.where("NOT first").select("rid", F.explode(F.sequence("i", F.col("i") + (min_lines - 1))).alias("i"))
    later = later.unionByName(alone).distinct()
    gone = later.join(suffixes.select("rid", "i", "pos"), ["rid", "i"]).groupBy(F.col("rid").alias(rid)).agg(F.array_sort(F.collect_list("pos")).alias(cut))
    out = docs.join(gone, rid, "left")
    split, n_gone = F.split("text", "\n"), F.coalesce(F.size(cut), F.lit(0)).cast("long").alias("n_removed")
    n_lines = F.coalesce(F.size(F.filter(split, content)), F.lit(0)).cast("long").alias("n_lines")
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(F.array_join(_without(split, F.col(cut)), "\n")).alias("text")
    return out.select(*(text if c == "text" else F.col(f"`{c}`") for c in own), n_lines, n_gone)


def _ranked(suffixes: DataFrame, folder: str, length: int, rows: int) -> DataFrame:
    """Ranks suffixes by key; those with a key of their own go.  ``first`` marks each interval's first place."""
    place = F.struct("doc_id", "rid", "i")
    intervals = suffixes.groupBy("key").agg(F.count("*").alias("times"), F.min(place).alias("head")).where("times > 1")
    ranks = intervals.sort("key").select("key", "head", F.monotonically_increasing_id().alias("rank"))
    ranks = written(ranks, f"ranks{length}", folder, rows, 1 << 18)
    found = suffixes.join(ranks, "key").select("rid", "doc_id", "i", "pos", "long", "rank", (place == F.col("head")).alias("first"))
    return written(found, f"suffixes{length}", folder, rows, 1 << 18)


def _without(items: Column, gone: Column) -> Column:
    """``items`` without the places in the sorted array ``gone``, in time linear in both."""
    before = lambda j: F.when(j == 0, F.lit(-1)).otherwise(F.get(gone, j - 1))
    marks = F.flatten(F.transform(gone, lambda x, j: F.concat(F.array_repeat(F.lit(False), x - before(j) - 1), F.array(F.lit(True)))))
    return F.transform(F.filter(F.arrays_zip(items.alias("item"), marks.alias("mark")), lambda s: ~F.coalesce(s["mark"], F.lit(False))), lambda s: s["item"])


#: The result of op10 in DuckDB's SQL, for min_lines = 2 and min_chars = 250.
ORACLE_SQL = r"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM l WHERE trim(regexp_replace(line, '\s', ' ', 'g')) <> ''),
w AS (SELECT doc_id, i, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM n),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY line, nxt ORDER BY doc_id, i) AS r FROM w WHERE nxt IS NOT NULL),
gone AS (SELECT doc_id, i FROM f WHERE r > 1 UNION SELECT doc_id, i + 1 FROM f WHERE r > 1
  UNION SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS r FROM n WHERE length(line) >= 250) WHERE r > 1),
m AS (SELECT l.doc_id, l.pos, l.line, n.i, gone.i AS g FROM l LEFT JOIN n USING (doc_id, pos) LEFT JOIN gone ON gone.doc_id = n.doc_id AND gone.i = n.i),
a AS (SELECT doc_id, count(i) AS n_lines, count(g) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE g IS NULL), '') AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE sha256(kept) END AS kept_sha256
FROM documents d LEFT JOIN a USING (doc_id)
"""
