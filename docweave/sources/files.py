"""Readers and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions.paths import artifacts_dir

#: Fields of hits that each task reads (fixed values).
BATCHING_FIELDS = ["rootDocument", "language", "contentTextLength"]
#: A file to process; ``root_*`` stand for the chain of its parents.
PROCESSED_FILE = T.StructType([T.StructField(n, t) for n, t in [("id", T.StringType()), ("path", T.StringType()), ("project", T.StringType()), ("location", T.StringType()), ("resource_name", T.StringType()), ("n_pages", T.IntegerType()), ("root_id", T.StringType()), ("root_path", T.StringType()), ("root_location", T.StringType())]])


def read_documents(spark: SparkSession, path: str, fields: list[str] | None = None) -> DataFrame:
    """Documents of an index snapshot in Parquet; only ``fields`` are read if given."""
    df = spark.read.parquet(path)
    return df.select(*fields) if fields else df


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; blank lines are skipped and a bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines that aren't blank."""
    return spark.read.text(path).where(F.trim("value") != "").count()


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One object for each file."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")


def read_images(spark: SparkSession, path: str, decode=None) -> DataFrame:
    """Bytes with an error where they don't decode; bad images don't fail the read.

    ``decode`` maps bytes to anything or raises; the default looks at the signature.
    """
    def default(data: bytes) -> None:
        if not data.startswith((b"\x89PNG\r\n\x1a\n", b"\xff\xd8\xff", b"GIF8", b"BM", b"II*\x00", b"MM\x00*", b"RIFF")):
            raise ValueError("cannot identify image")

    check = decode or default

    @F.udf("struct<title:string,detail:string>")
    def error(data):
        try:
            check(bytes(data))
        except Exception as e:  # noqa: BLE001
            return type(e).__name__, str(e)
        return None

    return read_binary(spark, path).withColumn("error", error("content"))


def read_country_codes(spark: SparkSession, path: str) -> DataFrame:
    """Third column of a CSV file without a header."""
    return spark.read.csv(path).select(F.col("_c2").alias("code")).where("code IS NOT NULL")


def read_manifests(manifests: DataFrame, metadata: DataFrame) -> DataFrame:
    """Manifest of each document, or else the older metadata file's: (project, doc_id, entries, legacy)."""
    keys = ["project", "doc_id"]
    both = manifests.withColumnRenamed("entries", "__new").join(metadata.withColumnRenamed("entries", "__old"), keys, "full")
    return both.select(*keys, F.coalesce("__new", "__old").alias("entries"), F.col("__new").isNull().alias("legacy"))


def write_batches(batched: DataFrame, path: str, exclude: list[str] | None = None, batch: str = "batch_id") -> None:
    """A folder of JSON lines for each batch; nulls and ``exclude`` are left out."""
    batched.drop(*(exclude or [])).repartition(batch).write.partitionBy(batch).option("ignoreNullFields", True).mode("overwrite").json(path)


def write_results(results: DataFrame, good: str, bad: str, error: str = "error") -> None:
    """Rows without and with an error, in JSON; the results are computed once."""
    held = results.persist()
    held.where(F.col(error).isNull()).drop(error).write.mode("overwrite").json(good)
    held.where(F.col(error).isNotNull()).write.mode("overwrite").json(bad)
    held.unpersist()


def replace_snapshot(df: DataFrame, root: str) -> str:
    """Writes a new version of a table beside the old ones and returns its path; nothing is overwritten while it is read."""
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def write_routed(df: DataFrame, path: str) -> None:
    """Documents partitioned by project, those of one root document together."""
    df.repartition("project", F.coalesce("rootDocument", "id")).write.mode("overwrite").partitionBy("project").parquet(path)


def upsert_artifacts(table: DataFrame, new: DataFrame) -> DataFrame:
    """Artifacts (project, doc_id, type, filename, payload, entry); the new ones replace those of their type."""
    keys = ["project", "doc_id", "type"]
    return table.join(new.select(*keys), keys, "left_anti").unionByName(new)


def artifact_paths(artifacts: DataFrame) -> DataFrame:
    return artifacts.withColumn("path", F.concat_ws("/", artifacts_dir(F.col("doc_id"), F.col("project")), F.col("filename")))
