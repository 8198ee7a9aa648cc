"""What several operators share: stable row ids, hashing, shared scratch folders and batch helpers."""

from __future__ import annotations

import hashlib
import re
import tempfile
import time
import uuid
from collections.abc import Iterable

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share.

    Where the setting is missing a local folder serves in local mode (tests); on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docweave-")
    folder = f"{base.rstrip('/')}/docweave-{uuid.uuid4().hex}"
    _folders.append(folder)
    return folder


#: Scratch folders handed out and not dropped yet.
_folders: list[str] = []


def scratch_mark() -> int:
    return len(_folders)


def drop_scratch(spark: SparkSession, mark: int) -> None:
    """Removes the scratch folders handed out since ``mark``; for when all results that read them are written."""
    for folder in _folders[mark:]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    del _folders[mark:]


def written(df: DataFrame, name: str, folder: str, rows: int | None = None, per_file: int = 1 << 13) -> DataFrame:
    """Cuts lineage: the rows are written to the shared folder and read back.

    ``rows``, if known, keeps small tables from being spread over many small files: there are
    as many tasks as cores, or one for each ``per_file`` of ``rows``, where that is fewer than
    the plan has.
    """
    path = f"{folder}/{name}"
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_file)))
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    give_back(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: When the driver's JVM last gave memory back.
_given_back = 0.0


def give_back(spark: SparkSession, every: float = 2.0) -> str:
    """Has the driver's JVM return to the system what its native allocator holds unused; gives the JVM's report.

    Each plan is compiled by threads that leave freed memory in their arenas, which otherwise grow
    with the number of plans.  Called again within ``every`` seconds, or where the JVM has no such
    command, it does nothing and the report is empty.
    """
    global _given_back
    if time.monotonic() - _given_back < every:
        return ""
    _given_back = time.monotonic()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    try:
        # by reflection, as Py4J finds no method of the server's own class, which is not public
        names = ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")
        kinds, args = gateway.new_array(jvm.java.lang.Class, len(names)), gateway.new_array(jvm.java.lang.Object, len(names))
        for i, name in enumerate(names):
            kinds[i] = jvm.java.lang.Class.forName(name)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds)
        return str(invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args) or "")
    except Py4JError:
        return ""


def fresh(name: str, df: DataFrame) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _is_scan(plan) -> bool:
    """Whether each row of the plan is one row of files."""
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan.children().isEmpty()


def with_row_id(docs: DataFrame, name: str = "rid") -> DataFrame:
    """Numbers rows by a long in a column ``name``, alike in every evaluation and never twice.

    Rows of files have the number of their file, of all in order of name, and their place in it,
    however the files are split among tasks (2**23 files of 2**40 rows).  Rows of anything else
    are numbered by partition and place, so those tables must give the same rows in the same
    partitions each time they are evaluated; write them first if they don't.
    """
    plan = docs._jdf.queryExecution().analyzed()
    if not (_is_scan(plan) and "_metadata" in plan.metadataOutput().toString()):
        return docs.withColumn(name, F.monotonically_increasing_id())
    meta, path = docs.metadataColumn("_metadata"), fresh("__path", docs)
    # a row for each file, as the driver lists them for the scan anyway
    names = sorted(r[0] for r in docs.select(meta["file_path"]).distinct().collect())
    if len(names) <= 1:
        return docs.withColumn(name, meta["row_index"])
    number = fresh("__file", docs)
    numbers = docs.sparkSession.range(1).select(F.posexplode(F.split(F.lit("\0".join(names)), "\\x00")).alias(number, path))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != name]
    place = fresh("__place", docs)
    there = docs.select(*kept, meta["file_path"].alias(path), meta["row_index"].alias(place))
    return there.join(F.broadcast(numbers), path).select(*kept, (F.col(number) * F.lit(1 << 40) + F.col(place)).alias(name))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def small_batches(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = 1 << 20):
    """Cuts batches so that each has about ``most`` bytes of text (a longer text stays whole).

    What Arrow's pool holds unused is given back after each batch, as idle workers keep it otherwise.
    """
    from docweave.llm.rolling import slices, text_buffers

    for batch in batches:
        if batch.num_rows:
            _, offsets = text_buffers(batch.column(text))
            for a, z in slices(offsets, most):
                for i in range(a, z, 1 << 15):
                    yield batch.slice(i, min(z - i, 1 << 15))
        pa.default_memory_pool().release_unused()
