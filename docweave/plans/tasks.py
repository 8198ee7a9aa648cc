"""Tasks and their states as a table: create, list, update, result and error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "id string, name string, args string, state string, result string, error string, progress double, created_at timestamp, completed_at timestamp, retries_left int, max_retries int"
#: States of a task, and those in which it stays (fixed values).
STATES = ["CREATED", "QUEUED", "RUNNING", "ERROR", "DONE", "CANCELLED"]
TERMINAL = ["ERROR", "DONE", "CANCELLED"]


def create(tasks: DataFrame, new: DataFrame) -> DataFrame:
    """Adds tasks (id, name, args, created_at); ids that exist stay as they are."""
    rows = new.join(tasks.select("id"), "id", "left_anti")
    for f in tasks.schema.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit("CREATED" if f.name == "state" else None).cast(f.dataType))
    return tasks.unionByName(rows.select(*tasks.columns))


def update(tasks: DataFrame, changes: DataFrame) -> DataFrame:
    """changes: (id, state, result, error, progress, completed_at); tasks in a terminal state don't change."""
    columns = ["state", "result", "error", "progress", "completed_at"]
    joined = tasks.join(changes.select("id", *(F.col(c).alias(f"__{c}") for c in columns)), "id", "left")
    frozen = F.col("state").isin(TERMINAL)
    new = {c: F.when(frozen, F.col(c)).otherwise(F.coalesce(f"__{c}", c)) for c in columns}
    return joined.select(*(new[c].alias(c) if c in new else F.col(c) for c in tasks.columns))


def pending(tasks: DataFrame) -> DataFrame:
    return tasks.where(~F.coalesce(F.col("state").isin(TERMINAL), F.lit(False)))
