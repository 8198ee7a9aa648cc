"""Where documents and artifacts lie, as string columns with ``/`` between parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Document locations (fixed values).
FILESYSTEM, ARTIFACTS, WORKDIR = "filesystem", "artifacts", "workdir"


def safe_dir(doc_id: Column) -> Column:
    """``ab/cd`` of an id of at least four characters; shorter ids raise."""
    message = F.concat(F.lit("ids need four characters or more for their folder: "), doc_id)
    return F.when(F.length(doc_id) < 4, F.raise_error(message).cast("string")).otherwise(F.concat_ws("/", F.substring(doc_id, 1, 2), F.substring(doc_id, 3, 2)))


def artifacts_dir(doc_id: Column, project: Column) -> Column:
    return F.concat_ws("/", project, safe_dir(doc_id), doc_id)


def relative(path: Column) -> Column:
    """The path without a leading slash."""
    return F.regexp_replace(path, "^/+", "")


def document_path(doc_id: Column, project: Column, root_document: Column, path: Column) -> Column:
    """Relative path of a document's bytes: its own, or its artifact's where it is embedded (which needs a project)."""
    missing = F.raise_error(F.concat(F.lit("embedded document without index: "), doc_id)).cast("string")
    embedded = F.when(project.isNull(), missing).otherwise(F.concat_ws("/", artifacts_dir(doc_id, project), F.lit("raw")))
    return F.when(root_document.isNull(), relative(path)).otherwise(embedded)


def document_location(root_document: Column) -> Column:
    return F.when(root_document.isNull(), F.lit(FILESYSTEM)).otherwise(F.lit(ARTIFACTS))


def page_count(metadata_pages: Column) -> Column:
    return F.coalesce(metadata_pages.cast("int"), F.lit(1))


def content_length(length: Column, content: Column) -> Column:
    """The given length, or else the number of characters of a content that isn't empty."""
    return F.coalesce(length, F.when(content != "", F.length(content)))


def locate(location: Column, doc_id: Column, project: Column, path: Column, filesystem: str, artifacts: str, workdir: str) -> Column:
    """Absolute path below one of three roots; an unknown location raises."""
    return (
        F.when(location == FILESYSTEM, F.concat_ws("/", F.lit(filesystem), path))
        .when(location == ARTIFACTS, F.concat_ws("/", F.lit(artifacts), artifacts_dir(doc_id, project), F.lit("raw")))
        .when(location == WORKDIR, F.concat_ws("/", F.lit(workdir), path))
        .otherwise(F.raise_error(F.concat(F.lit("files lie in no such place: "), location)).cast("string"))
    )


def child_file(file: Column, path: Column) -> Column:
    """A file made from ``file`` at ``path`` in the workdir; the root's identity is carried along."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.struct(
        file["id"].alias("id"), path.alias("path"), file["project"].alias("project"), F.lit(WORKDIR).alias("location"), name.alias("resource_name"),
        file["n_pages"].alias("n_pages"), F.coalesce(file["root_id"], file["id"]).alias("root_id"), F.coalesce(file["root_path"], file["path"]).alias("root_path"), F.coalesce(file["root_location"], file["location"]).alias("root_location"),
    )


def route(doc_id: Column, root_document: Column) -> Column:
    return F.struct(F.coalesce(root_document, doc_id).alias("routing"), doc_id.alias("id"))


def suffix(name: Column) -> Column:
    """Extension with its dot; none for names that start or end with their only dot."""
    last = F.element_at(F.split(name, "/"), -1)
    return F.regexp_extract(last, r"^.+(\.[^.]+)$", 1)


def debug_name(path: Column, size: int = 10) -> Column:
    """First 20 hex digits of the path's sha256, and its parts cut to ``size``."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    parts = F.when(path.startswith("/"), F.concat(F.array(F.lit("/")), parts)).otherwise(parts)
    return F.concat(F.substring(F.sha2(path, 256), 1, 20), F.lit("-"), F.array_join(F.transform(parts, lambda p: F.substring(p, 1, size)), "--"))


def published_path(location: Column, doc_id: Column, project: Column, path: Column, resource_name: Column, by_name: bool) -> Column:
    """Workdir path under which an embedded document is published with its real extension.

    By resource name the file is named after the resource, else after the document's id; documents
    of the file system stay where they are.
    """
    inner = F.filter(F.split(path, "/"), lambda p: p != "")
    inner = F.array_join(F.slice(inner, 2, F.greatest(F.size(inner) - 2, F.lit(0))), "/")
    name = resource_name if by_name else F.concat(doc_id, suffix(resource_name))
    return F.when(location == FILESYSTEM, path).when(location == ARTIFACTS, F.concat_ws("/", project, F.lit("symlinks"), inner, name)).otherwise(F.raise_error(F.concat(F.lit("files can't be published from "), location)).cast("string"))


def byte_ranges_valid(ranges: Column, total: Column) -> Column:
    """Whether each (start, end) has start <= end, starts where the one before ends, and there are ``total``."""
    each = F.forall(F.transform(ranges, lambda r, i: (r[0] <= r[1]) & ((i == 0) | (r[0] == F.get(ranges, i - 1)[1]))), lambda ok: ok)
    return each & (F.size(ranges) == total)


def traceparent(trace_id: Column, parent_id: Column, sampled: Column) -> Column:
    return F.concat_ws("-", F.lit("00"), trace_id, parent_id, F.when(sampled, F.lit("01")).otherwise(F.lit("00")))


def parse_traceparent(value: Column) -> Column:
    """(trace_id, parent_id, sampled) of a version 00 trace parent, null otherwise."""
    parts = F.split(value, "-")
    return F.when((F.size(parts) == 4) & (F.get(parts, 0) == "00"), F.struct(F.get(parts, 1).alias("trace_id"), F.get(parts, 2).alias("parent_id"), (F.get(parts, 3) == "01").alias("sampled")))
