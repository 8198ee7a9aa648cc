"""Files to page images before detection: images as they are, PDFs page by page, all others through a converter first."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import media
from docweave.plans.plugins import CACHE, captured

_ERROR = "struct<title:string,detail:string>"


def _per_file(df: DataFrame, kind: str, config: dict[str, Any], method: str, result: str, concurrency: int) -> DataFrame:
    """id, result and error of (id, content); ``concurrency`` files of a batch at a time, errors kept by file."""
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for frame in frames:
                call: Callable = captured(getattr(CACHE.get(kind, config), method))
                found = list(pool.map(lambda c: call(bytes(c)) if c is not None else (None, "MissingContent", "the file has no content"), frame["content"]))
                yield pd.DataFrame({"id": frame["id"].to_numpy(), "result": [x[0] for x in found], "error": [None if x[1] is None else {"title": x[1], "detail": x[2]} for x in found]})

    return df.select("id", "content").mapInPandas(run, f"id string, result {result}, error {_ERROR}")


def convert_with(df: DataFrame, config: dict[str, Any], concurrency: int = 10) -> DataFrame:
    """id, result (the PDF's bytes) and error of (id, content); a converter waits for others, so several run at a time."""
    return _per_file(df, "converter", config, "convert", "binary", concurrency)


def pages_with(df: DataFrame, config: dict[str, Any], concurrency: int = 1) -> DataFrame:
    """id, result (the images of its pages) and error of (id, content)."""
    return _per_file(df, "paginator", config, "pages", "array<binary>", concurrency)


def page_images(files: DataFrame, images: list[str], documents: list[str], converter: dict[str, Any] | None = None, pdf: dict[str, Any] | None = None, image: dict[str, Any] | None = None) -> tuple[DataFrame, DataFrame]:
    """(id, page_number, image) and (id, error) of (id, content_type, content) files.

    Pages are numbered from 1.  A file that no category takes, can't be converted or can't be
    read is an error row; it doesn't stop the others.
    """
    ways = media.with_category(files, images, documents).select("id", "category", "content")
    made = convert_with(ways.where("category = 'to_pdf'"), converter or {"model": "PRINT"})
    pdfs = ways.where("category = 'pdf'").select("id", "content").unionByName(made.where("error IS NULL").select("id", F.col("result").alias("content")))
    read = pages_with(pdfs, pdf or {"model": "FORM_FEED"}).unionByName(pages_with(ways.where("category = 'image'"), image or {"model": "FRAMES"}))
    pages = read.where("error IS NULL").select("id", F.posexplode("result").alias("pos", "image"))
    errors = made.select("id", "error").unionByName(read.select("id", "error")).where("error IS NOT NULL")
    return pages.select("id", (F.col("pos") + 1).alias("page_number"), "image"), errors.unionByName(media.unsupported(files, images, documents).select("id", "error"))
