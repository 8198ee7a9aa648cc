"""Media types of file extensions, from the standard library's table and aliases."""

from __future__ import annotations

import mimetypes

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Extensions read as another one (fixed values).
ALIASES = {
    ".nxml": ".xml", ".dclg": ".xml", ".dclg_xml": ".xml", ".dclg.xml": ".xml", ".qmd": ".md", ".rmd": ".md", ".xbrl": ".html", ".j2c": ".jp2", ".j2k": ".jp2", ".jpc": ".jp2",
    ".jpf": ".jp2", ".jpx": ".jp2", ".rgba": ".png", ".svm": ".wmf", ".uof": ".xml", ".uop": ".xml", ".uos": ".xml", ".uot": ".xml",
}
#: Extensions with further types beside the standard one (fixed values).
MORE = {".jpg": ["image/jpg"], ".xml": ["text/xml", "application/xml"], ".md": ["text/markdown"], ".jp2": ["image/jp2"], ".wmf": ["image/wmf"], ".docx": ["application/vnd.openxmlformats-officedocument.wordprocessingml.document"], ".odt": ["application/vnd.oasis.opendocument.text"], ".wav": ["audio/x-wav", "audio/wav"]}
#: Content types that are transcribed (fixed values).
AUDIO_TYPES = [
    "audio/aac", "audio/aiff", "audio/mp4", "audio/mpeg", "audio/ogg", "audio/vnd.wave", "audio/wav", "audio/wave", "audio/x-wav", "audio/x-pn-wav", "video/mp4", "video/mpeg", "video/mov",
]
#: Formats that are left out although their libraries read them (fixed values).
NOT_IMAGES = [".bw", ".ftu", ".iim", ".im", ".msp"]
NOT_TO_PDF = [".602", ".bib", ".cwk", ".fopd", ".hwp", ".key", ".met", ".mw", ".odd", ".pwp"]


def types_of(extension: str, files: tuple[str, ...] = ()) -> list[str]:
    """Sorted media types of an extension; an unknown one raises.

    ``files`` are tables in the usual form of mime.types files, for extensions that the standard library lacks.
    """
    name = ALIASES.get(extension, extension)
    known = mimetypes.MimeTypes(filenames=files).types_map
    found = ({known[True][name]} if name in known[True] else set()) | set(MORE.get(name, []))
    if not found:
        raise ValueError(f"no media type is known for the extension {extension}")
    return sorted(found)


def table(spark: SparkSession, files: tuple[str, ...] = ()) -> DataFrame:
    """extension, content_type; a dimension of the size of the tables it is made from."""
    known = mimetypes.MimeTypes(filenames=files).types_map
    names = sorted(set(known[True]) | set(ALIASES) | set(MORE))
    return spark.createDataFrame([(e, m) for e in names for m in types_of(e, files)], "extension string, content_type string")


def categories(images: list[str], documents: list[str]) -> dict[str, list[str]]:
    """Which extensions go which way: pdf as it is, images, and what is converted to pdf first."""
    pictures = [e for e in images if e != ".pdf" and e not in NOT_IMAGES]
    others = [e for e in documents if e not in images or e == ".pdf"]
    return {"pdf": [".pdf"], "image": pictures, "to_pdf": [e for e in others if e not in NOT_TO_PDF and e != ".pdf"]}


def category_table(spark: SparkSession, images: list[str], documents: list[str]) -> DataFrame:
    rows = [(name, e, m) for name, extensions in categories(images, documents).items() for e in extensions for m in types_of(e)]
    return spark.createDataFrame(rows, "category string, extension string, content_type string")


def with_category(df: DataFrame, images: list[str], documents: list[str]) -> DataFrame:
    """Adds the first fitting category (pdf, image, to_pdf) of content_type; others drop out."""
    ways = category_table(df.sparkSession, images, documents)
    rank = F.when(F.col("category") == "pdf", 0).when(F.col("category") == "image", 1).otherwise(2)
    ways = ways.groupBy("content_type").agg(F.min_by("category", rank).alias("category"))
    return df.join(F.broadcast(ways), "content_type")


def unsupported(df: DataFrame, images: list[str], documents: list[str]) -> DataFrame:
    """An error row for each file that no category takes: the file's columns, and error (title and detail)."""
    ways = category_table(df.sparkSession, images, documents).select("content_type").distinct()
    left = df.join(F.broadcast(ways), "content_type", "left_anti")
    detail = F.concat(F.lit("files of type "), F.coalesce("content_type", F.lit("unknown")), F.lit(" can't be read"))
    return left.select(*df.columns, F.struct(F.lit("UnsupportedFile").alias("title"), detail.alias("detail")).alias("error"))
