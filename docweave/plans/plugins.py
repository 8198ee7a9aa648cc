"""Model plug-ins: a registry by kind and name, worker-side caches, and stand-ins.

The stand-ins are deterministic and meant for tests; they are not models.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_REGISTRY: dict[tuple[str, str], Callable[..., Any]] = {}


def register(kind: str, name: str):
    """Registers a plug-in class or factory; its instances have a method named after the kind's verb."""

    def wrap(factory):
        _REGISTRY[kind, name.upper()] = factory
        return factory

    return wrap


def from_config(kind: str, config: dict[str, Any]):
    """An instance from a config with a ``model`` or ``type`` key."""
    config = dict(config)
    name = str(config.pop("model", config.pop("type", ""))).upper()
    if (kind, name) not in _REGISTRY:
        raise ValueError(f"unknown {kind} {name!r}; known: {sorted(n for k, n in _REGISTRY if k == kind)}")
    return _REGISTRY[kind, name](**config)


class ResourceCache:
    """Least recently used instances in a worker, keyed by kind, config and languages."""

    def __init__(self, most: int = 4, on_evict: Callable[[Any], None] | None = None):
        self.most, self.on_evict, self._held = most, on_evict, OrderedDict()

    def get(self, kind: str, config: dict[str, Any], *languages: str):
        key = (kind, json.dumps(config, sort_keys=True), languages)
        if key not in self._held:
            self._held[key] = from_config(kind, config)
            if len(self._held) > self.most:
                _, old = self._held.popitem(last=False)
                if self.on_evict:
                    self.on_evict(old)
        self._held.move_to_end(key)
        return self._held[key]


CACHE = ResourceCache()


@register("splitter", "DEFAULT")
class WholeText:
    def split_sentences(self, text: str) -> list[str]:
        return [text]


@register("splitter", "LINES")
class Lines:
    def split_sentences(self, text: str) -> list[str]:
        return [s for line in text.split("\n") for s in line.split(". ") if s]


@register("translator", "TAGGING")
class TaggingTranslator:
    """Puts the target language before the text."""

    def __init__(self, prefix: str = "[{}] "):
        self.prefix = prefix

    def translate(self, texts: list[str], source: str, target: str) -> list[str]:
        return [self.prefix.format(target) + t for t in texts]


@register("classifier", "LENGTH")
class LengthClassifier:
    def classify(self, texts: list[str]) -> list[str]:
        return ["long" if len(t) >= 2000 else "short" for t in texts]


@register("embedder", "LETTERS")
class LetterEmbedder:
    """Shares of the letters a to z."""

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [[t.lower().count(chr(97 + i)) / max(1, len(t)) for i in range(26)] for t in texts]


@register("transcriber", "SCRIPT")
class ScriptTranscriber:
    """Reads audio as UTF-8 lines, a second each, in the three stages of a real model."""

    def preprocess(self, files: list[bytes]) -> list[Any]:
        return [captured(lambda d: d.decode("utf-8"))(d) for d in files]

    def infer(self, texts: list[str]) -> list[list[str]]:
        return [t.splitlines() for t in texts]

    def postprocess(self, found: list[list[str]]) -> list[dict[str, Any]]:
        return [{"transcription": [(float(i), float(i + 1), t) for i, t in enumerate(lines)], "score": -0.1 * len(lines)} for lines in found]


@register("extractor", "HTML")
class HtmlExtractor:
    """Tags off; pages at page breaks."""

    def extract_content(self, data: str) -> dict[str, Any]:
        import re

        if not data.strip():
            raise ValueError("no content")
        pages = [re.sub(r"\s+", " ", re.sub(r"<[^>]*>", " ", p)).strip() for p in data.split("<!-- page -->")]
        ranges, at = [], 0
        for p in pages:
            ranges.append((at, at + len(p.encode())))
            at = ranges[-1][1]
        return {"content": "".join(pages), "byte_ranges": ranges}


@register("detector", "EVERY")
class EveryNth:
    """Finds one thing on every n-th page."""

    def __init__(self, n: int = 3):
        self.n = n

    def detect(self, pages: list[int]) -> list[list[dict[str, Any]]]:
        return [[{"class_id": "passport", "confidence": 0.5}] if p % self.n == 0 else [] for p in pages]


@register("converter", "PRINT")
class Printer:
    """Stand-in for a converter to PDF: a form feed behind every ``page_length`` characters of a text."""

    def __init__(self, page_length: int = 1000):
        self.page_length = page_length

    def convert(self, data: bytes) -> bytes:
        text = data.decode("utf-8")
        if not text:
            raise ValueError("nothing to convert")
        return "\f".join(text[i : i + self.page_length] for i in range(0, len(text), self.page_length)).encode()


@register("paginator", "FORM_FEED")
class FormFeeds:
    """Stand-in for the renderer of PDF pages: parts between form feeds."""

    def pages(self, data: bytes) -> list[bytes]:
        return data.split(b"\f")


@register("paginator", "FRAMES")
class Frames:
    """Stand-in for an image reader: parts between NUL bytes are the frames of an image."""

    def pages(self, data: bytes) -> list[bytes]:
        return data.split(b"\0")


def captured(function: Callable[..., Any], known: tuple[type[BaseException], ...] = (ValueError, UnicodeError)):
    """Known errors become (None, title, detail); others fail the task."""

    def run(*args):
        try:
            return function(*args), None, None
        except known as e:
            return None, type(e).__name__, str(e)

    return run


def split_with(df: DataFrame, config: dict[str, Any], text: str = "content") -> DataFrame:
    """Adds sentences (array) by a splitter plug-in; the default needs no Python."""
    if str(config.get("model", "")).upper() == "DEFAULT":
        return df.withColumn("sentences", F.array(text))

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        model = CACHE.get("splitter", config)
        return texts.map(lambda t: model.split_sentences(t or ""))

    return df.withColumn("sentences", split(text))


def translate_with(df: DataFrame, config: dict[str, Any], target: str, text: str = "part", language: str = "language") -> DataFrame:
    """Adds translated; the model is chosen by (config, source, target), texts go to it in Arrow batches."""
    schema = T.StructType([*df.schema.fields, T.StructField("translated", T.StringType())])

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = pd.Series([None] * len(frame), index=frame.index, dtype=object)
            for source, group in frame.groupby(language, dropna=False):
                model = CACHE.get("translator", config, str(source), target)
                found = model.translate(group[text].tolist(), source, target)
                if len(found) != len(group):
                    raise ValueError("the translator gave another number of texts than it got")
                out.loc[group.index] = found
            yield frame.assign(translated=out)

    return df.mapInPandas(run, schema)


def classify_with(df: DataFrame, config: dict[str, Any], text: str = "content") -> DataFrame:
    @F.pandas_udf("string")
    def label(texts: pd.Series) -> pd.Series:
        return pd.Series(CACHE.get("classifier", config).classify(texts.fillna("").tolist()))

    return df.withColumn("label", label(text))


def embed_with(df: DataFrame, config: dict[str, Any], text: str = "content") -> DataFrame:
    @F.pandas_udf("array<float>")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series(CACHE.get("embedder", config).embed(texts.fillna("").tolist()))

    return df.withColumn("vector", vector(text))


def transcribe_with(df: DataFrame, config: dict[str, Any], data: str = "content", files_per_batch: int = 16) -> DataFrame:
    """id, segments, score and error of binary contents; no content and a missing score are errors.

    The model reads, infers and finishes ``files_per_batch`` files at a time; a file that can't be
    read is left out of the other stages, and each stage must give as many results as it got files.
    """
    schema = "id string, segments array<struct<start_s:double,end_s:double,text:string>>, score double, error struct<title:string,detail:string>"

    def stage(run, inputs: list) -> list:
        out = list(run(inputs)) if inputs else []
        if len(out) != len(inputs):
            raise ValueError(f"the transcriber gave {len(out)} results for {len(inputs)} files")
        return out

    def run(frames):
        for frame in frames:
            rows = []
            for a in range(0, len(frame), files_per_batch):
                model, some = CACHE.get("transcriber", config), frame.iloc[a : a + files_per_batch]
                read = {i: (None, "ValueError", "no content") for i, c in enumerate(some[data]) if c is None}
                there = [i for i in range(len(some)) if i not in read]
                read |= dict(zip(there, stage(model.preprocess, [bytes(some[data].iloc[i]) for i in there]), strict=True))
                good = [i for i in there if read[i][1] is None]
                done = dict(zip(good, stage(model.postprocess, stage(model.infer, [read[i][0] for i in good])), strict=True))
                for i, key in enumerate(some["id"]):
                    if i not in done:
                        rows.append((key, None, None, read[i][1:]))
                    elif done[i]["score"] is None:
                        rows.append((key, None, None, ("ValidationError", "confidence is missing")))
                    else:
                        rows.append((key, done[i]["transcription"], done[i]["score"], None))
            yield pd.DataFrame(rows, columns=["id", "segments", "score", "error"])

    return df.select("id", data).mapInPandas(run, schema)


def extract_with(df: DataFrame, config: dict[str, Any], data: str = "html") -> DataFrame:
    """id, status, content, byte_ranges, total and error of documents."""
    schema = "id string, status string, content string, byte_ranges array<array<long>>, total int, error struct<title:string,detail:string>"

    def run(frames):
        for frame in frames:
            rows = []
            for key, content in zip(frame["id"], frame[data], strict=True):
                found, title, detail = captured(CACHE.get("extractor", config).extract_content)(content or "")
                if found is None:
                    rows.append((key, "FAILURE", None, None, 0, (title, detail)))
                else:
                    rows.append((key, "SUCCESS", found["content"], [list(r) for r in found["byte_ranges"]], len(found["byte_ranges"]), None))
            yield pd.DataFrame(rows, columns=["id", "status", "content", "byte_ranges", "total", "error"])

    return df.select("id", data).mapInPandas(run, schema)


def detect_with(df: DataFrame, config: dict[str, Any]) -> DataFrame:
    """Adds detections (array of class_id and confidence) of each page."""

    @F.pandas_udf("array<struct<class_id:string,confidence:double>>")
    def found(pages: pd.Series) -> pd.Series:
        return pd.Series(CACHE.get("detector", config).detect(pages.tolist()))

    return df.withColumn("detections", found("page_number"))
