"""Boolean document queries: builders for the query form, and their compilation to columns.

A missing field never matches, and ``must_not`` lets it pass, so three-valued logic never shows.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.operators import batching

Query = dict[str, Any]


def _clause(query: Query) -> Query:
    return query["query"] if set(query) == {"query"} else query


def and_query(*queries: Query) -> Query:
    return {"query": {"bool": {"must": [_clause(q) for q in queries]}}}


def bool_query(**parts: list[Query]) -> Query:
    return {"bool": parts}


def must_not(*queries: Query) -> Query:
    return {"bool": {"must_not": [_clause(q) for q in queries]}}


def should(*queries: Query) -> Query:
    return {"bool": {"should": [_clause(q) for q in queries]}}


def has_id(ids: list[str]) -> Query:
    return {"ids": {"values": list(ids)}}


def has_type(type_field: str = "type", type_value: str = "Document") -> Query:
    return {"term": {type_field: type_value}}


def match_all() -> Query:
    return {"match_all": {}}


def has_content_type(types: list[str]) -> Query:
    """Documents of these types."""
    return and_query({"terms": {"contentType": sorted(types)}}, has_type())["query"]


def docs_query(docs: None | list[str] | Query, types: list[str]) -> Query:
    """The documents argument of detection, extraction and transcription: none, ids or a query beside the format filter."""
    base = has_content_type(types)
    if docs is None or docs == {}:
        return {"query": base}
    if isinstance(docs, dict):
        return and_query(base, docs)
    if isinstance(docs, list):
        return and_query(base, has_id(docs))
    raise ValueError(f"no query is known for the format {docs.__class__.__name__}")


def untranslated(language: str) -> Query:
    """Documents without a translation to a language (their own language may be that one)."""
    return must_not({"term": {"content_translated.target_language.keyword": language}})


def untranslated_elsewhere(language: str) -> Query:
    """Documents of other languages; the layout test on a language key never holds for arrays, so it is left out."""
    return must_not({"exists": {"field": f"content_translated.{language}"}}, {"term": {"language": language}})


def unclassified(model: str, language: str) -> Query:
    """Documents without a tag of the model whose content is known in a language."""
    known = should({"term": {"content_translated.target_language.keyword": language}}, {"term": {"language": language}})
    return {"bool": {"must_not": [{"prefix": {"tags": f"classified:{model}:"}}], "must": [known]}}


def unclassified_in_map(model: str, language: str) -> Query:
    known = should({"exists": {"field": f"content_translated.{language}"}}, {"term": {"language": language}})
    return {"bool": {"must_not": [{"prefix": {"tags": f"classified:{model}:"}}], "must": [known]}}


def translation_query(docs: None | list[str] | Query, language: str) -> Query:
    """The documents argument of translation: none is what is untranslated, a query stands for itself."""
    if docs is None:
        return untranslated(language)
    if isinstance(docs, list):
        return has_id(docs)
    return docs or match_all()


def ordered_scan(df: DataFrame, query: Query, groups: list[str], order: str = "doc_id") -> DataFrame:
    """Documents that a query finds, sorted by ``groups`` and ``order``, with each one's place (from 1) in its group as scan_pos."""
    found = batching.row_numbers(search(df, query), groups, order).withColumnRenamed("rn", "scan_pos")
    return found.sort(*groups, order)


def compile_query(query: Query, df: DataFrame, id_field: str = "id") -> Column:
    """A column for match_all, ids, term, terms, prefix, exists and bool; anything else is refused."""
    query = _clause(query)
    if len(query) != 1:
        raise ValueError(f"expected one clause, found {sorted(query)}")
    (kind, body), names = next(iter(query.items())), {f.name.lower().replace("_", ""): f for f in df.schema.fields}

    def field(name: str):
        """(array or None, function from element to value) of a dotted name."""
        parts = name.removesuffix(".keyword").split(".")
        known = names.get(parts[0].lower().replace("_", ""))
        if known is None:
            return None, None
        kind, rest = known.dataType.typeName(), parts[1:]
        if kind == "array":
            return F.col(known.name), (lambda x: x[rest[0]]) if rest else (lambda x: x)
        if kind == "map":
            return None, F.try_element_at(F.col(known.name), F.lit(".".join(rest)))
        value = F.col(known.name)
        for p in rest:
            value = value[p]
        return None, value

    def match(name: str, test) -> Column:
        array, value = field(name)
        if array is not None:
            rest = name.removesuffix(".keyword").split(".")[1:]
            kind = df.schema[names[name.split(".")[0].lower().replace("_", "")].name].dataType.elementType
            if rest and (kind.typeName() != "struct" or rest[0] not in kind.names):
                return F.lit(False)  # an array whose elements have no such field
            return F.coalesce(F.exists(array, lambda x: F.coalesce(test(value(x)), F.lit(False))), F.lit(False))
        return F.lit(False) if value is None else F.coalesce(test(value), F.lit(False))

    if kind == "match_all":
        return F.lit(True)
    if kind == "ids":
        values = body["values"]
        return F.coalesce(F.col(id_field).isin(values), F.lit(False)) if values else F.lit(False)
    if kind == "exists":
        return match(body["field"], lambda x: x.isNotNull())
    if kind in ("term", "terms", "prefix"):
        (name, wanted) = next(iter(body.items()))
        if isinstance(wanted, dict):
            wanted = wanted.get("value")
        test = {"term": lambda x: x == F.lit(wanted), "terms": lambda x: x.isin(list(wanted)), "prefix": lambda x: x.startswith(wanted)}[kind]
        return match(name, test)
    if kind == "bool":
        unknown = set(body) - {"must", "filter", "should", "must_not", "minimum_should_match"}
        if unknown:
            raise ValueError(f"unsupported bool parts {sorted(unknown)}")
        clauses = lambda part: [body[part]] if isinstance(body.get(part), dict) else body.get(part, [])
        out = F.lit(True)
        for q in [*clauses("must"), *clauses("filter")]:
            out = out & compile_query(q, df, id_field)
        for q in clauses("must_not"):
            out = out & ~compile_query(q, df, id_field)
        needed = body.get("minimum_should_match", 0 if clauses("must") or clauses("filter") else 1)
        if clauses("should") and needed:
            hits = [compile_query(q, df, id_field).cast("int") for q in clauses("should")]
            total = hits[0]
            for h in hits[1:]:
                total = total + h
            out = out & (total >= needed)
        return out
    raise ValueError(f"unsupported query {kind}")


def search(df: DataFrame, query: Query, id_field: str = "id") -> DataFrame:
    return df.where(compile_query(query, df, id_field))


def by_ids(df: DataFrame, ids: DataFrame, id_field: str = "id") -> DataFrame:
    """Rows whose id is listed; for lists too long for a query. Unknown ids drop out."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(id_field)).distinct(), id_field, "left_semi")
