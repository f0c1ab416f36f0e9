"""JSON found in model output: cutting it out and mending it."""

from __future__ import annotations

import ast
import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from foliograph.functions.text import let

OPEN, CLOSE = "{[", "}]"
MARK = re.compile(r'["{}\[\]]')
REST_OF_STRING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)


def balanced_spans(text: str) -> list[str]:
    """Outermost bracketed parts; brackets inside JSON strings do not count."""
    found, depth, start, at = [], 0, 0, 0
    while mark := MARK.search(text, at):
        i, at, ch = mark.start(), mark.end(), mark[0]
        if ch in OPEN:
            start = start if depth else i
            depth += 1
        elif not depth:
            continue
        elif ch in CLOSE:
            depth -= 1
            if depth == 0:
                found.append(text[start:at])
        elif end := REST_OF_STRING.match(text, at):
            at = end.end()
        else:  # the string has no end
            break
    return found


@pandas_udf(ArrayType(StringType()))
def json_candidates(texts: pd.Series) -> pd.Series:
    """Outermost bracketed parts of each text, in order."""
    return texts.map(lambda t: balanced_spans(t) if isinstance(t, str) else [])


@pandas_udf(StringType())
def _literal_to_json(texts: pd.Series) -> pd.Series:
    """A Python literal as JSON; null if it is none."""

    def one(t: str | None) -> str | None:
        try:
            return json.dumps(ast.literal_eval(t), ensure_ascii=False)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    return texts.map(one)


def _valid(x: Column) -> Column:
    return F.when(F.try_parse_json(x).isNotNull(), x)


def without_trailing_commas(x: Column) -> Column:
    return F.regexp_replace(x, r",\s*([}\]])", "$1")


def with_straight_quotes(x: Column) -> Column:
    return F.translate(x, "“”‘’", "\"\"''")


def mend_json(x: Column) -> Column:
    """``x`` as valid JSON: as it is, without trailing commas, with straight quotes."""
    plain = without_trailing_commas(x)
    return F.coalesce(_valid(x), _valid(plain), _valid(with_straight_quotes(plain)))


def mend_literal(x: Column, mended: Column) -> Column:
    """What :func:`mend_json` could not mend, read as a Python literal."""
    rest = F.when(mended.isNull(), with_straight_quotes(without_trailing_commas(x)))
    return F.coalesce(mended, _literal_to_json(rest))


def unwrap_single(x: Column) -> Column:
    """``[{…}]`` to ``{…}``; anything but an object to ``{"value": …}``."""
    items = F.from_json(x, "array<string>")
    is_list = F.ltrim(x).startswith("[")
    lone = is_list & (F.size(items) == 1) & F.ltrim(F.get(items, F.lit(0))).startswith("{")
    return (
        F.when(lone, F.regexp_extract(x, r"(?s)\A\s*\[\s*(.*\S)\s*\]\s*\z", 1))
        .when(F.ltrim(x).startswith("{"), x)
        .when(x.isNotNull(), F.concat(F.lit('{"value": '), x, F.lit("}")))
    )


def merge_page_objects(objects: Column) -> Column:
    """One page from the JSON objects of a reply: first titles, all tables and charts.

    ``objects`` is an array of page JSON texts in reply order.
    """
    shape = (
        "struct<title:string,subtitle:string,narrative_text:string,page_number:string,"
        "tables:array<string>,charts:array<string>>"
    )

    def merged(parsed: Column) -> Column:
        def first(name: str) -> Column:
            return F.get(F.filter(F.transform(parsed, lambda p: F.nullif(p[name], F.lit(""))), lambda v: v.isNotNull()), F.lit(0))

        def every(name: str) -> Column:
            return F.flatten(F.transform(parsed, lambda p: F.coalesce(p[name], F.array().cast("array<string>"))))

        texts = F.filter(F.transform(parsed, lambda p: F.trim(p["narrative_text"])), lambda t: F.coalesce(t, F.lit("")) != "")
        return F.struct(
            first("title").alias("title"),
            first("subtitle").alias("subtitle"),
            let(F.array_join(texts, "\n\n"), lambda t: F.when(t != "", t)).alias("narrative_text"),
            first("page_number").alias("page_number"),
            every("tables").alias("tables"),
            every("charts").alias("charts"),
        )

    # Bound, or each field would parse every object again.
    return let(F.transform(objects, lambda o: F.from_json(o, shape)), merged)


def richest_object(objects: Column) -> Column:
    """The object with most tables and charts, ten points each, and a point per 1000 characters."""

    def score(o: Column) -> Column:
        p = F.from_json(o, "struct<tables:array<string>,charts:array<string>>")
        n = F.coalesce(F.size(p["tables"]), F.lit(0)) + F.coalesce(F.size(p["charts"]), F.lit(0))
        return n * 10 + F.floor(F.length(o) / 1000)

    ranked = F.transform(objects, lambda o, i: F.struct(score(o).alias("s"), (-i).alias("i"), o.alias("o")))
    return F.array_max(ranked)["o"]
