"""Laid-out lines: words are split only where a span's text is read, patterns sought once, line breaks of all kinds found."""

import re

import pytest
from pyspark.sql import functions as F

from foliograph import constants as K
from foliograph.functions import text as T
from foliograph.operators import layout as L
from foliograph.plans.catalogue import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TEXTS = ["a b\nthe the end\nc", "de la\r\nx  y z", None, " \x85 ", "one two three four five\n" * 9 + "The THE\n" + "p q\n" * 7]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lines"))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(TEXTS)], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return folder


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["line_sort", "line_merge", "rows_by_y", "title_candidates_all_lines", "fallback_text", "section_assembly"])
def test_words_are_counted_and_not_split(spark, pages, name):
    text = plan(QUERIES[name](spark, pages))
    assert not re.search(r"split\(lambda [^()]*,  , -1\)", text)


@pytest.mark.parametrize("name", ["heading_boxes", "heading_boxes_whole_tables"])
def test_heading_pattern_is_sought_once(spark, pages, name):
    assert plan(QUERIES[name](spark, pages)).count("the the") == 1


def test_boxes_at_known_lines_are_those_of_the_pattern(spark):
    lines = "array<struct<text:string,x:double,y:double,size:double,bold:boolean,spans:array<struct<x:double>>>>"
    rows = [[(t, 50.0, 10.0 * k, 10.0, True, [(50.0,), (90.0,)][: len(t.split())]) for k, t in enumerate(page)] for page in (["a b", "Key", "c d"], ["x"], [])]
    df = spark.createDataFrame([(r,) for r in rows], f"l {lines}")
    for compat in (False, True):
        found = L.heading_boxes(F.col("l"), ["key"], compat=compat)
        known = L.heading_boxes(F.col("l"), ["key"], compat=compat, at=L.heading_lines(F.col("l"), ["key"]))
        got = [(r.a, r.b) for r in df.select(found.alias("a"), known.alias("b")).collect()]
        assert got[0][0] and all(a == b for a, b in got) and [len(a) for a, _ in got] == [1, 0, 0]


def test_line_breaks_of_all_kinds(spark):
    odd = ["a\r\nb", "a\r\r\n\nb ", "\x0ba\x0cb\x1cc\x1dd\x1ee", "é ü ö\x85ä", "a\tb\n c\xa0\n　d", "\U0001f600\n\U0001f601 x\r", "", "\r", "a" * 3000 + "\n" * 3000 + "b"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate([*odd, None])], "i int, t string").select("i", T.nonblank_lines(F.col("t")).alias("l")).collect()
    plain = lambda t: [s for s in (p.strip(K.SPACE_CHARS) for p in re.split(T.LINE_BREAK, t or "")) if s]
    assert {r.i: r.l for r in got} == {i: plain(t) for i, t in enumerate([*odd, None])}


def test_a_named_value_is_read_without_a_copy(spark):
    """A name is no ``transform``, whose result Spark copies with all its arrays; values that are null or nested stay as they are."""
    df = spark.createDataFrame([(1, ["a", None]), (None, None)], "n int, l array<string>")
    named = df.select(T.let(F.col("n") + 1, lambda n: T.let(F.col("l"), lambda held: F.struct(n.alias("n"), held.alias("l")))).alias("s"))
    assert "transform(" not in plan(named)
    assert [(r.s.n, r.s.l) for r in named.collect()] == [(2, ["a", None]), (None, None)]
