"""Patterns that take whole runs give the results of the plain definitions, and texts are found once."""

import re

import pytest
from pyspark.sql import functions as F

from foliograph import constants as K
from foliograph.functions import text as T
from foliograph.operators.overlap import keep_line
from foliograph.plans.catalogue import QUERIES

ODD = ["", " ", None, "a", "A-b.C%  d", "x y\tz", "é É ß İ K", "1,234 -5 , . ,,", "__ -- ..", "a\n\nb \n c", " Ω σας", "日本 語　x1", "\x1c9%\x85"]


def plain_norm(x):
    return re.sub(r"[^0-9A-Za-z\-.%]+", " ", (x or "").lower()).strip(" ")


def plain_key(x):
    space = K.SPACE_CLASS
    bare = "".join(ch for ch in (x or "").lower() if ch.isalpha() or ch.isnumeric() or ch == "_" or re.match(f"[{space}]", ch))
    return re.sub(f"[{space}]+", " ", bare).strip(K.SPACE_CHARS)


def test_normal_forms(spark):
    odd = [x for x in ODD if x is None or "İ" not in x]
    got = spark.createDataFrame([(x,) for x in odd], "x string").select("x", T.norm_token(F.col("x")).alias("n"), T.unit_key(F.col("x")).alias("k"), T.word_count(F.col("x")).alias("w")).collect()
    for r in got:
        assert (r.n, r.k, r.w) == (plain_norm(r.x), plain_key(r.x), len(re.findall(f"[^{K.SPACE_CLASS}]+", r.x or "")))


def test_lines_kept_beside_tables(spark):
    cells = F.array(*map(F.lit, ["alpha", "beta", "1234", "-5", "two words"]))
    numbers = F.array(*map(F.lit, ["1234", "-5"]))
    tokens = T.let(F.struct(cells.alias("whole"), numbers.alias("numbers"), cells.alias("short")), lambda t: t)
    lines = {"alpha beta": False, "Two  words!": False, "1,234 -5 x": False, "alpha gamma delta": True, "99 98": True, ", ,": False, "": False}
    df = spark.createDataFrame([(k,) for k in lines], "x string").select("x", keep_line(F.col("x"), tokens).alias("k"))
    assert {r.x: r.k for r in df.collect()} == lines


@pytest.mark.parametrize("name", ["section_filter", "table_similarity_dups", "unit_split"])
def test_lines_are_found_once(spark, tmp_path, name):
    rows = [(i, t or "", "en", "s", 0) for i, t in enumerate(ODD)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    plan = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(coalesce(text") == 1
