"""Laid-out pages: each text is cut into lines once and each line into words once, with the same pages."""

import duckdb
import pytest
from oracle import compare

from foliograph.plans.catalogue import ORACLE, QUERIES
from foliograph.plans.catalogue.layout import laid_out

TEXTS = ["", None, " \n\t\r\n \n", "one", "a b c\nA B\n\n" + "word " * 3000 + "\nPage 3\nthe the end of it", "x  y\n" * 40 + "de la Cruz and more\n" * 5]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pages"))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_texts_and_lines_are_split_once(spark, pages):
    plan = laid_out(spark, pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2


@pytest.mark.parametrize("name", ["line_sort", "line_merge", "rows_by_y", "title_candidates_all_lines", "glossary_box"])
def test_long_and_blank_texts(spark, pages, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{pages}/documents.parquet/*.parquet'")
    assert compare(QUERIES[name](spark, pages), con, ORACLE[name]) == ""


READ = {
    "line_sort": [], "title_candidates_all_lines": [], "fallback_text": [], "section_assembly": ["bold"], "page_sections": ["bold"],
    "line_merge": ["text"], "rows_by_y": ["text"], "glossary_box": ["text", "x"], "heading_boxes": ["x"], "heading_boxes_whole_tables": ["x"],
}


@pytest.mark.parametrize("name", READ)
def test_spans_are_made_with_the_fields_that_are_read(spark, pages, name):
    plan = QUERIES[name](spark, pages)._jdf.queryExecution().optimizedPlan().toString()
    assert ("Plain" in plan, "* 40.0" in plan, "% 2" in plan) == (False, "x" in READ[name], "bold" in READ[name])


@pytest.mark.parametrize("span", [(), ("text",), ("bold",), ("text", "x")])
def test_named_fields_are_those_of_whole_spans(spark, pages, span):
    def rows(df):
        return {r["doc_id"]: [(n["text"], n["y"], n["size"], [[s[k] for k in span] for s in n["spans"]] if span else None) for n in r["lines"]] for r in df.collect()}

    assert rows(laid_out(spark, pages, span=span)) == rows(laid_out(spark, pages))
