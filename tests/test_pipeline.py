"""Page JSON to chunks, providers, sinks and streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from foliograph.operators.flatten import flatten_json
from foliograph.operators.layout import page_sections, sort_lines
from foliograph.operators.overlap import extracted_tokens, filter_sections
from foliograph.plans.pipeline import document_chunks, document_dates, first_page_facts
from foliograph.sources.files import list_files, not_yet_written
from foliograph.sources.pages import read_page_json, typed_pages
from foliograph.sources.provider import call_provider, padded_prompt, read_replies
from foliograph.sources.sinks import write_chunk_json, write_chunks
from foliograph.streaming.ingest import chunk_stream, stream_page_json, write_stream

LONG = " ".join(f"word{i}" for i in range(130))
PAGES = {
    1: {"page_number": 1, "title": "Annual Report", "tables": [], "charts": [], "error": "no_tables_or_charts",
        "sections": [{"heading": "Intro", "content": LONG}]},
    2: {"title": None, "tables": [
            {"type": "table", "title": "Rates", "headers": ["May", "Apr"], "rows": [["Bank", "", "1.5"], ["Fund", "2", "3"]], "page_number": 1},
            {"type": "chart", "chart_type": "pie", "title": "Split", "data_series": [{"name": "A", "values": [1, "x", None]}]}],
        "charts": [], "page_number": 2,
        "sections": [{"heading": None, "content": "continues here and ends."}]},
    3: {"title": None, "tables": [], "charts": [], "sections": [], "page_number": 3},
}


@pytest.fixture
def page_dir(tmp_path):
    folder = tmp_path / "2024 June" / "fund [a] report"
    folder.mkdir(parents=True)
    for n, page in PAGES.items():
        (folder / f"page_{n:04d}.json").write_text(json.dumps(page), encoding="utf-8")
    return str(tmp_path)


def test_pages_to_chunks(spark, page_dir, tmp_path):
    pages = typed_pages(read_page_json(spark, page_dir))
    rows = {(r.page, r.seq): r for r in document_chunks(pages).collect()}
    assert [k for k in sorted(rows)] == [(1, 1), (2, 1), (2, 2), (2, 3), (3, 0)]
    assert rows[1, 1].text == f"fund [a] report > Annual Report\n\nIntro {LONG}"
    assert rows[2, 1].text.endswith("|  | May | Apr |\n| --- | --- | --- |\n| Bank |  | 1.5 |\n| Fund | 2 | 3 |")
    assert rows[2, 2].type == "chart" and 'Series: A\n[1, "x", null]' in rows[2, 2].text
    # The first chunk of page 2 is a table, so the long text stays on page 1.
    assert rows[2, 3].text == "fund [a] report > Annual Report\n\ncontinues here and ends."
    assert rows[3, 0].type == "empty"
    assert len({r.id for r in rows.values()}) == 5


def test_compat_doubles_contents(spark, page_dir):
    pages = typed_pages(read_page_json(spark, page_dir), compat=True)
    texts = [r.text for r in document_chunks(pages, compat=True).where("page = 1").orderBy("seq").collect()]
    assert sum(LONG in t for t in texts) == 2


def test_results_do_not_depend_on_partitions(spark, page_dir):
    pages = typed_pages(read_page_json(spark, page_dir))
    seen = [
        sorted((r.page, r.seq, r.text) for r in document_chunks(pages.repartition(n), block_size=b).collect())
        for n, b in ((1, 4096), (7, 1))
    ]
    assert seen[0] == seen[1]


def test_document_date(spark):
    df = spark.createDataFrame([("f", 1, "/in/June 2024/f 3 May.pdf", None, None, None)], "source string, page int, path string, footer string, title string, subtitle string")
    df = df.withColumn("sections", F.array(F.struct(F.lit("h").alias("heading"), F.lit("no date").alias("content"))))
    assert document_dates(first_page_facts(df)).first().published_month == "June 2024"


def test_sinks_and_resume(spark, page_dir, tmp_path):
    chunks = document_chunks(typed_pages(read_page_json(spark, page_dir)))
    write_chunks(chunks, str(tmp_path / "out"), "replay")
    assert spark.read.parquet(str(tmp_path / "out")).where("provider = 'replay'").count() == 5
    write_chunk_json(chunks, str(tmp_path / "json"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "json")).collect()]
    assert {x["meta"]["page"] for x in lines} == {1, 2, 3} and "published_date" not in lines[0]["meta"]
    files = list_files(spark, page_dir).where("path like '%/page_%'")
    assert files.count() == 3 and files.select("kind").distinct().first().kind == "other"
    done = spark.createDataFrame([("page_0001",)], "stem string")
    assert not_yet_written(files, done).count() == 2


def test_provider_calls(spark):
    class Flaky:
        """Fails on its first call, then answers; a bad image always fails."""

        calls = 0

        def label(self):
            return "test"

        def extract(self, image, mime, prompt):
            self.calls += 1
            if image == b"bad" or self.calls == 1:
                raise RuntimeError("no luck")
            return '```json\n{"tables": [{"headers": ["a"], "rows": [["1"]]}], "charts": []}\n```', 10, 5

    rows = [("s", 1, b"ok", "image/png"), ("s", 2, b"bad", "image/png"), ("s", 3, None, "image/png")]
    pages = spark.createDataFrame(rows, "source string, page int, image binary, mime string").coalesce(1)
    got = {r.page: r for r in read_replies(call_provider(pages, Flaky, "p", base_wait=0.0)).collect()}
    assert [got[i].status for i in (1, 2, 3)] == ["ok", "invoke_failed", "no_image_bytes"]
    assert got[1].attempts == 2 and json.loads(got[1].json)["tables"][0]["headers"] == ["a"]
    assert len(padded_prompt("x")) // 4 >= 1200


def test_overlap_filter(spark):
    table = F.struct(F.lit("Assets").alias("title"), F.array(F.lit("Name"), F.lit("Net Value")).alias("headers"),
                     F.array(F.array(F.lit("Gold"), F.lit("1,234"))).alias("rows"))
    charts = F.array().cast("array<struct<title:string,x_values:array<string>,y_values:array<string>,series_values:array<string>>>")
    sec = F.array(*[F.struct(F.lit(h).alias("heading"), F.lit(t).alias("content")) for h, t in [
        ("Gold", "dropped by heading"), ("Notes", "Net Value\n1,234\nGold name x\nkept line here"), ("Net", ""), ("Other", "")]])
    row = spark.range(1).withColumn("t", extracted_tokens(F.array(table), charts)).select(filter_sections(sec, F.col("t")).alias("s")).first()
    assert [(s.heading, s.content) for s in row.s] == [("Notes", "kept line here"), ("Other", "")]


def test_page_sections(spark):
    def line(text, y, size, bold):
        span = (text, 10.0, y, size, bold, "f")
        return (text, 10.0, y, size, bold, [span])

    lines = [line("body text goes here", 40.0, 10.0, False), line("DISCLAIMER", 20.0, 12.0, True),
             line("and on", 46.0, 10.0, False), line("last words", 60.0, 10.0, False)]
    from foliograph.schema import LINE

    df = spark.createDataFrame([(lines,)], f"lines array<{LINE}>")
    got = df.select(page_sections(sort_lines(F.col("lines"))).alias("s")).first().s
    assert [(s.heading, s.content) for s in got] == [("DISCLAIMER", "body text goes here\nand on\nlast words")]


def test_flatten_unknown_shapes(spark):
    doc = {"page_no": 4, "sender": {"name": "N"}, "x": {"type": "table", "data": [{"section": "S", "columns": [
        {"header": "a", "items": [1, 2]}, {"header": "b", "items": ["z"]}]}]}, "note": "hello", "debug": {"a": 1}}
    df = spark.createDataFrame([(json.dumps(doc),), ("no json",)], "j string")
    got = [r.b for r in df.select(flatten_json(F.col("j"), F.lit(1)).alias("b")).collect()]
    assert got[1] == [] and [b.type for b in got[0]] == ["table", "narrative", "narrative", "table"]  # a bare page number is no text
    assert got[0][-1].rows == [["1", "z"], ["2", ""]] and got[0][0].page == 4


def test_stream_of_pages(spark, page_dir, tmp_path):
    out = str(tmp_path / "stream-out")
    query = write_stream(chunk_stream(stream_page_json(spark, page_dir)), out, str(tmp_path / "stream-ckpt"))
    query.awaitTermination(120)
    assert {r.page for r in spark.read.parquet(out).collect()} == {1, 2, 3}
    assert os.path.isdir(str(tmp_path / "stream-ckpt"))


def test_glossary_sections_become_tables_once(spark):
    """A table of the same title and size stands for the section; null and blank contents and other headings make none."""
    from foliograph.operators.repair import clear_used_glossaries, glossary_tables

    sections = [("Glossary", "NAV\nvalue of\na unit\nSIP\nsaved monthly"), ("GLOSSARY B", None), ("Notes", "NAV\nvalue"), (None, "SIP\nsaved"), ("Glossary C", " ")]
    kind = "id int, sections array<struct<heading:string,content:string>>, tables array<struct<title:string,rows:array<array<string>>>>"
    pages = [(1, sections, []), (2, sections, [("Glossary", [["x"]])]), (3, sections, [("Glossary", [["x"], ["y"]])]), (4, [], [])]
    page = spark.createDataFrame(pages, kind).withColumn("new", glossary_tables(F.col("sections"), F.col("tables"), F.lit(7)))
    rows = page.select("new", clear_used_glossaries(F.col("sections"), F.col("new")).alias("left")).orderBy("id").collect()
    made = [[(t["title"], t["rows"], t["page_number"]) for t in r["new"]] for r in rows]
    terms = [["NAV", "value of a unit"], ["SIP", "saved monthly"]]
    assert made == [[("Glossary", terms, 7)], [("Glossary", terms, 7)], [], []]
    assert [[s["content"] for s in r["left"]][:1] for r in rows] == [[""], [""], [sections[0][1]], []]
    assert [s["content"] for s in rows[0]["left"]][1:] == [None, "NAV\nvalue", "SIP\nsaved", " "]
