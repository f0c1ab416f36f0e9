"""Objects of a reply are parsed once; bracketed parts as by a plain loop."""

import random

from pyspark.sql import functions as F

from foliograph.functions.jsonx import balanced_spans, merge_page_objects


def plain_spans(text):
    found, depth, start, quoted, skip = [], 0, 0, False, False
    for i, ch in enumerate(text):
        if skip:
            skip = False
        elif quoted:
            skip = ch == "\\"
            quoted = ch != '"'
        elif ch == '"' and depth:
            quoted = True
        elif ch in "{[":
            start = start if depth else i
            depth += 1
        elif ch in "}]" and depth:
            depth -= 1
            if depth == 0:
                found.append(text[start : i + 1])
    return found


def test_spans_as_by_a_loop():
    r = random.Random(3)
    for _ in range(5000):
        text = "".join(r.choices('{}[]"\\a\n', k=r.randint(0, 30)))
        assert balanced_spans(text) == plain_spans(text), text


def test_objects_are_parsed_once(spark):
    page = spark.range(1).select(F.array(F.lit('{"title": "", "tables": [1]}'), F.concat(F.lit('{"title": "T", "charts": [2], "narrative_text": " n "}'), F.lit(""))).alias("o"))
    merged = page.select(merge_page_objects(F.col("o")).alias("m"))
    assert merged._jdf.queryExecution().analyzed().toString().count("from_json(") == 1
    assert merged.select("m.*").first().asDict() == {"title": "T", "subtitle": None, "narrative_text": "n", "page_number": None, "tables": ["1"], "charts": ["2"]}
