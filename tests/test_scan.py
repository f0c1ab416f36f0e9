"""Groups cut at noted positions against plain loops, and dates of stems with several hits."""

import datetime
import random

from pyspark.sql import functions as F

from foliograph.functions.dates import relaxed_stem_date, stem_date
from foliograph.functions.scan import PART, group_starts, nothing, push, pushed
from foliograph.functions.text import glue_short_units
from foliograph.operators.layout import fallback_text, merge_lines, merge_same_headings, rows_by_y

LINE = "struct<text:string,x:double,y:double,size:double,bold:boolean,spans:array<struct<text:string,x:double,y:double,size:double,bold:boolean>>>"


def plain_glue(units, least=28):
    out, held = [], 0
    for u in units:
        if not out or held >= least:
            out.append(u)
            held = 0
        else:
            out[-1] += " " + u
        held += len(u.split())
    return out


def plain_merge(ys, gap):
    out, at = [], None
    for i, y in enumerate(ys):
        if at is None or y is None or abs(y - at) > gap:
            out.append([i])
            at = y
        else:
            out[-1].append(i)
    return out


def test_a_list_grows_over_its_parts(spark):
    n = 3 * PART + 5
    grown = F.aggregate(F.sequence(F.lit(1), F.lit(n)), nothing("int"), push, pushed)
    assert spark.range(1).select(grown.alias("g")).first().g == list(range(1, n + 1))


def test_units_are_glued_as_by_a_loop(spark):
    r = random.Random(5)
    rows = [(i, [" ".join(["w"] * r.randint(1, 40)) for _ in range(r.choice([0, 1, 2, 700]))]) for i in range(12)]
    got = spark.createDataFrame(rows, "i int, u array<string>").select("i", glue_short_units(F.col("u")).alias("g")).collect()
    assert {x.i: x.g for x in got} == {i: plain_glue(u) for i, u in rows}


def test_lines_merge_as_by_a_loop(spark):
    r = random.Random(6)
    pages = []
    for i in range(10):
        ys = [None if r.random() < 0.1 else r.randint(0, 12) / 2 for _ in range(r.choice([0, 1, 60]))]
        pages.append((i, [(f"t{j}", 1.0, y, float(j), j % 3 == 0, []) for j, y in enumerate(ys)]))
    df = spark.createDataFrame(pages, f"i int, l array<{LINE}>")
    got = {x.i: x.m for x in df.select("i", merge_lines(F.col("l"), 1.0).alias("m")).collect()}
    for i, lines in pages:
        want = plain_merge([ln[2] for ln in lines], 1.0)
        assert [m.text for m in got[i]] == ["\n".join(f"t{j}" for j in g) for g in want]
        assert [m.size for m in got[i]] == [float(max(g)) for g in want]
        assert [m.bold for m in got[i]] == [any(j % 3 == 0 for j in g) for g in want]


def test_headings_rows_and_fallback(spark):
    sections = [("A", "x"), ("a ", ""), ("A", "y"), (None, "p"), (None, "q"), ("B", "z"), ("A", "w")]
    lines = [("one", 0.0, 5.0, 9.0, True, [("s1", 0.0, 5.0, 9.0, True)]), ("two", 0.0, 2.0, 9.0, False, [("s2", 0.0, 2.0, 9.0, False)]),
             (" ", 0.0, 2.2, 9.0, False, []), ("three", 0.0, 5.1, 9.0, None, [("s3", 0.0, 5.1, 9.0, None)]), ("four", 0.0, None, 9.0, True, [("s4", 0.0, None, 9.0, True)])]
    df = spark.createDataFrame([(sections, lines), ([], [])], f"s array<struct<heading:string,content:string>>, l array<{LINE}>")
    full, none = df.select(merge_same_headings(F.col("s")).alias("s"), rows_by_y(F.col("l")).alias("r"), fallback_text(F.col("l")).alias("f")).collect()
    assert [tuple(s) for s in full.s] == [("A", "x y"), (None, "p"), (None, "q"), ("B", "z"), ("A", "w")]
    assert [(r.y, [s.text for s in r.spans]) for r in full.r] == [(2, ["s2"]), (5, ["s1", "s3"]), (None, [])]
    assert full.f == "one\ntwo\nthree\n\nfour"
    assert (none.s, none.r, none.f) == ([], [], "")


def test_starts_grow_about_linearly(spark):
    """Positions of a row with many groups come out whole."""
    n = 16_000
    starts = group_starts(F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0), lambda held, x: x % 2 == 0, lambda held, x, o: held)
    assert spark.range(1).select(starts.alias("s")).first().s == list(range(0, n, 2))


def test_dates_of_stems_with_several_hits(spark):
    day = datetime.date
    cases = {
        "2021-01-02 to 2022-03-04": (day(2021, 1, 2), day(2022, 3, 4)),
        "2021-01-02 and 2022-13-41": (day(2021, 1, 2), day(2021, 1, 2)),
        "5 May 2020 then 20210607": (day(2021, 6, 7), day(2021, 6, 7)),
        "a\x01b 2021_02_03\x02": (None, None),
        "": (None, None),
        "no date": (None, None),
    }
    df = spark.createDataFrame([(k,) for k in (*cases, None)], "s string")
    got = {r.s: (r.a, r.b) for r in df.select("s", stem_date(F.col("s")).alias("a"), relaxed_stem_date(F.col("s")).alias("b")).collect()}
    cases["a\x01b 2021_02_03\x02"] = (day(2021, 2, 3), day(2021, 2, 3))
    assert got == cases | {None: (None, None)}
