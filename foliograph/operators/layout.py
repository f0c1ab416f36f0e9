"""Page layout: lines to paragraphs, sections and table regions.

A page row carries its lines as an array; every function here is a column
expression over that array. Lines must be in reading order
(:func:`sort_lines`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliograph import constants as K
from foliograph.functions.scan import group_starts, groups, neighbour_starts
from foliograph.functions.text import (
    bold_ratio,
    is_all_caps,
    is_currency_number,
    is_page_counter,
    let,
    squeeze,
    starts_noise,
    strip,
    text_or_empty,
    word_count,
)
from foliograph.schema import LINE, SECTION


def sort_lines(lines: Column) -> Column:
    """Reading order: by y to two places, then x to one, then input order."""

    def ordered(lns: Column) -> Column:
        # Positions are sorted in place of lines, so a line is copied once.
        keyed = F.transform(
            lns, lambda ln, i: F.struct(F.bround(ln["y"], 2).alias("y"), F.bround(ln["x"], 1).alias("x"), i.alias("i"))
        )
        return F.transform(F.sort_array(keyed), lambda k: F.get(lns, k["i"]))

    return let(lines, ordered)


def lines_from_spans(span_lines: Column) -> Column:
    """Lines from arrays of spans; blank spans, blank lines and page counters go."""

    def one(spans: Column) -> Column:
        kept = F.filter(
            F.transform(spans, lambda s: s.withField("text", strip(text_or_empty(s["text"])))),
            lambda s: s["text"] != "",
        )
        return let(
            kept,
            lambda ss: F.struct(
                F.array_join(F.transform(ss, lambda s: s["text"]), " ").alias("text"),
                F.get(ss, F.lit(0))["x"].alias("x"),
                F.get(ss, F.lit(0))["y"].alias("y"),
                F.array_max(F.transform(ss, lambda s: F.coalesce(s["size"], F.lit(0.0)))).alias("size"),
                F.exists(ss, lambda s: F.coalesce(s["bold"], F.lit(False))).alias("bold"),
                ss.alias("spans"),
            ),
        )

    return F.filter(F.transform(span_lines, one), lambda ln: (F.size(ln["spans"]) > 0) & ~is_page_counter(ln["text"]))


def merge_lines(lines: Column, gap: float = K.LINE_GAP) -> Column:
    """Join lines within ``gap`` of the first line of their group; null texts are left out, null lines go."""

    def joined(group: Column) -> Column:
        head = F.get(group, F.lit(0))
        texts = F.transform(group, lambda ln: ln["text"])
        many = F.struct(
            F.array_join(texts, "\n").alias("text"),
            head["x"].alias("x"),
            head["y"].alias("y"),
            F.array_max(F.transform(group, lambda ln: ln["size"])).alias("size"),
            F.exists(group, lambda ln: ln["bold"]).alias("bold"),
            F.flatten(F.transform(group, lambda ln: ln["spans"])).alias("spans"),
        )
        return F.when(F.size(group) > 1, many).otherwise(head)

    starts = lambda ls: group_starts(
        F.transform(ls, lambda ln: F.when(ln.isNotNull(), F.struct(ln["y"].alias("y")))),
        F.lit(None).cast("struct<y:double>"),
        lambda at, ln: ~F.coalesce(F.abs(ln["y"] - at["y"]) <= gap, F.lit(False)),
        lambda at, ln, opens: F.when(opens, ln).otherwise(at),
    )
    return F.array_compact(let(lines, lambda ls: groups(ls, starts(ls), joined)))


def array_upper_median(values: Column) -> Column:
    return let(F.array_sort(values), lambda v: F.get(v, F.floor(F.size(v) / 2).cast("int")))


def flag_headings(lines: Column, gap: float = K.LINE_GAP) -> Column:
    """Each line with its text and whether it is a heading of the page."""

    def build(median: Column) -> Column:
        def judge(text: Column, ln: Column, i: Column) -> Column:
            # Every rule asks for letters above the median, so most lines end at the first comparison.
            n = word_count(text)
            size = F.coalesce(ln["size"], F.lit(0.0))
            letters = F.regexp_count(text, F.lit(r"\p{L}"))
            rule = (size >= median + 0.2) & (
                ((i < 4) & (size >= median + 1.0) & (n <= 12))
                | ((size >= median + 0.6) & (n <= 9) & (bold_ratio(ln["spans"]) >= 0.70))
                | ((n <= 8) & is_all_caps(text))
            )
            noise = starts_noise(text) | (letters < F.greatest(F.lit(1), F.length(text)) * 0.25) | (F.length(text) > 220)
            after = F.get(lines, i + 1)["y"]
            wrapped = after.isNotNull() & (after - ln["y"] <= gap)
            heading = rule & ~F.coalesce(wrapped, F.lit(False)) & (n <= 25) & ~noise
            return F.struct(text.alias("text"), heading.alias("heading"))

        def one(ln: Column, i: Column) -> Column:
            return let(strip(text_or_empty(ln["text"])), lambda text: judge(text, ln, i))

        return F.transform(lines, one)

    sizes = F.transform(lines, lambda ln: F.greatest(F.lit(0.1), ln["size"]))
    return let(array_upper_median(sizes), build)


def assemble_sections(flagged: Column) -> Column:
    """Each heading opens a section; other lines are the content of the open one.

    Sections are slices between the positions of headings, so every line is
    copied once.
    """

    def build(lines: Column) -> Column:
        is_heading = lambda i: F.coalesce(F.get(lines, i)["heading"], F.lit(False))
        n = F.size(lines)
        starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (i < n) & ((i == 0) | is_heading(i)))

        def section(start: Column, end: Column) -> Column:
            at = F.when(is_heading(start), start + 1).otherwise(start)
            texts = let(at, lambda a: F.transform(F.slice(lines, a + 1, end - a), lambda ln: ln["text"]))
            return F.struct(
                F.when(is_heading(start), F.get(lines, start)["text"]).alias("heading"),
                let(F.array_join(texts, "\n"), lambda t: strip(squeeze(t))).alias("content"),
            )

        every = let(starts, lambda s: F.transform(s, lambda start, k: section(start, F.coalesce(F.get(s, k + 1), n))))
        return F.filter(every, lambda s: (text_or_empty(s["heading"]) != "") | (s["content"] != ""))

    return let(flagged, build)


def _pull_up(section: Column, accepts) -> Column:
    """Move an accepted first content line of a section into its empty heading."""
    lines = F.filter(F.transform(F.split(section["content"], "\n"), strip), lambda t: t != "")
    return let(
        lines,
        lambda ls: F.when(
            (text_or_empty(section["heading"]) == "") & (F.size(ls) > 0) & F.coalesce(accepts(F.get(ls, F.lit(0))), F.lit(False)),
            F.struct(
                F.get(ls, F.lit(0)).alias("heading"),
                strip(squeeze(F.array_join(F.slice(ls, F.lit(2), F.greatest(F.size(ls) - 1, F.lit(0))), "\n"))).alias("content"),
            ),
        ).otherwise(section),
    )


def promote_headings(sections: Column) -> Column:
    """Give sections without heading the title-like line their content starts with."""

    def title_like(t: Column) -> Column:
        ws = F.split(t, r"\s+")
        capital = F.size(F.filter(ws, lambda w: w.rlike(r"^\p{Lu}")))
        return is_all_caps(t) | (
            (F.size(ws) <= 10) & (capital >= F.greatest(F.lit(1), F.floor(F.size(ws) / 2).cast("int")))
        )

    first = F.transform(sections, lambda s, i: F.when(i == 0, _pull_up(s, title_like)).otherwise(s))
    return F.transform(first, lambda s: _pull_up(s, lambda t: is_all_caps(t) & (word_count(t) <= 8)))


def merge_same_headings(sections: Column) -> Column:
    """Neighbouring sections with the same heading, ignoring case, become one; empty contents are left out."""

    def joined(group: Column) -> Column:
        head = F.get(group, F.lit(0))
        contents = F.filter(F.transform(group, lambda s: s["content"]), lambda c: c != "")
        many = F.struct(head["heading"].alias("heading"), strip(F.array_join(contents, " ")).alias("content"))
        return F.when(F.size(group) > 1, many).otherwise(head)

    keys = lambda ss: F.transform(ss, lambda s: F.lower(strip(text_or_empty(s["heading"]))))
    starts = lambda ss: let(keys(ss), lambda ks: neighbour_starts(ks, lambda before, key: (key == "") | (before != key)))
    return let(sections, lambda ss: groups(ss, starts(ss), joined))


def page_sections(lines: Column, gap: float = K.LINE_GAP) -> Column:
    """Sections of a page from its sorted lines."""
    return let(
        merge_lines(lines, gap),
        lambda m: merge_same_headings(promote_headings(assemble_sections(flag_headings(m, gap)))),
    )


def title_candidates(lines: Column, compat: bool = False) -> Column:
    """Title and subtitle among the merged lines of a page; with ``compat`` among the first six."""

    def build(top: Column) -> Column:
        ranked = F.array_sort(
            F.transform(top, lambda ln, i: F.struct((-ln["size"]).alias("k"), ln["y"].alias("y"), i.alias("i"), ln["text"].alias("text")))
        )
        by_y = F.array_sort(
            F.transform(top, lambda ln, i: F.struct(ln["y"].alias("y"), i.alias("i"), ln["size"].alias("size"), ln["text"].alias("text")))
        )
        best, second = F.get(ranked, F.lit(0)), F.get(by_y, F.lit(1))
        fits = (text_or_empty(best["text"]) != "") & (F.length(best["text"]) < 160) & (word_count(best["text"]) <= 10)
        under = (second["size"] < -best["k"]) | second["text"].startswith("(")
        return F.struct(
            F.when(fits, best["text"]).alias("title"), F.when(fits & under, second["text"]).alias("subtitle")
        )

    return let(F.slice(lines, F.lit(1), F.lit(6)) if compat else lines, build)


def _box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(
        x0.cast("int").alias("x0"), y0.cast("int").alias("y0"), x1.cast("int").alias("x1"), y1.cast("int").alias("y1")
    )


def _int(x: Column) -> Column:
    return F.bround(x).cast("int")


def runs(items: Column, joins) -> Column:
    """Split an array into runs; ``joins(previous, item)`` says whether to go on."""

    def split(its: Column) -> Column:
        indexed = F.transform(its, lambda v, i: F.struct(v.alias("v"), i.alias("i")))
        opens = F.filter(
            indexed,
            lambda w: (w["i"] == 0) | ~F.coalesce(joins(F.get(its, w["i"] - 1), w["v"]), F.lit(False)),
        )
        return let(
            F.transform(opens, lambda w: w["i"]),
            lambda s: F.transform(
                s, lambda a, k: F.slice(its, a + 1, F.coalesce(F.get(s, k + 1), F.size(its)) - a)
            ),
        )

    return let(items, split)


def longest_run(all_runs: Column) -> Column:
    """The run with the most items, the first of several."""
    sizes = F.transform(all_runs, lambda r: F.size(r))
    return let(sizes, lambda n: F.get(all_runs, (F.array_position(n, F.array_max(n)) - 1).cast("int")))


def glossary_box(lines: Column) -> Column:
    """Region of the longest run of at least four lines with two or more spans."""
    paired = F.transform(
        lines,
        lambda ln: F.struct(
            ln["y"].alias("y"),
            F.transform(F.slice(ln["spans"], 1, 2), lambda s: s["x"]).alias("xs"),
            ((F.size(ln["spans"]) >= 2) & (strip(text_or_empty(ln["text"])) != "")
             & (strip(text_or_empty(F.get(ln["spans"], F.lit(0))["text"])) != "")).alias("ok"),
        ),
    )
    groups = F.filter(
        runs(paired, lambda a, b: a["ok"] & b["ok"]), lambda r: F.get(r, F.lit(0))["ok"] & (F.size(r) >= 4)
    )

    def box(best: Column) -> Column:
        ys = F.transform(best, lambda ln: _int(ln["y"]))
        first = F.transform(best, lambda ln: _int(F.get(ln["xs"], F.lit(0))))
        second = F.transform(best, lambda ln: _int(F.get(ln["xs"], F.lit(1))))
        return _box(
            F.greatest(F.lit(0), F.array_min(first) - 8), F.array_min(ys) - 6, F.array_max(second) + 60, F.array_max(ys) + 12
        )

    def build(gs: Column) -> Column:
        sane = let(let(longest_run(gs), box), lambda b: F.when((b["x1"] > b["x0"]) & (b["y1"] > b["y0"]), b))
        return F.when(F.size(gs) > 0, sane)

    return let(groups, build)


def rows_by_y(lines: Column) -> Column:
    """Lines that share a rounded y, with all their span positions and texts; lines without y give no spans."""
    keyed = F.transform(
        lines, lambda ln, i: F.struct(ln["y"].isNull().alias("last"), _int(ln["y"]).alias("y"), i.alias("i"))
    )

    def row(group: Column) -> Column:
        known = F.filter(group, lambda k: k["y"].isNotNull())
        return F.struct(
            F.get(group, F.lit(0))["y"].alias("y"),
            F.flatten(F.transform(known, lambda k: F.get(lines, k["i"])["spans"])).alias("spans"),
        )

    return let(
        F.array_sort(keyed),
        lambda ks: groups(ks, neighbour_starts(ks, lambda a, b: ~a["y"].eqNullSafe(b["y"])), row),
    )


def table_runs(lines: Column) -> Column:
    """First and last position of each run of lines with two or more spans."""

    def build(ok: Column) -> Column:
        at = lambda i: F.coalesce(F.get(ok, i), F.lit(False))
        where = F.sequence(F.lit(0), F.greatest(F.size(ok) - 1, F.lit(0)))
        starts = F.filter(where, lambda i: at(i) & ((i == 0) | ~at(i - 1)))
        ends = F.filter(where, lambda i: at(i) & ~at(i + 1))
        return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))

    flags = F.transform(lines, lambda ln: (F.size(ln["spans"]) >= 2) & (strip(text_or_empty(ln["text"])) != ""))
    return let(flags, build)


def region_lines(lines: Column, table: Column, at: Column, below: int) -> Column:
    """Line ``at`` and what is below it to the end of the table rows that begin at most ``below`` lines down.

    Where no table row is that near, the ``below`` lines are the region; with a
    null ``table`` they always are.
    """
    last = F.array_max(F.transform(F.filter(table, lambda r: r["start"] <= at + below), lambda r: r["end"]))
    return F.slice(lines, at + 1, F.when(last > at, last - at + 1).otherwise(below + 1))


def _table(lines: Column, compat: bool) -> Column:
    return F.lit(None).cast("array<struct<start:int,end:int>>") if compat else table_runs(lines)


def priority_box(lines: Column, pattern: str = K.PRIORITY_HEADING, compat: bool = False) -> Column:
    """Region under a priority heading, else the first dense numeric band.

    It goes to the end of the table rows; with ``compat`` it has eight lines.
    """
    marked = F.filter(
        F.transform(lines, lambda ln, i: F.struct(ln["text"].alias("text"), i.alias("i"))),
        lambda m: text_or_empty(m["text"]).rlike("(?i)" + pattern),
    )
    grouped = let(_table(lines, compat), lambda t: F.transform(marked, lambda m: region_lines(lines, t, m["i"], 7)))
    spanned = F.filter(grouped, lambda g: F.exists(g, lambda ln: F.size(ln["spans"]) > 0))

    def around(g: Column) -> Column:
        xs = F.transform(F.flatten(F.transform(g, lambda ln: ln["spans"])), lambda s: _int(s["x"]))
        ys = F.transform(g, lambda ln: _int(ln["y"]))
        return _box(F.greatest(F.lit(0), F.array_min(xs) - 8), F.array_min(ys) - 6, F.array_max(xs) + 60, F.array_max(ys) + 10)

    headed = let(spanned, lambda gs: F.when(F.size(gs) > 0, around(F.get(gs, F.lit(0)))))

    def dense(r: Column) -> Column:
        n = F.size(F.filter(r["spans"], lambda s: is_currency_number(s["text"])))
        return (n >= 2) & (n * 10 >= F.size(r["spans"]) * 4)

    flagged = F.transform(rows_by_y(lines), lambda r: F.struct(r["y"].alias("y"), r["spans"].alias("spans"), dense(r).alias("ok")))
    bands = F.filter(
        runs(flagged, lambda a, b: a["ok"] & b["ok"]), lambda g: F.get(g, F.lit(0))["ok"] & (F.size(g) >= 3)
    )

    def banded(gs: Column) -> Column:
        g = F.get(gs, F.lit(0))
        xs = F.transform(F.flatten(F.transform(g, lambda r: r["spans"])), lambda s: _int(s["x"]))
        ys = F.transform(g, lambda r: r["y"])
        return F.when(
            F.size(gs) > 0,
            _box(F.greatest(F.lit(0), F.array_min(xs) - 8), F.array_min(ys) - 8, F.array_max(xs) + 60, F.array_max(ys) + 10),
        )

    return F.coalesce(headed, let(bands, banded))


def column_bands(lines: Column, min_rows: int = 3, gap: int = 20) -> Column:
    """Regions of consecutive rows with two or more spans, at most ``gap`` apart."""
    wide = F.filter(rows_by_y(lines), lambda r: F.size(r["spans"]) >= 2)

    def build(rs: Column) -> Column:
        groups = F.filter(runs(rs, lambda a, b: b["y"] - a["y"] <= gap), lambda g: F.size(g) >= min_rows)

        def one(g: Column) -> Column:
            xs = F.transform(F.flatten(F.transform(g, lambda r: r["spans"])), lambda s: _int(s["x"]))
            ys = F.transform(g, lambda r: r["y"])
            return _box(
                F.greatest(F.lit(0), F.array_min(xs) - 8),
                F.greatest(F.lit(0), F.array_min(ys) - 6),
                F.array_max(xs) + 60,
                F.array_max(ys) + 18,
            )

        return F.transform(groups, one)

    return let(wide, build)


def heading_lines(lines: Column, patterns: list[str]) -> Column:
    """Positions of the lines that match a pattern, whatever the case."""
    hit = "(?i)" + "|".join(f"(?:{p})" for p in patterns)
    marked = F.transform(lines, lambda ln, i: F.when(text_or_empty(ln["text"]).rlike(hit), i))
    return F.array_compact(marked)


def heading_boxes(lines: Column, patterns: list[str], below: int = 4, compat: bool = False, at: Column | None = None) -> Column:
    """Region of each line that matches a pattern and the table rows that begin at most ``below`` lines after it.

    With ``compat``, or without such rows, it has the ``below`` lines. Give the
    :func:`heading_lines` as ``at`` where they are known.
    """

    def one(i: Column, table: Column) -> Column:
        g = region_lines(lines, table, i, below)
        xs = F.transform(F.flatten(F.transform(g, lambda ln: ln["spans"])), lambda s: s["x"])
        first = F.get(lines, i)
        bottom = F.array_max(F.transform(g, lambda ln: ln["y"]))
        return F.when(
            F.size(xs) > 0,
            _box(
                F.greatest(F.lit(0), F.array_min(xs) - 8),
                F.greatest(F.lit(0), first["y"] - 6),
                F.array_max(xs) + 60,
                bottom + 6,
            ),
        )

    def boxes(hits: Column) -> Column:
        # Where no line matches, table rows are not looked for.
        table = F.when(F.size(hits) > 0, _table(lines, compat))
        return let(table, lambda t: F.array_compact(F.transform(hits, lambda i: one(i, t))))

    return let(heading_lines(lines, patterns) if at is None else at, boxes)


def is_empty_page(text: Column, n_images: Column, n_drawings: Column, n_annotations: Column) -> Column:
    nothing = [F.coalesce(c, F.lit(0)) == 0 for c in (n_images, n_drawings, n_annotations)]
    return (strip(text_or_empty(text)) == "") & nothing[0] & nothing[1] & nothing[2]


def fallback_text(lines: Column) -> Column:
    """Headings by boldness or size over the median, as one narrative text."""
    sizes = F.transform(lines, lambda ln: ln["size"])

    def build(median: Column) -> Column:
        flagged = F.transform(
            lines,
            lambda ln: F.struct(
                strip(text_or_empty(ln["text"])).alias("text"),
                (F.coalesce(ln["bold"], F.lit(False)) | (ln["size"] >= median + 1.0)).alias("heading"),
            ),
        )
        kept = F.filter(flagged, lambda f: f["text"] != "")
        between = lambda f, i: F.when(i == 0, "").when(f["heading"], "\n\n").otherwise("\n")
        return F.array_join(F.transform(kept, lambda f, i: F.concat(between(f, i), f["text"])), "")

    return let(F.coalesce(array_upper_median(sizes), F.lit(0.0)), build)
