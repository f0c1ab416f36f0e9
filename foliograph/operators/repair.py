"""Table repair from page layout, and glossary sections as tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliograph import constants as K
from foliograph.functions.tables import numeric_share
from foliograph.functions.text import (
    blank_to_null,
    is_numeric_token,
    is_term_candidate,
    let,
    norm_token,
    strip,
    text_or_empty,
)

STRINGS = "array<string>"


def header_positions(headers: Column, lines: Column) -> Column:
    """x of each header on the first line that holds a third of them; null if unknown."""
    need = F.greatest(F.lit(1), F.floor(F.size(headers) / 3).cast("int"))

    def hits(ln: Column) -> Column:
        text = norm_token(ln["text"])
        return F.size(F.filter(headers, lambda h: (text_or_empty(h) != "") & F.contains(text, norm_token(h))))

    line = F.get(F.filter(lines, lambda ln: hits(ln) >= need), F.lit(0))

    def locate(row: Column) -> Column:
        def one(h: Column) -> Column:
            key = norm_token(h)
            on_line = F.get(F.filter(row["spans"], lambda s: norm_token(s["text"]) == key), F.lit(0))["x"]
            around = F.get(
                F.filter(
                    F.flatten(F.transform(lines, lambda ln: ln["spans"])),
                    lambda s: (norm_token(s["text"]) == key) & (F.abs(s["y"] - row["y"]) < K.HEADER_GAP),
                ),
                F.lit(0),
            )["x"]
            return F.coalesce(on_line, around)

        return F.when(row.isNotNull(), F.transform(headers, one))

    return let(line, locate)


def nearest_index(x: Column, positions: Column) -> Column:
    """Index of the position nearest to ``x``, the first of equals; nulls do not count."""
    ranked = F.transform(
        positions, lambda p, i: F.when(p.isNotNull(), F.struct(F.abs(x - p).alias("d"), i.alias("i")))
    )
    return F.array_min(F.array_compact(ranked))["i"]


def row_spans(label: Column, lines: Column) -> Column:
    """Spans of the first line that holds the label, then of lines on the same visual row."""
    at = F.get(
        F.filter(
            F.transform(lines, lambda ln, i: F.struct(ln.alias("line"), i.alias("i"))),
            lambda k: F.contains(norm_token(k["line"]["text"]), norm_token(label)),
        ),
        F.lit(0),
    )

    def gather(k: Column) -> Column:
        near = F.filter(
            F.transform(lines, lambda ln, i: F.struct(ln.alias("line"), i.alias("i"))),
            lambda o: (F.abs(o["line"]["y"] - k["line"]["y"]) < K.LINE_GAP) & (o["i"] != k["i"]),
        )
        return F.when(
            k.isNotNull(), F.concat(k["line"]["spans"], F.flatten(F.transform(near, lambda o: o["line"]["spans"])))
        )

    return let(at, gather)


def _is_cell(text: Column) -> Column:
    t = strip(text_or_empty(text))
    return F.coalesce(is_numeric_token(t), F.lit(False)) | ((F.length(t) <= 6) & t.rlike(r"\p{Nd}"))


def realign_row(row: Column, headers: Column, positions: Column, lines: Column) -> Column:
    """The row with its cells taken from the page, each under its nearest header."""
    label = strip(text_or_empty(F.get(row, F.lit(0))))
    targets = F.slice(positions, F.lit(2), F.greatest(F.size(positions) - 1, F.lit(0)))

    def build(spans: Column) -> Column:
        cells = F.filter(spans, lambda s: _is_cell(s["text"]))
        placed = F.transform(
            cells,
            lambda s: F.struct(nearest_index(s["x"], targets).alias("i"), strip(s["text"]).alias("t")),
        )
        filled = F.transform(
            targets,
            lambda p, i: F.array_join(F.transform(F.filter(placed, lambda c: c["i"] == i), lambda c: c["t"]), " "),
        )
        return F.when(F.coalesce(F.size(cells), F.lit(0)) > 0, F.concat(F.array(label), filled)).otherwise(row)

    return F.when(label == "", row).otherwise(let(row_spans(label, lines), build))


def repair_table(headers: Column, rows: Column, lines: Column) -> Column:
    """Rows realigned to the page when that clearly raises the share of numbers."""

    def build(pos: Column) -> Column:
        known = F.coalesce(F.exists(pos, lambda p: p.isNotNull()), F.lit(False))

        def choose(new: Column) -> Column:
            better = numeric_share(new) >= numeric_share(rows) + K.REPAIR_MIN_GAIN
            return F.when(better, new).otherwise(rows)

        return F.when(known, let(F.transform(rows, lambda r: realign_row(r, headers, pos, lines)), choose)).otherwise(rows)

    return let(header_positions(headers, lines), build)


def glossary_pairs(content: Column) -> Column:
    """Terms with the lines up to the next term; line pairs when no term is found."""
    lines = F.filter(F.transform(F.split(text_or_empty(content), "\n"), strip), lambda t: t != "")
    zero = F.array().cast(f"array<{STRINGS}>")

    def step(acc: Column, ln: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        desc = strip(F.concat_ws(" ", F.nullif(F.get(last, F.lit(1)), F.lit("")), ln))
        return (
            F.when(is_term_candidate(ln), F.concat(acc, F.array(F.array(ln, F.lit("")))))
            .when(F.size(acc) == 0, acc)
            .otherwise(
                F.concat(
                    F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                    F.array(F.array(F.get(last, F.lit(0)), desc)),
                )
            )
        )

    def build(ls: Column) -> Column:
        half = F.floor(F.size(ls) / 2).cast("int")
        naive = F.when(half == 0, zero).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.greatest(half - 1, F.lit(0))),
                lambda k: F.array(F.get(ls, k * 2), F.get(ls, k * 2 + 1)),
            )
        )
        return let(F.aggregate(ls, zero, step), lambda pairs: F.when(F.size(pairs) > 0, pairs).otherwise(naive))

    return let(lines, build)


def glossary_tables(sections: Column, tables: Column, page: Column) -> Column:
    """New term tables of a page's glossary sections that no table repeats."""
    heads = F.filter(
        sections,
        lambda s: F.contains(F.lower(text_or_empty(s["heading"])), F.lit("glossary"))
        & blank_to_null(s["content"]).isNotNull(),
    )
    made = F.transform(
        heads,
        lambda s: F.struct(
            strip(s["heading"]).alias("title"),
            F.array(F.lit("Term"), F.lit("Definition")).alias("headers"),
            glossary_pairs(s["content"]).alias("rows"),
            page.cast("int").alias("page_number"),
        ),
    )
    return F.filter(
        made,
        lambda t: (F.size(t["rows"]) > 0)
        & ~F.exists(
            tables,
            lambda e: (F.coalesce(e["title"], F.lit("")) == t["title"]) & (F.size(e["rows"]) == F.size(t["rows"])),
        ),
    )


def clear_used_glossaries(sections: Column, new_tables: Column) -> Column:
    return F.transform(
        sections,
        lambda s: F.when(
            F.exists(new_tables, lambda t: t["title"] == strip(text_or_empty(s["heading"]))),
            F.struct(s["heading"].alias("heading"), F.lit("").alias("content")),
        ).otherwise(s),
    )
