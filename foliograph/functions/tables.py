"""Table cells inside one row: shaping, rotation, rendering, comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliograph import constants as K
from foliograph.functions.text import (
    blank_to_null,
    is_number_like,
    is_numeric_token,
    key_label,
    let,
    norm_token,
    text_or_empty,
)


def _pad(cells: Column, width: Column, filler: Column) -> Column:
    return F.concat(cells, F.array_repeat(filler, F.greatest(F.lit(0), width - F.size(cells))))


def column_names(n: Column) -> Column:
    return F.when(n <= 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.lit("col_"), i.cast("string")))
    )


def widest(rows: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0))


def default_headers(headers: Column, rows: Column) -> Column:
    return F.when(F.coalesce(F.size(headers), F.lit(0)) > 0, headers).otherwise(column_names(widest(rows)))


def whole_headers(headers: Column, rows: Column) -> Column:
    """Headers for the widest row: cells beyond the given ones get ``col_n``."""
    given = F.coalesce(headers, F.array().cast("array<string>"))
    names = column_names(widest(rows))
    return F.concat(given, F.slice(names, F.size(given) + 1, F.greatest(F.size(names) - F.size(given), F.lit(0))))


def normalise_rows(headers: Column, rows: Column) -> Column:
    """Pad every row with nulls to the header width; wider rows stay."""
    return F.transform(rows, lambda r: _pad(r, F.size(headers), F.lit(None).cast("string")))


def json_row_headers(rows: Column) -> Column:
    """First-seen order of the keys of the object rows; ``rows`` holds JSON texts."""
    keys = F.transform(
        F.filter(rows, lambda r: F.ltrim(r).startswith("{")), lambda r: F.json_object_keys(r)
    )
    return F.array_distinct(F.flatten(keys))


def json_rows(headers: Column, rows: Column) -> Column:
    """List rows as they are, object rows by header, scalars as a first cell."""

    def one(r: Column) -> Column:
        t = F.ltrim(r)
        return (
            F.when(t.startswith("["), F.from_json(t, "array<string>"))
            .when(
                t.startswith("{"),
                let(
                    F.from_json(t, "map<string,string>"),
                    lambda m: F.transform(headers, lambda h: F.try_element_at(m, h)),
                ),
            )
            .otherwise(F.array(r))
        )

    return F.transform(rows, one)


def shape_json_table(headers: Column, rows: Column) -> Column:
    """Headers and null-padded rows of a table whose rows are JSON texts."""
    first = F.when(F.coalesce(F.size(headers), F.lit(0)) > 0, headers).otherwise(json_row_headers(rows))

    def build(h0: Column) -> Column:
        return let(
            json_rows(h0, rows),
            lambda rs: let(
                whole_headers(h0, rs),
                lambda h: F.struct(h.alias("headers"), normalise_rows(h, rs).alias("rows")),
            ),
        )

    return let(first, build)


def rotate_shifted_rows(headers: Column, rows: Column, keep_wide: bool = False) -> Column:
    """Undo rows shifted left under a blank leading header.

    A row that ends blank and has a number in its first data cell gets a blank
    inserted after its label. Rows then line up under ``headers``; with
    ``keep_wide`` the blank leading header is dropped, leaving rows one wider.
    """
    n = F.size(headers)

    def shifted(r: Column) -> Column:
        return (blank_to_null(F.get(r, n - 1)).isNull()) & is_number_like(F.get(r, F.lit(1)))

    def fix(r: Column) -> Column:
        moved = F.concat(F.array(F.get(r, F.lit(0)), F.lit("")), F.slice(r, F.lit(2), F.greatest(n - 2, F.lit(0))))
        moved = F.concat(moved, F.slice(r, n + 1, F.greatest(F.size(r) - n, F.lit(0))))
        return F.when(shifted(r), _pad(moved, n, F.lit(""))).otherwise(r)

    padded = F.transform(rows, lambda r: _pad(r, n, F.lit("")))

    def build(p: Column) -> Column:
        changed = (
            (n > 0)
            & blank_to_null(F.get(headers, F.lit(0))).isNull()
            & F.exists(p, shifted)
        )
        shown = F.slice(headers, F.lit(2), F.greatest(n - 1, F.lit(0))) if keep_wide else headers
        return F.struct(
            F.when(changed, shown).otherwise(headers).alias("headers"),
            F.when(changed, F.transform(p, fix)).otherwise(rows).alias("rows"),
            F.coalesce(changed, F.lit(False)).alias("rotated"),
        )

    return let(padded, build)


def drop_blank_lead(headers: Column, rows: Column) -> Column:
    """Drop a blank leading header whose first data column is blank in every row;
    else, when 40% of the rows end blank with data in front, shift all rows right."""
    n = F.size(headers)
    blank_lead = (n > 0) & (F.size(rows) > 0) & blank_to_null(F.get(headers, F.lit(0))).isNull()
    first_blank = F.forall(rows, lambda r: blank_to_null(F.get(r, F.lit(1))).isNull())
    hits = F.size(
        F.filter(
            rows,
            lambda r: blank_to_null(F.try_element_at(r, F.lit(-1))).isNull()
            & blank_to_null(F.get(r, F.lit(1))).isNotNull(),
        )
    )
    often = hits * 10 >= F.size(rows) * 4
    rest = F.slice(headers, F.lit(2), F.greatest(n - 1, F.lit(0)))
    clean = F.transform(rows, lambda r: F.transform(r, text_or_empty))

    def left(r: Column) -> Column:
        return _pad(F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))), n, F.lit(""))

    def right(r: Column) -> Column:
        middle = F.slice(r, F.lit(2), F.greatest(F.size(r) - 2, F.lit(0)))
        return _pad(F.concat(F.array(F.get(r, F.lit(0)), F.lit("")), middle), n, F.lit(""))

    return F.struct(
        F.when(blank_lead & (first_blank | often), rest).otherwise(headers).alias("headers"),
        F.when(blank_lead & first_blank, F.transform(clean, left))
        .when(blank_lead & often, F.transform(clean, right))
        .otherwise(rows)
        .alias("rows"),
    )


def markdown(headers: Column, rows: Column) -> Column:
    """Pipe table; short rows are padded, surplus cells fold into the last one."""

    def line(cells: Column) -> Column:
        return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    def render(h: Column) -> Column:
        n = F.size(h)

        def body(r: Column) -> Column:
            cells = F.transform(r, text_or_empty)
            folded = F.when(
                F.size(cells) > n,
                F.concat(
                    F.slice(cells, F.lit(1), F.greatest(n - 1, F.lit(0))),
                    F.array(F.array_join(F.slice(cells, F.greatest(n, F.lit(1)), F.size(cells)), " | ")),
                ),
            ).otherwise(_pad(cells, n, F.lit("")))
            return line(F.transform(folded, lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))))

        head = line(F.transform(h, text_or_empty))
        rule = line(F.transform(h, lambda c: F.lit("---")))
        return F.array_join(F.concat(F.array(head, rule), F.transform(rows, body)), "\n")

    return let(default_headers(headers, rows), render)


def numeric_share(rows: Column) -> Column:
    """Share of number cells outside the label column; 0 without such cells."""
    cells = F.flatten(F.transform(rows, lambda r: F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(1)))))
    return let(
        cells,
        lambda cs: F.when(
            F.size(cs) > 0,
            F.size(F.filter(cs, lambda c: F.coalesce(is_numeric_token(c), F.lit(False)))) / F.size(cs),
        ).otherwise(F.lit(0.0)),
    )


def _norm_list(cells: Column) -> Column:
    return F.transform(F.filter(cells, lambda c: blank_to_null(c).isNotNull()), norm_token)


def is_duplicate_table(new: Column, existing: Column) -> Column:
    """Some existing table shares 70% of the headers or 60% of the first row."""

    def judge(n: Column) -> Column:
        def shares(own: Column, cells: Column, tenths: int) -> Column:
            enough = lambda other: (F.size(other) > 0) & (F.size(F.array_intersect(own, other)) * 10 >= F.size(own) * tenths)
            return (F.size(own) > 0) & let(_norm_list(cells), enough)

        def alike(e: Column) -> Column:
            first = F.coalesce(F.get(e["rows"], F.lit(0)), F.array().cast("array<string>"))
            return shares(n["h"], e["headers"], 7) | shares(n["f"], first, 6)

        return F.exists(existing, alike)

    key = F.struct(
        _norm_list(new["headers"]).alias("h"),
        _norm_list(F.coalesce(F.get(new["rows"], F.lit(0)), F.array().cast("array<string>"))).alias("f"),
    )
    return let(key, judge)


def key_value_rows(m: Column) -> Column:
    """A map as ``Field``/``Value`` rows."""
    return F.transform(F.map_entries(m), lambda e: F.array(e["key"], e["value"]))


def zip_columns(columns: Column) -> Column:
    """Ragged columns to rows, blanks where a column is short."""
    height = F.coalesce(F.array_max(F.transform(columns, lambda c: F.size(c))), F.lit(0))
    rows = F.transform(
        F.sequence(F.lit(0), F.greatest(height - 1, F.lit(0))),
        lambda i: F.transform(columns, lambda c: text_or_empty(F.get(c, i))),
    )
    return F.when(height > 0, rows).otherwise(F.array().cast("array<array<string>>"))


def table_text(prefix: Column, title_prefix: Column, title: Column, text: Column, headers: Column, rows: Column) -> Column:
    """Rendered table chunk: breadcrumb, title, blank line, markdown."""
    shown = F.coalesce(F.nullif(title, F.lit("")), text_or_empty(text))
    full = F.when(
        F.coalesce(title_prefix, F.lit("")) != "",
        F.trim(F.concat(F.trim(title_prefix), F.lit(" "), shown)),
    ).otherwise(shown)
    has_cells = (F.coalesce(F.size(headers), F.lit(0)) > 0) & (F.coalesce(F.size(rows), F.lit(0)) > 0)
    body = F.when(has_cells, markdown(headers, rows)).otherwise(text_or_empty(text))
    joined = F.concat(prefix, full, F.lit("\n\n"), body)
    return F.when(prefix != "", F.btrim(joined, F.lit(K.SPACE_CHARS))).otherwise(joined)
