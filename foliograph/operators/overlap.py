"""Local text that repeats extracted tables and charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.functions.text import (
    is_numeric_token,
    let,
    mostly_numeric_words,
    norm_token,
    strip,
    text_or_empty,
    token_list,
    words,
)
from foliograph.operators.ordered import lookup_join


def _normed(texts: Column) -> Column:
    return F.filter(F.transform(texts, norm_token), lambda t: t != "")


def extracted_tokens(tables: Column, charts: Column) -> Column:
    """Token sets of a page: whole strings, numbers, and single short tokens.

    ``tables`` has title, headers and rows; ``charts`` has title, x_values,
    y_values and series_values.
    """
    none = F.array().cast("array<string>")
    heads = F.flatten(F.transform(tables, lambda t: F.coalesce(t["headers"], none)))
    cells = F.flatten(F.transform(tables, lambda t: F.flatten(F.coalesce(t["rows"], F.array().cast("array<array<string>>")))))
    titles = F.concat(F.transform(tables, lambda t: t["title"]), F.transform(charts, lambda c: c["title"]))
    xs = F.flatten(F.transform(charts, lambda c: F.coalesce(c["x_values"], none)))
    ys = F.flatten(
        F.transform(charts, lambda c: F.concat(F.coalesce(c["y_values"], none), F.coalesce(c["series_values"], none)))
    )
    cell_tokens = F.flatten(F.transform(_normed(cells), lambda t: F.split(t, " ")))
    label_tokens = F.flatten(F.transform(_normed(F.concat(heads, xs)), lambda t: F.split(t, " ")))
    plain = F.transform(F.concat(cell_tokens, ys), lambda t: F.regexp_replace(t, ",", ""))
    digits = F.transform(cells, lambda c: F.regexp_replace(text_or_empty(c), ",", ""))
    sets = F.struct(
        F.array_distinct(_normed(F.concat(heads, cells, titles, xs, ys))).alias("whole"),
        F.array_distinct(F.filter(F.concat(plain, digits), lambda t: F.coalesce(is_numeric_token(t), F.lit(False)))).alias("numbers"),
        F.array_distinct(F.concat(cell_tokens, label_tokens)).alias("short"),
    )
    # A bare struct would be taken apart and worked out again for every line.
    return let(sets, lambda t: t)


def keep_line(line: Column, tokens: Column) -> Column:
    """Whether a local line says something the extracted tokens do not."""

    def judge(ws: Column, normed: Column, own: Column) -> Column:
        shared = F.size(F.array_intersect(own, tokens["whole"]))
        return (
            (F.size(own) > 0)
            & (shared * 10 < F.size(own) * 6)
            # joined, the normalised words are the normalised line
            & ~F.array_contains(tokens["whole"], F.array_join(normed, " "))
            & ~mostly_numeric_words(ws, tokens["numbers"])
        )

    return let(
        words(line),
        lambda ws: let(_normed(ws), lambda normed: let(F.array_distinct(normed), lambda own: judge(ws, normed, own))),
    )


def filter_sections(sections: Column, tokens: Column) -> Column:
    """Drop sections and lines that repeat the page's tables and charts."""

    def clean(s: Column) -> Column:
        lines = F.filter(F.transform(F.split(text_or_empty(s["content"]), "\n"), strip), lambda t: t != "")
        kept = F.filter(lines, lambda t: keep_line(t, tokens))
        head = norm_token(s["heading"])
        parts = F.filter(F.split(head, " "), lambda t: t != "")
        clash = (head != "") & (F.array_contains(tokens["whole"], head) | F.arrays_overlap(parts, tokens["whole"]))
        hollow = F.forall(parts, lambda t: F.array_contains(tokens["short"], t) | is_numeric_token(t))

        def verdict(k: Column) -> Column:
            keep = ~clash & ((F.size(k) > 0) | ((head != "") & ~hollow))
            return F.when(keep, F.struct(s["heading"].alias("heading"), F.array_join(k, "\n").alias("content")))

        return let(kept, verdict)

    return F.array_compact(F.transform(sections, clean))


def unmatched_lines(lines: DataFrame, keys: list[str], text: str, vocabulary: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Lines across documents that neither equal a vocabulary text nor share
    ``threshold`` of their tokens with it.

    ``vocabulary`` has one column ``token`` of normalised strings. Tokens are
    matched per distinct (line, token); the line itself goes as a token too, so
    one join answers both rules.
    """
    vocab = vocabulary.select(F.col("token").alias("__token")).where(F.col("__token") != "").distinct()
    known = vocab.withColumn("__hit", F.lit(1))
    asked = lines.select(
        *keys,
        F.explode(
            F.concat(
                F.transform(token_list(F.col(text)), lambda t: F.struct(t.alias("t"), F.lit(0).alias("w"))),
                F.array(F.struct(norm_token(F.col(text)).alias("t"), F.lit(1).alias("w"))),
            )
        ).alias("q"),
    ).select(*keys, F.col("q.t").alias("__token"), F.col("q.w").alias("__whole"))
    matched = lookup_join(asked, known, ["__token"], "left")
    per_line = matched.groupBy(*keys).agg(
        F.sum(F.when(F.col("__whole") == 0, 1).otherwise(0)).alias("n_tokens"),
        F.sum(F.when((F.col("__whole") == 0) & F.col("__hit").isNotNull(), 1).otherwise(0)).alias("n_shared"),
        F.max(F.when((F.col("__whole") == 1) & F.col("__hit").isNotNull(), 1).otherwise(0)).alias("is_whole"),
    )
    return per_line.where(
        (F.col("n_tokens") > 0)
        & (F.col("is_whole") == 0)
        & (F.col("n_shared") * 1000 < F.col("n_tokens") * int(round(threshold * 1000)))
    ).drop("is_whole")
