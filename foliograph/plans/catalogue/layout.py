"""Queries over page layout; every document is laid out as a page of lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.functions import text as T
from foliograph.operators import layout as L
from foliograph.operators import overlap as V
from foliograph.operators.ordered import islands, neighbour_counts
from foliograph.plans.registry import (
    Q_LINES,
    document_lines,
    q_count,
    q_norm,
    q_tokens,
    query,
    table,
    wide_table,
)

c = F.col


SPAN = ("text", "x", "y", "size", "bold", "font")


def laid_out(spark, d, span=SPAN):
    """Documents with ``lines``: position, size and spans follow from each line's text.

    A line has a span for every word, so a query names the span fields that it
    reads, as it would name columns; with none, lines carry no spans. They are
    made once lines are in order, since whatever moves a line copies its spans;
    fields that are the same in every line are made once a text.
    """

    def line(text, n, i):
        size = F.when(n <= 3, 11.5).otherwise(10.0) + (F.length(text) % 3) * 0.2
        y = (i + 1) * 7.0 + (F.length(text) % 5) * 2.0
        facts = [text.alias("text"), F.lit(50.0).alias("x"), y.alias("y"), size.alias("size"), F.lit(True).alias("bold")]
        return F.struct(*facts, *([n.alias("n")] if span else []))

    def made(k, few, word=None, ln=None):
        fields = {
            "text": lambda: word,
            "x": lambda: k * 40.0 + 50.0,
            "y": lambda: ln["y"],
            "size": lambda: ln["size"],
            "bold": lambda: (k % 2 == 0) | few,
            "font": lambda: F.lit("Plain"),
        }
        return F.struct(*[fields[f]().alias(f) for f in span])

    def spanned(lines, spans):
        facts = lambda ln: [ln[f].alias(f) for f in ("text", "x", "y", "size", "bold")]
        return F.transform(lines, lambda ln: F.struct(*facts(ln), spans(ln).alias("spans")))

    def with_spans(lines):
        if "text" in span:
            return spanned(lines, lambda ln: F.transform(F.split(ln["text"], " "), lambda w, k: made(k, ln["n"] <= 3, w, ln)))
        if not {"x", "bold"} & set(span):
            return spanned(lines, lambda ln: F.array_repeat(made(None, None, ln=ln), ln["n"]))
        if {"y", "size"} & set(span):
            return spanned(lines, lambda ln: F.transform(F.sequence(F.lit(0), ln["n"] - 1), lambda k: made(k, ln["n"] <= 3, ln=ln)))
        most = F.array_max(F.transform(lines, lambda ln: ln["n"]))
        row = lambda n, few: F.transform(F.sequence(F.lit(0), n - 1), lambda k: made(k, F.lit(few)))
        of = lambda long, short: spanned(lines, lambda ln: F.slice(F.when(ln["n"] <= 3, short).otherwise(long), F.lit(1), ln["n"]))
        return T.let(row(most, False), lambda long: T.let(row(F.lit(3), True), lambda short: of(long, short)))

    # Tested on the raw text: a test of "l" would be pushed down and find the lines twice.
    docs = wide_table(spark, d, "documents", "doc_id", "text").where(T.has_line(c("text")))
    words = lambda text: F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    lines = L.sort_lines(F.transform("l", lambda text, i: T.let(words(text), lambda n: line(text, n, i))))
    return docs.withColumn("l", T.nonblank_lines(c("text"))).select("doc_id", (T.let(lines, with_spans) if span else lines).alias("lines"))


Q_LAID = f"""{Q_LINES}, placed AS (
  SELECT doc_id, line_no, line, string_split(line, ' ') AS w, line_no * 7.0::DOUBLE + (length(line) % 5) * 2.0::DOUBLE AS y,
    (CASE WHEN len(string_split(line, ' ')) <= 3 THEN 11.5::DOUBLE ELSE 10.0::DOUBLE END) + (length(line) % 3) * 0.2::DOUBLE AS size
  FROM lines),
laid AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY y, line_no) AS i FROM placed)"""


@query("line_sort", f"WITH {Q_LAID} SELECT doc_id, i, line FROM laid")
def line_sort(spark, d):
    rows = laid_out(spark, d, span=()).select("doc_id", F.posexplode(F.transform("lines", lambda ln: ln["text"])).alias("p", "line"))
    return rows.select("doc_id", (c("p") + 1).cast("bigint").alias("i"), "line")


@query(
    "line_merge",
    f"""WITH RECURSIVE {Q_LAID}, walk AS (
      SELECT doc_id, i, y AS start_y, 1 AS g FROM laid WHERE i = 1
      UNION ALL
      SELECT l.doc_id, l.i, CASE WHEN abs(l.y - k.start_y) <= 6.0 THEN k.start_y ELSE l.y END,
             CASE WHEN abs(l.y - k.start_y) <= 6.0 THEN k.g ELSE k.g + 1 END
      FROM walk k JOIN laid l ON l.doc_id = k.doc_id AND l.i = k.i + 1)
    SELECT k.doc_id, CAST(k.g AS BIGINT) AS g, count(*) AS n_lines, string_agg(l.line, chr(10) ORDER BY l.i) AS text,
           CAST(sum(len(l.w)) AS BIGINT) AS n_spans
    FROM walk k JOIN laid l ON l.doc_id = k.doc_id AND l.i = k.i GROUP BY k.doc_id, k.g""",
)
def line_merge(spark, d):
    merged = laid_out(spark, d, span=("y",)).select("doc_id", F.posexplode(L.merge_lines(c("lines"))).alias("p", "m"))
    return merged.select(
        "doc_id",
        (c("p") + 1).cast("bigint").alias("g"),
        F.size(F.split("m.text", "\n")).cast("bigint").alias("n_lines"),
        c("m.text").alias("text"),
        F.size("m.spans").cast("bigint").alias("n_spans"),
    )


Q_FLAGGED = rf"""{Q_LAID}, med AS (
  SELECT doc_id, list_sort(list(greatest(0.1, size)))[count(*) // 2 + 1] AS m FROM laid GROUP BY doc_id),
facts AS (
  SELECT l.*, m, {q_count('line')} AS n, len(list_filter(generate_series(0, len(w) - 1), lambda k: k % 2 = 0 OR len(w) <= 3)) * 1.0::DOUBLE / len(w) AS bold,
    len(regexp_extract_all(line, '\p{{L}}')) AS letters, lead(y) OVER (PARTITION BY l.doc_id ORDER BY i) - y AS gap,
    regexp_matches(line, '\p{{Lu}}') AND NOT regexp_matches(line, '[\p{{Ll}}\p{{Lt}}\p{{Lm}}\p{{Lo}}]') AS caps
  FROM laid l JOIN med ON l.doc_id = med.doc_id),
flagged AS (
  SELECT doc_id, i, line, ((bold >= 0.7 AND n <= 9 AND size >= m + 0.6) OR (caps AND n <= 8 AND size >= m + 0.2)
      OR (i <= 4 AND size >= m + 1.0 AND n <= 12))
    AND NOT (regexp_matches(line, '^[:.\-–—%\d]') OR letters < length(line) * 0.25 OR length(line) > 220)
    AND NOT coalesce(gap <= 6.0, false) AND n <= 25 AS heading FROM facts)"""


@query("heading_flags", f"WITH {Q_FLAGGED} SELECT doc_id, i, heading FROM flagged")
def heading_flags(spark, d):
    rows = laid_out(spark, d, span=("bold",)).select("doc_id", F.posexplode(L.flag_headings(c("lines"))).alias("p", "f"))
    return rows.select("doc_id", (c("p") + 1).cast("bigint").alias("i"), c("f.heading").alias("heading"))


@query(
    "section_assembly",
    f"""WITH {Q_FLAGGED}, numbered AS (
      SELECT *, sum(CASE WHEN heading THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM flagged),
    sections AS (SELECT doc_id, s, max(CASE WHEN heading THEN line END) AS heading,
        trim(regexp_replace(coalesce(string_agg(CASE WHEN NOT heading THEN line END, chr(10) ORDER BY i), ''), '\\s{{2,}}', ' ', 'g')) AS content
      FROM numbered GROUP BY doc_id, s)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) AS section_no, heading, content FROM sections""",
)
def section_assembly(spark, d):
    rows = laid_out(spark, d, span=("bold",)).select(
        "doc_id", F.posexplode(L.assemble_sections(L.flag_headings(c("lines")))).alias("p", "s")
    )
    return rows.select("doc_id", (c("p") + 1).cast("bigint").alias("section_no"), "s.heading", "s.content")


@query("page_sections")
def page_sections(spark, d):
    rows = laid_out(spark, d, span=("bold",)).select("doc_id", F.posexplode(L.page_sections(c("lines"))).alias("p", "s"))
    return rows.select("doc_id", (c("p") + 1).cast("bigint").alias("section_no"), "s.heading", "s.content")


@query(
    "heading_merge",
    f"""WITH {Q_LINES}, h AS (
      SELECT doc_id, line_no, lower(string_split(line, ' ')[1]) AS k, string_split(line, ' ')[1] AS heading, line FROM lines),
    b AS (SELECT *, CASE WHEN k = lag(k) OVER (PARTITION BY doc_id ORDER BY line_no) THEN 0 ELSE 1 END AS brk FROM h),
    r AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id ORDER BY line_no) AS s FROM b)
    SELECT doc_id, CAST(s AS BIGINT) AS section_no, arg_min(heading, line_no) AS heading, string_agg(line, ' ' ORDER BY line_no) AS content
    FROM r GROUP BY doc_id, s""",
)
def heading_merge(spark, d):
    """Lines as sections under their first word; equal neighbours merge."""
    docs = wide_table(spark, d, "documents", "doc_id", "text").withColumn("l", T.nonblank_lines(c("text")))
    sections = F.transform(
        "l", lambda x: F.struct(F.get(F.split(x, " "), F.lit(0)).alias("heading"), x.alias("content"))
    )
    rows = docs.select("doc_id", F.posexplode(L.merge_same_headings(sections)).alias("p", "s"))
    return rows.select("doc_id", (c("p") + 1).cast("bigint").alias("section_no"), "s.heading", "s.content")


@query(
    "title_candidates",
    f"""WITH {Q_LAID}, top AS (SELECT * FROM laid WHERE i <= 6),
    best AS (SELECT doc_id, line, size FROM top QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY size DESC, y, i) = 1),
    second AS (SELECT doc_id, line, size FROM top QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY y, i) = 2)
    SELECT b.doc_id, CASE WHEN length(b.line) < 160 AND {q_count('b.line')} <= 10 THEN b.line END AS title,
      CASE WHEN length(b.line) < 160 AND {q_count('b.line')} <= 10 AND (s.size < b.size OR starts_with(s.line, '(')) THEN s.line END AS subtitle
    FROM best b LEFT JOIN second s ON b.doc_id = s.doc_id""",
)
def title_candidates(spark, d):
    """The first six lines alone, as the SQL has it."""
    return titles_of(laid_out(spark, d, span=()), compat=True)


def titles_of(pages, compat):
    return pages.select("doc_id", L.title_candidates(c("lines"), compat).alias("t")).select("doc_id", "t.title", "t.subtitle")


@query(
    "title_candidates_all_lines",
    f"""WITH {Q_LAID},
    best AS (SELECT doc_id, line, size FROM laid QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY size DESC, y, i) = 1),
    second AS (SELECT doc_id, line, size FROM laid WHERE i = 2)
    SELECT b.doc_id, CASE WHEN length(b.line) < 160 AND {q_count('b.line')} <= 10 THEN b.line END AS title,
      CASE WHEN length(b.line) < 160 AND {q_count('b.line')} <= 10 AND (s.size < b.size OR starts_with(s.line, '(')) THEN s.line END AS subtitle
    FROM best b LEFT JOIN second s ON b.doc_id = s.doc_id""",
)
def title_candidates_all_lines(spark, d):
    return titles_of(laid_out(spark, d, span=()), compat=False)


@query(
    "rows_by_y",
    f"""WITH {Q_LAID} SELECT doc_id, CAST(round_even(y, 0) AS INTEGER) AS y, CAST(sum(len(w)) AS BIGINT) AS n_spans
    FROM laid GROUP BY ALL""",
)
def rows_by_y(spark, d):
    rows = laid_out(spark, d, span=("y",)).select("doc_id", F.explode(L.rows_by_y(c("lines"))).alias("r"))
    return rows.select("doc_id", "r.y", F.size("r.spans").cast("bigint").alias("n_spans"))


Q_BOX_X = "CAST(round_even(50.0 + 40.0 * (len(w) - 1), 0) AS INTEGER)"


@query(
    "glossary_box",
    f"""WITH {Q_LAID}, ok AS (SELECT *, len(w) >= 2 AS ok FROM laid),
    b AS (SELECT *, CASE WHEN ok AND lag(ok) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS brk FROM ok),
    r AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM b),
    runs AS (SELECT doc_id, g, count(*) AS n, min(y) AS y0, max(y) AS y1 FROM r WHERE ok GROUP BY doc_id, g HAVING count(*) >= 4),
    best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, g) = 1)
    SELECT doc_id, 42 AS x0, CAST(round_even(y0, 0) AS INTEGER) - 6 AS y0, 150 AS x1, CAST(round_even(y1, 0) AS INTEGER) + 12 AS y1 FROM best""",
)
def glossary_box(spark, d):
    # Exploding drops the nulls; a filter would be pushed down and find each box twice.
    found = F.array_compact(F.array(L.glossary_box(c("lines"))))
    boxes = laid_out(spark, d, span=("text", "x")).select("doc_id", F.explode(found).alias("b"))
    return boxes.select("doc_id", "b.x0", "b.y0", "b.x1", "b.y1")


@query(
    "column_bands",
    f"""WITH {Q_LAID}, rws AS (SELECT doc_id, CAST(round_even(y, 0) AS INTEGER) AS y, sum(len(w)) AS n, max({Q_BOX_X}) AS x FROM laid GROUP BY ALL),
    wide AS (SELECT * FROM rws WHERE n >= 2),
    b AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY doc_id ORDER BY y) <= 20 THEN 0 ELSE 1 END AS brk FROM wide),
    r AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id ORDER BY y) AS g FROM b)
    SELECT doc_id, 42 AS x0, greatest(0, min(y) - 6) AS y0, max(x) + 60 AS x1, max(y) + 18 AS y1 FROM r GROUP BY doc_id, g HAVING count(*) >= 3""",
)
def column_bands(spark, d):
    boxes = laid_out(spark, d, span=("x",)).select("doc_id", F.explode(L.column_bands(c("lines"))).alias("b"))
    return boxes.select("doc_id", "b.x0", "b.y0", "b.x1", "b.y1")


@query(
    "heading_boxes",
    f"""WITH {Q_LAID}, hit AS (SELECT doc_id, i AS line_at, y AS top FROM laid WHERE regexp_matches(line, '(?i)(?:^|[^\\p{{L}}\\p{{N}}_])(?:the the|de la)(?:$|[^\\p{{L}}\\p{{N}}_])'))
    SELECT h.doc_id, line_at, 42 AS x0, CAST(greatest(0, top - 6) AS INTEGER) AS y0, max({Q_BOX_X}) + 60 AS x1, CAST(max(l.y) + 6 AS INTEGER) AS y1
    FROM hit h JOIN laid l ON l.doc_id = h.doc_id AND l.i BETWEEN line_at AND line_at + 4 GROUP BY h.doc_id, line_at, top""",
)
def heading_boxes(spark, d):
    """Five lines each, as the SQL has it."""
    return heading_boxes_of(laid_out(spark, d, span=("x",)), compat=True)


@query(
    "heading_boxes_whole_tables",
    f"""WITH {Q_LAID}, hit AS (SELECT doc_id, i AS line_at, y AS top FROM laid WHERE regexp_matches(line, '(?i)(?:^|[^\\p{{L}}\\p{{N}}_])(?:the the|de la)(?:$|[^\\p{{L}}\\p{{N}}_])')),
    runs AS (SELECT doc_id, min(i) AS a, max(i) AS z FROM (
      SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM laid WHERE len(w) >= 2) GROUP BY doc_id, g),
    ends AS (SELECT h.doc_id, line_at, top, max(z) AS z FROM hit h LEFT JOIN runs r ON r.doc_id = h.doc_id AND r.a <= line_at + 4 GROUP BY h.doc_id, line_at, top)
    SELECT h.doc_id, line_at, 42 AS x0, CAST(greatest(0, top - 6) AS INTEGER) AS y0, max({Q_BOX_X}) + 60 AS x1, CAST(max(l.y) + 6 AS INTEGER) AS y1
    FROM ends h JOIN laid l ON l.doc_id = h.doc_id AND l.i BETWEEN line_at AND CASE WHEN z > line_at THEN z ELSE line_at + 4 END
    GROUP BY h.doc_id, line_at, top""",
)
def heading_boxes_whole_tables(spark, d):
    return heading_boxes_of(laid_out(spark, d, span=("x",)), compat=False)


def heading_boxes_of(pages, compat):
    pats = [r"\bthe the\b", r"\bde la\b"]
    known = pages.withColumn("at", L.heading_lines(c("lines"), pats))
    found = known.select(
        "doc_id",
        F.explode(
            F.arrays_zip(
                F.transform("at", lambda i: i + 1).alias("line_at"),
                L.heading_boxes(c("lines"), pats, compat=compat, at=c("at")).alias("b"),
            )
        ).alias("z"),
    )
    return found.select("doc_id", c("z.line_at").cast("bigint").alias("line_at"), "z.b.x0", "z.b.y0", "z.b.x1", "z.b.y1")


@query(
    "priority_box",
    """SELECT c_custkey, 2 AS x0, CASE WHEN c_acctbal > 0 THEN 14 ELSE 22 END AS y0, 160 AS x1,
      CASE WHEN c_acctbal > 0 THEN 70 ELSE 70 END AS y1 FROM customer""",
)
def priority_box(spark, d):
    """A priority heading on top when the balance is positive, else only a numeric band."""

    def line(y, *words):
        spans = F.array(*[F.struct(w.alias("text"), F.lit(10.0 + 90.0 * k).alias("x")) for k, w in enumerate(words)])
        return F.struct(F.array_join(F.transform(spans, lambda s: s["text"]), " ").alias("text"), F.lit(y).alias("y"), spans.alias("spans"))

    key, bal = c("c_custkey").cast("string"), F.format_number("c_acctbal", 2)
    top = F.when(c("c_acctbal") > 0, F.lit("Systematic Investment Plan")).otherwise(F.lit("Balances"))
    rows = [line(30.0 + 10 * k, key, F.concat(F.lit("Rs"), bal)) for k in range(4)]
    lines = F.array(line(20.0, top), *rows)
    return (
        table(spark, d, "customer")
        .select("c_custkey", L.priority_box(lines).alias("b"))
        .select("c_custkey", "b.x0", "b.y0", "b.x1", "b.y1")
    )


@query(
    "empty_pages",
    "SELECT page_id, length(trim(html)) = 0 OR contains(url, 'utm_source') AS empty FROM pages",
)
def empty_pages(spark, d):
    p = table(spark, d, "pages")
    text = F.when(c("url").contains("utm_source"), "  \n").otherwise(c("html"))
    return p.select("page_id", L.is_empty_page(text, F.lit(0), F.lit(None).cast("int"), F.lit(0)).alias("empty"))


@query("span_lines", f"WITH {Q_LAID} SELECT doc_id, i, line AS text, len(w) AS n_spans FROM laid WHERE NOT regexp_full_match(line, '(?i)page\\s*\\d+')")
def span_lines(spark, d):
    spans = F.transform("lines", lambda ln: F.concat(ln["spans"], F.array(F.get(ln["spans"], F.lit(0)).withField("text", F.lit("  ")))))
    rows = laid_out(spark, d).select("doc_id", F.posexplode(L.lines_from_spans(spans)).alias("p", "ln"))
    return rows.select(
        "doc_id", (c("p") + 1).cast("bigint").alias("i"), c("ln.text").alias("text"), F.size("ln.spans").cast("bigint").alias("n_spans")
    )


@query(
    "fallback_text",
    f"""WITH {Q_LAID}, med AS (SELECT doc_id, list_sort(list(size))[count(*) // 2 + 1] AS m FROM laid GROUP BY doc_id),
    f AS (SELECT l.doc_id, i, line, size >= m + 1.0 AS heading FROM laid l JOIN med ON l.doc_id = med.doc_id)
    SELECT doc_id, string_agg(CASE WHEN i = 1 THEN line WHEN heading THEN chr(10) || chr(10) || line ELSE chr(10) || line END, '' ORDER BY i) AS text
    FROM f GROUP BY doc_id""",
)
def fallback_text(spark, d):
    plain = F.transform("lines", lambda ln: ln.withField("bold", F.lit(False)))
    return laid_out(spark, d, span=()).select("doc_id", L.fallback_text(plain).alias("text"))


@query(
    "section_filter",
    f"""WITH {Q_LINES}, f AS (SELECT doc_id, list_filter(list_transform(string_split(line, ' '), lambda w: {q_norm('w')}), lambda w: w <> '') AS t
      FROM lines WHERE line_no = 1),
    k AS (SELECT l.doc_id, l.line_no, l.line, {q_tokens('l.line')} AS own, t, {q_norm('l.line')} AS whole FROM lines l JOIN f ON l.doc_id = f.doc_id WHERE l.line_no > 1)
    SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS content FROM k
    WHERE len(own) > 0 AND NOT list_contains(t, whole) AND len(list_intersect(own, list_distinct(t))) * 1.0 / len(own) < 0.6 GROUP BY doc_id""",
)
def section_filter(spark, d):
    """The words of the first line as table cells; later lines that repeat them go."""
    docs = wide_table(spark, d, "documents", "doc_id", "text").where(T.has_line(c("text"))).withColumn("l", T.nonblank_lines(c("text")))
    none = F.array().cast("array<string>")
    tables = F.array(
        F.struct(F.lit("").alias("title"), none.alias("headers"), F.array(F.split(F.get("l", F.lit(0)), " ")).alias("rows"))
    )
    charts = F.array().cast("array<struct<title:string,x_values:array<string>,y_values:array<string>,series_values:array<string>>>")
    rest = F.array_join(F.slice("l", F.lit(2), F.greatest(F.size("l") - 1, F.lit(0))), "\n")
    sections = F.array(F.struct(F.lit("").alias("heading"), rest.alias("content")))
    known = docs.withColumn("t", V.extracted_tokens(tables, charts))
    return known.select("doc_id", F.inline(V.filter_sections(sections, c("t")))).select("doc_id", "content")


@query(
    "heading_clash",
    f"""WITH {Q_LINES}, f AS (SELECT doc_id, list_filter(list_transform(string_split(line, ' '), lambda w: {q_norm('w')}), lambda w: w <> '') AS t
      FROM lines WHERE line_no = 1),
    h AS (SELECT doc_id, line_no, array_to_string(string_split(line, ' ')[1:2], ' ') AS heading FROM lines WHERE line_no > 1),
    k AS (SELECT h.*, t, {q_norm('heading')} AS head FROM h JOIN f ON h.doc_id = f.doc_id)
    SELECT doc_id, count(*) FILTER (good) AS kept, coalesce(string_agg(heading, ' | ' ORDER BY line_no) FILTER (good), '') AS headings
    FROM (SELECT *, head <> '' AND NOT list_contains(t, head) AND NOT list_has_any(string_split(head, ' '), t)
        AND len(list_filter(string_split(head, ' '), lambda w: w <> '' AND NOT list_contains(string_split(array_to_string(t, ' '), ' '), w)
          AND NOT regexp_full_match(w, '[-0-9.,]+'))) > 0 AS good FROM k)
    GROUP BY doc_id""",
)
def heading_clash(spark, d):
    """Each later line heads a section by its first two words; headings with a word of the table in the first line, or of such words alone, go."""
    docs = wide_table(spark, d, "documents", "doc_id", "text").withColumn("l", T.nonblank_lines(c("text")))
    none = F.array().cast("array<string>")
    tables = F.array(
        F.struct(F.lit("").alias("title"), none.alias("headers"), F.array(F.split(F.get("l", F.lit(0)), " ")).alias("rows"))
    )
    charts = F.array().cast("array<struct<title:string,x_values:array<string>,y_values:array<string>,series_values:array<string>>>")
    rest = F.slice("l", F.lit(2), F.greatest(F.size("l") - 1, F.lit(0)))
    heads = F.transform(rest, lambda x: F.array_join(F.slice(F.split(x, " "), 1, 2), " "))
    sections = F.transform(heads, lambda h: F.struct(h.alias("heading"), F.lit("").alias("content")))
    known = docs.where(F.size("l") > 1).withColumn("t", V.extracted_tokens(tables, charts))
    kept = known.select("doc_id", V.filter_sections(sections, c("t")).alias("s"))
    return kept.select("doc_id", F.size("s").cast("bigint").alias("kept"), F.array_join("s.heading", " | ").alias("headings"))


@query(
    "local_lines_unmatched",
    f"""WITH {Q_LINES}, vocab AS (
      SELECT DISTINCT {q_norm('w')} AS token FROM (SELECT unnest({q_tokens('text')}) AS w FROM benchmark)
      UNION SELECT {q_norm('text')} FROM benchmark),
    asked AS (SELECT doc_id, line_no, unnest({q_tokens('line')}) AS token FROM lines),
    shared AS (SELECT a.doc_id, a.line_no, count(*) AS n_tokens, count(v.token) AS n_shared
      FROM asked a LEFT JOIN vocab v ON a.token = v.token GROUP BY ALL)
    SELECT s.doc_id, s.line_no, n_tokens, n_shared FROM shared s JOIN lines l ON l.doc_id = s.doc_id AND l.line_no = s.line_no
    WHERE n_shared * 1.0 / n_tokens < 0.6 AND {q_norm('l.line')} NOT IN (SELECT token FROM vocab)""",
)
def local_lines_unmatched(spark, d):
    """Document lines that the benchmark's words and texts do not cover."""
    b = table(spark, d, "benchmark")
    vocab = b.select(F.explode(F.array_append(T.token_list(c("text")), T.norm_token(c("text")))).alias("token"))
    return V.unmatched_lines(document_lines(spark, d), ["doc_id", "line_no"], "line", vocab)


@query(
    "y_band_islands",
    """WITH e AS (SELECT user_id, event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS y FROM events),
    b AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY user_id ORDER BY y, event_id) <= 86400 THEN 0 ELSE 1 END AS brk FROM e),
    r AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY y, event_id) AS island FROM b)
    SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(y) AS first_y, max(y) AS last_y FROM r GROUP BY ALL""",
)
def y_band_islands(spark, d):
    """Runs of events at most a day apart, per user, in blocks of a month."""
    e = table(spark, d, "events").select("user_id", "event_id", F.unix_seconds(c("ts").cast("timestamp")).alias("y"))
    runs = islands(e, ["user_id"], "y", gap=86400, ties=["event_id"], block_size=30 * 86400)
    return runs.groupBy("user_id", "island").agg(
        F.count(F.lit(1)).alias("n"), F.min("y").alias("first_y"), F.max("y").alias("last_y")
    )


@query(
    "range_neighbours",
    """WITH e AS (SELECT event_type, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS y, count(*) AS n_rows FROM events GROUP BY ALL)
    SELECT event_type, y, n_rows, CAST(sum(n_rows) OVER (PARTITION BY event_type ORDER BY y
      RANGE BETWEEN 3599 PRECEDING AND 3599 FOLLOWING) AS BIGINT) AS near FROM e""",
)
def range_neighbours(spark, d):
    """Events of the same type less than an hour away, per second of the clock."""
    e = table(spark, d, "events").select("event_type", F.unix_seconds(c("ts").cast("timestamp")).alias("y"))
    return neighbour_counts(e, ["event_type"], "y", reach=3600, out="near", block_size=86400)
