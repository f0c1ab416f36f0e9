"""Queries over pages: stitching, chunks, JSON, providers, the whole pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.functions import jsonx as J
from foliograph.functions.text import first_nonempty, word_count, word_windows
from foliograph.operators import chunks as H
from foliograph.operators import flatten as N
from foliograph.operators.blocks import page_blocks
from foliograph.operators.ordered import row_numbers
from foliograph.operators.stitch import stitch_pages
from foliograph.operators.titles import aliased_title, sticky_titles
from foliograph.plans.pipeline import document_chunks
from foliograph.plans.registry import Q_LINES, q_clean, q_count, q_strip, q_words, query, table, wide_table
from foliograph.schema import CHART, CHUNK, TABLE
from foliograph.session import settle
from foliograph.sources.provider import read_replies, replay
from foliograph.sources.sinks import chunk_json

c = F.col


def turn_pages(spark, d):
    """Conversations as documents, turns as pages; texts end without a period."""
    return as_pages(wide_table(spark, d, "conversations", "conv_id", "turn", "role", "text"))


def as_pages(turns, *more):
    return turns.select(
        *more,
        F.concat(F.lit("conv_"), c("conv_id").cast("string")).alias("source"),
        (c("turn") + 1).cast("int").alias("page"),
        "role",
        F.rtrim("text", F.lit(".")).alias("text"),
    )


@query(
    "sticky_fill_forward",
    """SELECT 'conv_' || conv_id AS source, CAST(turn + 1 AS INTEGER) AS page,
      last_value(CASE WHEN role <> 'assistant' THEN role || ' ' || turn END IGNORE NULLS) OVER w AS page_title,
      last_value(CASE WHEN turn % 3 = 0 THEN trim(rtrim(text, '.')) END IGNORE NULLS) OVER w AS page_subtitle
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
)
def sticky_fill_forward(spark, d):
    pages = turn_pages(spark, d).select(
        "source", "page",
        F.when(c("role") != "assistant", F.concat_ws(" ", "role", (c("page") - 1).cast("string"))).otherwise("  ").alias("title"),
        F.when((c("page") - 1) % 3 == 0, c("text")).alias("subtitle"),
    )
    return sticky_titles(pages).select("source", "page", "page_title", "page_subtitle")


@query(
    "aliased_titles",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'page ' || o_orderkey WHEN 'O' THEN o_orderpriority ELSE NULL END AS title FROM orders""",
)
def aliased_titles(spark, d):
    from foliograph.constants import PAGE_TITLE_KEYS

    fields = F.create_map(
        F.lit("name"), F.when(c("o_orderstatus") == "P", " ").otherwise(c("o_orderpriority")),
        F.lit("page_title"), F.when(c("o_orderstatus") == "F", F.concat(F.lit(" page "), c("o_orderkey").cast("string"))),
    )
    return table(spark, d, "orders").select("o_orderkey", aliased_title(fields, PAGE_TITLE_KEYS).alias("title"))


@query(
    "coalesced_lookup",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE c_name END AS label FROM customer",
)
def coalesced_lookup(spark, d):
    first = F.when(c("c_acctbal") < 0, "   ").otherwise(F.concat(F.lit(" "), c("c_name")))
    return table(spark, d, "customer").select("c_custkey", first_nonempty(first, c("c_mktsegment")).alias("label"))


Q_TURNS = f"""t AS (SELECT 'conv_' || conv_id AS source, CAST(turn + 1 AS INTEGER) AS page, rtrim(text, '.') AS body FROM conversations),
w AS (SELECT source, page, {q_words('body')} AS ws FROM t),
g AS (SELECT source, page, ws, unnest(generate_series(0, greatest(len(ws) - 1, 0) // 180)) AS k FROM w),
ch AS (SELECT source, page, k + 1 AS seq, source || ' > turn' || chr(10) || chr(10) || array_to_string(ws[k * 180 + 1 : k * 180 + 180], ' ') AS text,
  array_to_string(ws[k * 180 + 1 : k * 180 + 180], ' ') AS bare FROM g)"""


@query(
    "page_stitch",
    f"""WITH RECURSIVE {Q_TURNS}, ends AS (
      SELECT source, page, arg_min(text, seq) AS first_text, arg_min(bare, seq) AS head, arg_max(text, seq) AS tail, count(*) AS n FROM ch GROUP BY source, page),
    walk AS (
      SELECT source, page, first_text AS head_text, false AS stitched,
        CASE WHEN n = 1 THEN first_text ELSE tail END AS last_text FROM ends WHERE page = 1
      UNION ALL
      SELECT source, page, new_head, pend, CASE WHEN n = 1 THEN new_head ELSE tail END FROM (
        SELECT e.source, e.page, e.n, e.tail, pend,
          CASE WHEN NOT pend THEN e.first_text
            WHEN e.head = '' OR regexp_matches(e.head, '^[,.;:!?)\\]}}]') OR regexp_matches(rtrim(k.last_text), '[.!?…]$')
            THEN rtrim(k.last_text) || e.head ELSE rtrim(k.last_text) || ' ' || e.head END AS new_head
        FROM (SELECT *, NOT regexp_matches({q_strip('last_text')}, '[.!?]["'']?$') AND {q_count('last_text')} >= 120 AS pend FROM walk) k
        JOIN ends e ON e.source = k.source AND e.page = k.page + 1))
    SELECT source, page, head_text AS text, stitched FROM walk""",
)
def page_stitch(spark, d):
    pages = settle(window_chunks(turn_pages(spark, d)))
    return stitch_pages(pages).select("source", "page", F.get("chunks", F.lit(0))["text"].alias("text"), "stitched")


def window_chunks(pages, *more):
    """(source, page, chunks): chunks of 180 words under a heading."""
    prefix = F.concat(c("source"), F.lit(" > turn\n\n"))
    units = F.when(word_count(c("text")) == 0, F.array(F.lit(""))).otherwise(word_windows(c("text"), 180))
    return pages.select(
        *more, "source", "page", H.number_chunks(
            F.transform(units, lambda u: F.struct(F.lit("text").alias("type"), F.concat(prefix, u).alias("text"))),
            c("source"), c("page"),
        ).cast(f"array<{CHUNK}>").alias("chunks"),
    )


def _typed_turns(spark, d):
    """Turns as typed pages: a heading by role, the text as content."""
    title = F.when(c("role") == "system", F.lit("Setup"))
    return turn_pages(spark, d).select(
        "source", "page", title.alias("title"), F.lit(None).cast("string").alias("subtitle"),
        F.array().cast(f"array<{TABLE}>").alias("tables"), F.array().cast(f"array<{CHART}>").alias("charts"),
        F.array(F.struct(F.lit(None).cast("string").alias("heading"), c("text").alias("content"))).alias("sections"),
    )


@query(
    "document_pipeline",
    f"""WITH RECURSIVE base AS (SELECT conv_id * 100 + turn AS id, conv_id, CAST(turn + 1 AS INTEGER) AS page, role, rtrim(text, '.') AS body FROM conversations),
    {q_clean('base', 'id', 'body', 'cl')},
    titled AS (SELECT b.*, CASE WHEN cl.c <> '' THEN cl.c ELSE {q_strip('b.body')} END AS t,
        'conv_' || conv_id || CASE WHEN max(CASE WHEN role = 'system' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY page) = 1 THEN ' > Setup' ELSE '' END || chr(10) || chr(10) AS prefix
      FROM base b JOIN cl ON b.id = cl.id),
    w AS (SELECT conv_id, page, prefix, {q_words(r"regexp_replace(t, '^(?:[•\-–]|\d{1,2}[.)]|[A-Za-z][.)]|[o○◦])[ \t]+', '')")} AS ws FROM titled WHERE t <> ''),
    g AS (SELECT *, unnest(generate_series(0, (len(ws) - 1) // 180)) AS k FROM w),
    pc AS (SELECT conv_id, page, k, prefix || array_to_string(ws[k * 180 + 1 : k * 180 + 180], ' ') AS text,
        array_to_string(ws[k * 180 + 1 : k * 180 + 180], ' ') AS bare FROM g),
    st AS (SELECT *, sum(CASE WHEN k = 0 OR {q_count('text')} >= 8 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, page ORDER BY k) AS seq FROM pc),
    ch AS (SELECT conv_id, page, seq, string_agg(text, ' ' ORDER BY k) AS text,
        string_agg(CASE WHEN k = 0 THEN bare ELSE text END, ' ' ORDER BY k) AS bare FROM st GROUP BY conv_id, page, seq),
    full_ch AS (SELECT conv_id, page, seq, text, bare FROM ch UNION ALL
        SELECT conv_id, page, 0, '', NULL FROM base b WHERE NOT EXISTS (SELECT 1 FROM ch WHERE ch.conv_id = b.conv_id AND ch.page = b.page)),
    ends AS (SELECT conv_id, page, arg_min(text, seq) AS first_text, arg_min(CASE WHEN contains(text, ' > ') THEN coalesce(bare, '') ELSE text END, seq) AS head, arg_max(text, seq) AS tail, count(*) AS n, min(seq) AS s0 FROM full_ch GROUP BY ALL),
    walk AS (
      SELECT conv_id, page, first_text AS head_text, CASE WHEN n = 1 THEN first_text ELSE tail END AS last_text FROM ends WHERE page = 1
      UNION ALL
      SELECT conv_id, page, new_head, CASE WHEN n = 1 THEN new_head ELSE tail END FROM (
        SELECT e.*, CASE WHEN NOT pend OR s0 = 0 THEN e.first_text
            WHEN e.head = '' OR regexp_matches(e.head, '^[,.;:!?)\\]}}]') THEN rtrim(k.last_text) || e.head ELSE rtrim(k.last_text) || ' ' || e.head END AS new_head
        FROM (SELECT *, NOT regexp_matches({q_strip('last_text')}, '[.!?]["'']?$') AND {q_count('last_text')} >= 120 AS pend FROM walk) k
        JOIN ends e ON e.conv_id = k.conv_id AND e.page = k.page + 1))
    SELECT 'conv_' || f.conv_id AS source, f.page, CAST(f.seq AS BIGINT) AS seq, CASE WHEN f.seq = 0 THEN 'empty' ELSE 'text' END AS type,
      CASE WHEN f.seq = e.s0 THEN k.head_text ELSE f.text END AS text
    FROM full_ch f JOIN ends e ON e.conv_id = f.conv_id AND e.page = f.page LEFT JOIN walk k ON k.conv_id = f.conv_id AND k.page = f.page""",
)
def document_pipeline(spark, d):
    """Titles carried, text cleaned and split, chunks numbered and stitched."""
    return document_chunks(_typed_turns(spark, d)).select("source", "page", c("seq").cast("bigint").alias("seq"), "type", "text")


@query("document_pipeline_compat")
def document_pipeline_compat(spark, d):
    """The same with page number blocks and doubled contents."""
    return document_chunks(_typed_turns(spark, d), compat=True).select("source", "page", c("seq").cast("bigint").alias("seq"), "type", "text")


@query(
    "capped_consolidate",
    f"""WITH {Q_LINES}, ranked AS (SELECT *, max(line_no) OVER (PARTITION BY doc_id) AS n,
        CASE WHEN {q_count('line')} <= 6 THEN 'table' ELSE 'text' END AS type FROM lines),
    pick AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY type = 'text', line_no) AS r FROM ranked),
    flag AS (SELECT *, n <= 3 OR r <= 2 AS kept FROM pick),
    host AS (SELECT doc_id, max(CASE WHEN kept AND type = 'text' THEN line_no END) AS h FROM flag GROUP BY doc_id),
    over_ AS (SELECT doc_id, count(*) AS k, chr(10) || chr(10) || string_agg('## ' || upper(type[1]) || type[2:] || ': ' || line || chr(10) || chr(10) || line, chr(10) || chr(10) ORDER BY line_no) AS body
      FROM flag WHERE NOT kept GROUP BY doc_id)
    SELECT f.doc_id, line_no, type, line || CASE WHEN line_no = h AND k IS NOT NULL THEN body ELSE '' END AS text, CASE WHEN line_no = h THEN k END AS overflow_count
    FROM flag f JOIN host USING (doc_id) LEFT JOIN over_ USING (doc_id) WHERE kept
    UNION ALL
    SELECT doc_id, (SELECT max(line_no) + 1 FROM lines l WHERE l.doc_id = o.doc_id), 'text', ltrim(body, chr(10)), k
    FROM over_ o JOIN host USING (doc_id) WHERE h IS NULL""",
)
def capped_consolidate(spark, d):
    """Lines as chunks, short ones as tables; three per document at most."""
    from foliograph.functions.text import nonblank_lines

    docs = wide_table(spark, d, "documents", "doc_id", "text").withColumn("l", nonblank_lines(c("text")))
    pieces = F.transform("l", lambda x: F.struct(F.when(word_count(x) <= 6, "table").otherwise("text").alias("type"), x.alias("text")))
    doc = c("doc_id").cast("string")
    numbered = docs.select("doc_id", H.number_chunks(pieces, doc, c("doc_id").cast("int")).alias("n"))
    capped = numbered.select("doc_id", F.inline(H.cap_chunks(c("n"), 3, doc, c("doc_id").cast("int"))))
    return capped.select(
        "doc_id", c("seq").cast("bigint").alias("line_no"), "type", "text", c("overflow_count").cast("bigint").alias("overflow_count")
    )


@query(
    "caption_attach",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'Data of the year ' || c_mktsegment ELSE c_mktsegment END || chr(10) || chr(10) ||
      '| Name |' || chr(10) || '| --- |' || chr(10) || '| ' || c_name || ' |' AS table_text FROM customer""",
)
def caption_attach(spark, d):
    """A short heading before a table becomes part of the table's title."""
    null = F.lit(None)
    block = page_blocks(
        F.array(F.struct(c("c_mktsegment").alias("title"), F.array(F.lit("Name")).alias("headers"), F.array(F.array("c_name")).alias("rows"), null.cast("int").alias("page_number"))),
        F.array().cast(f"array<{CHART}>"),
        F.array().cast("array<struct<heading:string,content:string>>"),
        F.lit(1),
    )
    lead = page_blocks(
        F.array().cast(f"array<{TABLE}>"), F.array().cast(f"array<{CHART}>"),
        F.array(F.struct(F.when(c("c_acctbal") > 0, "Data").alias("heading"), F.when(c("c_acctbal") > 0, "of the year").alias("content"))), F.lit(1),
    )
    rows = table(spark, d, "customer").select("c_custkey", F.concat(lead, block).alias("blocks"))
    done = rows.withColumn("items", H.attach_captions(c("blocks"))).withColumn(
        "p", H.render_pieces(c("blocks"), c("items"), F.lit(""), F.lit(" "), null.cast("string"), null.cast("string"), null.cast("string"))
    )
    text = F.try_element_at("p", F.lit(-1))["text"]
    return done.select("c_custkey", F.regexp_replace(text, r"\A[^\n]*\n\n(?=.*\n\n)", "").alias("table_text"))


@query(
    "short_append",
    f"""WITH {Q_LINES}, s AS (SELECT *, sum(CASE WHEN line_no = 1 OR {q_count('line')} >= 8 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM lines)
    SELECT doc_id, CAST(g AS BIGINT) AS seq, string_agg(line, ' ' ORDER BY line_no) AS text FROM s GROUP BY doc_id, g""",
)
def short_append(spark, d):
    from foliograph.functions.text import nonblank_lines

    docs = wide_table(spark, d, "documents", "doc_id", "text").withColumn("l", nonblank_lines(c("text")))
    pieces = F.transform("l", lambda x: F.struct(F.lit("text").alias("type"), x.alias("text")))
    rows = docs.select("doc_id", F.posexplode(H.append_short_pieces(pieces)).alias("p", "x"))
    return rows.select("doc_id", (c("p") + 1).cast("bigint").alias("seq"), c("x.text").alias("text"))


@query(
    "sequence_numbers",
    """SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber, l_extendedprice,
      row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS seq FROM lineitem""",
)
def sequence_numbers(spark, d):
    items = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return row_numbers(items, ["l_suppkey"], "l_orderkey", "seq", ["l_linenumber", "l_partkey", "l_extendedprice"], block_size=2048)


@query(
    "json_candidates",
    """SELECT event_id, 1 AS position, props AS candidate FROM events UNION ALL
    SELECT event_id, 2, '[' || event_id || ', "a ] b"]' FROM events""",
)
def json_candidates(spark, d):
    text = F.concat(F.lit("Sure: "), c("props"), F.lit(" then ["), c("event_id").cast("string"), F.lit(', "a ] b"] done.'))
    rows = wide_table(spark, d, "events", "event_id", "props").select("event_id", F.posexplode(J.json_candidates(text)).alias("p", "candidate"))
    return rows.select("event_id", (c("p") + 1).alias("position"), "candidate")


@query(
    "json_repair",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type IN ('click', 'error', 'view', 'purchase') AS mended FROM events""",
)
def json_repair(spark, d):
    """Trailing commas, curly quotes and Python literals, each read as JSON."""
    k = F.get_json_object("props", "$.k")
    broken = (
        F.when(c("event_type") == "click", F.concat(F.lit('{"k": '), k, F.lit(", }")))
        .when(c("event_type") == "error", F.concat(F.lit("{“k”: "), k, F.lit("}")))
        .when(c("event_type") == "view", F.concat(F.lit("{'k': "), k, F.lit(", 'seen': True}")))
        .otherwise(c("props"))
    )
    e = wide_table(spark, d, "events", "event_id", "event_type", "props").withColumn("t", broken)
    mended = e.withColumn("m", J.mend_literal(c("t"), J.mend_json(c("t"))))
    return mended.select(
        "event_id", F.get_json_object("m", "$.k").cast("bigint").alias("k"),
        (c("m").isNotNull() & c("event_type").isin("click", "error", "view", "purchase")).alias("mended"),
    )


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k")
    )


@query(
    "json_unwrap",
    """SELECT event_id, CASE event_type WHEN 'click' THEN props WHEN 'view' THEN '{"value": ' || event_id || '}' ELSE props END AS body FROM events""",
)
def json_unwrap(spark, d):
    raw = (
        F.when(c("event_type") == "click", F.concat(F.lit("["), c("props"), F.lit("]")))
        .when(c("event_type") == "view", c("event_id").cast("string"))
        .otherwise(c("props"))
    )
    return table(spark, d, "events").select("event_id", J.unwrap_single(raw).alias("body"))


@query(
    "reply_merge",
    """SELECT o_orderkey, 'T' || o_custkey AS title, 'one' || chr(10) || chr(10) || 'two' AS narrative_text,
      CAST(CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 2 END AS BIGINT) AS n_tables, CAST(1 AS BIGINT) AS n_charts FROM orders""",
)
def reply_merge(spark, d):
    first = F.concat(F.lit('{"title": null, "narrative_text": " one ", "tables": [{"title": "a"}'), F.when(c("o_orderstatus") == "F", ', {"title": "b"}').otherwise(""), F.lit("]}"))
    second = F.concat(F.lit('{"title": "T'), c("o_custkey").cast("string"), F.lit('", "narrative_text": "two", "tables": [{"title": "c"}], "charts": [{"title": "d"}]}'))
    merged = table(spark, d, "orders").select("o_orderkey", J.merge_page_objects(F.array(first, second)).alias("m"))
    return merged.select(
        "o_orderkey", "m.title", "m.narrative_text",
        F.size("m.tables").cast("bigint").alias("n_tables"), F.size("m.charts").cast("bigint").alias("n_charts"),
    )


@query(
    "richest_reply",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '{"tables": [1, 2], "charts": []}' ELSE '{"tables": [3], "charts": []}' END AS body FROM orders""",
)
def richest_reply(spark, d):
    two = F.when(c("o_orderstatus") == "F", '{"tables": [1, 2], "charts": []}').otherwise('{"tables": [], "charts": []}')
    objs = F.array(F.lit('{"note": "x"}'), two, F.lit('{"tables": [3], "charts": []}'), F.lit('{"tables": [], "charts": [4]}'))
    return table(spark, d, "orders").select("o_orderkey", J.richest_object(objs).alias("body"))


@query(
    "reply_status",
    """SELECT 'cust_' || o_custkey AS source, CAST(o_orderkey AS INTEGER) AS page,
      CASE WHEN o_orderpriority LIKE '1%' THEN 'no_image_bytes' WHEN o_orderpriority LIKE '2%' THEN 'json_parse_failed'
        WHEN o_orderpriority LIKE '3%' THEN 'no_tables_or_charts' ELSE 'ok' END AS status FROM orders""",
)
def reply_status(spark, d):
    """Stored replies joined to their pages, then read; every page gets a status."""
    p = F.substring("o_orderpriority", 1, 1)
    pages = wide_table(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority").select(
        F.concat(F.lit("cust_"), c("o_custkey").cast("string")).alias("source"), c("o_orderkey").cast("int").alias("page"), p.alias("p")
    )
    reply = (
        F.when(c("p") == "2", "I could not read this page.")
        .when(c("p") == "3", '```json\n{"tables": [], "charts": []}\n```')
        .otherwise('Here: {"tables": [{"type": "table", "headers": ["a"], "rows": [["1"]],}], "charts": []}')
    )
    replies = pages.where("p <> '1'").select("source", "page", reply.alias("reply"), F.lit(900).cast("bigint").alias("input_tokens"), F.lit(20).cast("bigint").alias("output_tokens"))
    return read_replies(replay(pages, replies)).select("source", "page", "status")


@query(
    "letter_like",
    """SELECT c_custkey, c_mktsegment IN ('BUILDING', 'MACHINERY') AS letter FROM customer""",
)
def letter_like(spark, d):
    body = (
        F.when(c("c_mktsegment") == "BUILDING", F.to_json(F.struct(F.struct("c_name").alias("header"), F.lit("x").alias("footer"))))
        .when(c("c_mktsegment") == "MACHINERY", F.to_json(F.struct(F.array(F.struct(c("c_name").alias("paragraph"))).alias("content"))))
        .otherwise(F.to_json(F.struct(c("c_name").alias("content"))))
    )
    return table(spark, d, "customer").select("c_custkey", N.looks_like_letter(body).alias("letter"))


@query(
    "flatten_blocks",
    """WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus AS s, o_orderpriority AS p FROM orders)
    SELECT o_orderkey, CAST(1 AS BIGINT) AS block, 'table' AS type, 'Sender' AS title, 'Field | Value' AS headers, 'name | ' || o_custkey AS cells FROM o
    UNION ALL SELECT o_orderkey, 2, 'narrative', 'Body', NULL, NULL FROM o
    UNION ALL SELECT o_orderkey, 3, 'narrative', NULL, NULL, NULL FROM o
    UNION ALL SELECT o_orderkey, 4, 'narrative', NULL, NULL, NULL FROM o
    UNION ALL SELECT o_orderkey, 5, 'narrative', NULL, NULL, NULL FROM o
    UNION ALL SELECT o_orderkey, 6, 'table', 'Lines', 'Order Key | Status', o_orderkey || ' | ' || s FROM o
    UNION ALL SELECT o_orderkey, 7, 'chart', 'Share', NULL, NULL FROM o
    UNION ALL SELECT o_orderkey, 8, 'narrative', p, NULL, NULL FROM o""",
)
def flatten_blocks(spark, d):
    """A nested letter per order: key/value table, body, segments, chart, notes."""
    doc = F.to_json(
        F.struct(
            F.struct(c("o_custkey").alias("name")).alias("sender"),
            F.array(F.struct(F.concat(F.lit("Dear "), c("o_orderkey").cast("string")).alias("text"))).alias("content"),
            F.struct(
                F.lit("table").alias("type"),
                F.array(F.struct(F.lit("Lines").alias("section"), F.array(F.struct(c("o_orderkey").alias("order_key"), c("o_orderstatus").alias("status"))).alias("items"))).alias("data"),
            ).alias("part_a"),
            F.struct(F.lit("chart").alias("type"), F.lit("Share").alias("title"), F.array(F.struct(F.lit("n").alias("name"), c("o_totalprice").alias("value"))).alias("series")).alias("part_b"),
            F.struct(c("o_orderpriority").alias("title"), F.lit("see above").alias("note")).alias("part_c"),
            F.lit("x").alias("debug"),
        )
    )
    flat = wide_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice").select(
        "o_orderkey", F.posexplode(N.flatten_json(doc, F.lit(1))).alias("p", "b")
    )
    return flat.select(
        "o_orderkey", (c("p") + 1).cast("bigint").alias("block"), c("b.type").alias("type"), c("b.title").alias("title"),
        F.array_join("b.headers", " | ").alias("headers"), F.array_join(F.get("b.rows", F.lit(0)), " | ").alias("cells"),
    )


@query(
    "chunk_json",
    """SELECT 'conv_' || conv_id AS source, CAST(turn + 1 AS INTEGER) AS page,
      '{"id":"t' || turn || '","type":"text","text":' || to_json(rtrim(text, '.')) || ',"meta":{"source":"conv_' || conv_id || '","page":' || (turn + 1) ||
      CASE WHEN turn = 0 THEN ',"overflow_consolidated":true,"overflow_count":2' ELSE '' END || '}}' AS json FROM conversations""",
)
def chunk_json_lines(spark, d):
    null = F.lit(None).cast("string")
    rows = turn_pages(spark, d).select(
        "source", "page", F.concat(F.lit("t"), (c("page") - 1).cast("string")).alias("id"), F.lit("text").alias("type"), "text",
        null.alias("published_date"), null.alias("published_date_source"), null.alias("published_month"),
        (c("page") == 1).alias("overflow_consolidated"), F.when(c("page") == 1, 2).alias("overflow_count"),
    )
    return rows.select("source", "page", chunk_json().alias("json"))


@query(
    "dated_chunks",
    """WITH o AS (SELECT *, o_orderdate + INTERVAL 20 YEAR AS d FROM orders)
    SELECT 'orders/Report ' || o_orderkey || strftime(d, ' %Y-%m-%d') AS source, CAST(1 AS INTEGER) AS page, CAST(1 AS BIGINT) AS seq,
      'Report ' || o_orderkey || strftime(d, ' %Y-%m-%d') AS named,
      CAST(day(d) AS VARCHAR) || CASE WHEN day(d) IN (1, 21, 31) THEN 'st' WHEN day(d) IN (2, 22) THEN 'nd'
        WHEN day(d) IN (3, 23) THEN 'rd' ELSE 'th' END || strftime(d, ' %B %Y') AS published_date FROM o""",
)
def dated_chunks(spark, d):
    """A one-page document per order, dated by the name of its folder."""
    from foliograph.plans.pipeline import document_dates, first_page_facts
    from foliograph.sources.pages import typed_pages

    orders = wide_table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_orderstatus").withColumn("d", F.expr("o_orderdate + interval 20 years"))
    source = F.concat(F.lit("orders/Report "), c("o_orderkey").cast("string"), F.date_format("d", " yyyy-MM-dd"))
    words = F.concat_ws(" ", F.array_repeat(F.concat(F.lit("status of this order is "), c("o_orderstatus")), 3))
    json = F.to_json(F.struct(F.array(F.struct(F.lit(None).cast("string").alias("heading"), words.alias("content"))).alias("sections")))
    pages = orders.select(source.alias("source"), F.lit(1).alias("page"), json.alias("json"), F.concat(F.lit("/data/"), source, F.lit("/page_0001.json")).alias("path"))
    typed = typed_pages(pages)
    dated = document_chunks(typed, dates=document_dates(first_page_facts(typed)))
    named = F.regexp_extract("text", r"^(Report \d+ \d{4}-\d{2}-\d{2})", 1)
    return dated.select("source", "page", c("seq").cast("bigint").alias("seq"), named.alias("named"), "published_date")
