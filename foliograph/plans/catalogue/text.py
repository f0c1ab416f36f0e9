"""Queries over document text."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.functions import text as T
from foliograph.functions.dates import is_date_only
from foliograph.plans.registry import (
    Q_LINES,
    WS,
    document_lines,
    q_clean,
    q_count,
    q_strip,
    q_tokens,
    q_trivial,
    q_words,
    query,
    table,
    wide_table,
)

c = F.col


@query("text_clean_flow", f"WITH {q_clean('documents', 'doc_id', 'text')} SELECT doc_id, c AS cleaned FROM cleaned")
def text_clean_flow(spark, d):
    return wide_table(spark, d, "documents", "doc_id", "text").select("doc_id", T.clean_text(c("text")).alias("cleaned"))


@query("word_counts", f"SELECT doc_id, {q_count('text')} AS n_words FROM documents")
def word_counts(spark, d):
    docs = wide_table(spark, d, "documents", "doc_id", "text")
    return docs.select("doc_id", T.word_count(c("text")).cast("bigint").alias("n_words"))


@query(
    "approx_tokens",
    "SELECT doc_id, CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END AS n_tokens FROM documents",
)
def approx_tokens(spark, d):
    return table(spark, d, "documents").select("doc_id", T.approx_tokens(c("text")).cast("bigint").alias("n_tokens"))


@query(
    "norm_tokens_distinct",
    f"SELECT doc_id, len({q_tokens('text')}) AS n_distinct, "
    f"array_to_string(list_sort({q_tokens('text')}), ' ') AS tokens FROM documents",
)
def norm_tokens_distinct(spark, d):
    docs = wide_table(spark, d, "documents", "doc_id", "text").withColumn("t", T.token_list(c("text")))
    return docs.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_distinct"),
        F.array_join(F.array_sort("t"), " ").alias("tokens"),
    )


@query(
    "trivial_headings",
    f"WITH {Q_LINES} SELECT doc_id, line_no, line FROM lines WHERE {q_trivial('line')}",
)
def trivial_headings(spark, d):
    return document_lines(spark, d).where(T.is_trivial_heading(c("line")))


@query(
    "newline_normalise",
    "SELECT page_id, md5(replace(replace(html, chr(13) || chr(10), chr(10)), chr(13), chr(10))) AS digest FROM pages",
)
def newline_normalise(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(T.normalise_newlines(c("html")).cast("binary")).alias("digest"))


@query(
    "compact_keys",
    "SELECT p_partkey, lower(regexp_replace(p_name || ' ' || p_brand, '[^0-9a-zA-Z]', '', 'g')) AS key FROM part",
)
def compact_keys(spark, d):
    name = F.concat_ws(" ", "p_name", "p_brand")
    return table(spark, d, "part").select("p_partkey", T.compact_key(name).alias("key"))


@query(
    "title_case_keys",
    """SELECT p_partkey, array_to_string(list_transform(string_split(replace(p_name, ' ', '_'), '_'),
         lambda w: upper(w[1]) || lower(w[2:])), ' ') AS label FROM part""",
)
def title_case_keys(spark, d):
    key = F.regexp_replace("p_name", " ", "_")
    return table(spark, d, "part").select("p_partkey", T.key_label(key).alias("label"))


@query(
    "dedup_adjacent_lines",
    f"""WITH {q_clean('documents', 'doc_id', 'text')}
    SELECT doc_id, count(*) FILTER (WHERE ln <> '') AS n_before,
           count(*) FILTER (WHERE ln <> '' AND NOT (k % 2 = 0 AND pos < n)) AS n_after
    FROM cleaned_k GROUP BY doc_id""",
)
def dedup_adjacent_lines(spark, d):
    def full(x):
        return F.size(F.filter(F.split(x, "\n"), lambda s: s != "")).cast("bigint")

    docs = wide_table(spark, d, "documents", "doc_id", "text")
    return docs.select(
        "doc_id", full(c("text")).alias("n_before"), full(T.collapse_repeated_lines(c("text"))).alias("n_after")
    )


@query(
    "unit_dedup",
    rf"""WITH {Q_LINES}, keyed AS (
      SELECT *, trim(regexp_replace(regexp_replace(lower(line), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g')) AS key FROM lines)
    SELECT doc_id, line_no, line FROM keyed WHERE key <> ''
    QUALIFY row_number() OVER (PARTITION BY doc_id, key ORDER BY line_no) = 1""",
)
def unit_dedup(spark, d):
    # min_by combines before the shuffle, so copies of one line cost one row per task.
    keyed = document_lines(spark, d).withColumn("key", T.unit_key(c("line"))).where("key <> ''")
    first = keyed.groupBy("doc_id", "key").agg(F.min(F.struct("line_no", "line")).alias("u"))
    return first.select("doc_id", "u.line_no", "u.line")


@query(
    "dedup_keys",
    r"""SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || '  (' || p_brand || ') 5.5% $'),
         '\s+', ' ', 'g'), '[^\p{L}\p{N}_\s₹$€%.\-]', '', 'g')) AS key FROM part""",
)
def dedup_keys(spark, d):
    text = F.concat(c("p_name"), F.lit("  ("), c("p_brand"), F.lit(") 5.5% $"))
    return table(spark, d, "part").select("p_partkey", T.dedup_key(text).alias("key"))


@query(
    "word_window_chunks",
    f"""WITH w AS (SELECT doc_id, {q_words('text')} AS ws FROM documents),
    g AS (SELECT doc_id, ws, unnest(generate_series(0, (len(ws) - 1) // 180)) AS i FROM w WHERE len(ws) > 0)
    SELECT doc_id, i + 1 AS seq, len(ws[i * 180 + 1 : i * 180 + 180]) AS n_words,
           array_to_string(ws[i * 180 + 1 : i * 180 + 180], ' ') AS text FROM g""",
)
def word_window_chunks(spark, d):
    docs = wide_table(spark, d, "documents", "doc_id", "text")
    rows = docs.select("doc_id", F.posexplode(T.word_windows(c("text"), 180)).alias("p", "text"))
    return rows.select(
        "doc_id", (c("p") + 1).cast("bigint").alias("seq"), T.word_count(c("text")).cast("bigint").alias("n_words"), "text"
    )


@query(
    "unit_split",
    rf"""WITH RECURSIVE {Q_LINES}, marked AS (
      SELECT doc_id, line_no,
        CASE WHEN regexp_matches(line, '^(?:[•\-–]|\d{{1,2}}[.)]|[A-Za-z][.)]|[o○◦])[ \t]+\S') THEN 1 ELSE 0 END AS has_mark,
        CASE WHEN regexp_matches(line, '^(?:[•\-–]|\d{{1,2}}[.)]|[A-Za-z][.)])[ \t]+\S') THEN 1 ELSE 0 END AS top, line FROM lines),
    bodies AS (SELECT doc_id, line_no, top,
        CASE WHEN has_mark = 1 THEN regexp_replace(line, '^\S+[ \t]+', '') ELSE line END AS body FROM marked),
    numbered AS (SELECT *, sum(top) OVER (PARTITION BY doc_id ORDER BY line_no) AS u FROM bodies),
    units AS (SELECT doc_id, u, string_agg(body, ' ' ORDER BY line_no) AS unit FROM numbered GROUP BY doc_id, u),
    ranked AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY u) AS i, unit FROM units),
    glue AS (
      SELECT doc_id, i, unit AS buf, 1 AS g FROM ranked WHERE i = 1
      UNION ALL
      SELECT r.doc_id, r.i, CASE WHEN {q_count('b.buf')} < 28 THEN b.buf || ' ' || r.unit ELSE r.unit END,
             CASE WHEN {q_count('b.buf')} < 28 THEN b.g ELSE b.g + 1 END
      FROM glue b JOIN ranked r ON r.doc_id = b.doc_id AND r.i = b.i + 1),
    glued AS (SELECT doc_id, g, max_by(buf, i) AS unit FROM glue GROUP BY doc_id, g),
    keyed AS (SELECT *, trim(regexp_replace(regexp_replace(lower(unit), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g')) AS key FROM glued),
    firsts AS (SELECT doc_id, g, unit FROM keyed WHERE key <> ''
      QUALIFY row_number() OVER (PARTITION BY doc_id, key ORDER BY g) = 1),
    cut AS (SELECT doc_id, g, unit, {q_words('unit')} AS ws FROM firsts),
    windows AS (SELECT doc_id, g, unit, ws, unnest(generate_series(0, (len(ws) - 1) // 180)) AS k FROM cut)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g, k) AS seq,
      CASE WHEN len(ws) <= 180 THEN unit ELSE array_to_string(ws[k * 180 + 1 : k * 180 + 180], ' ') END AS unit
    FROM windows""",
)
def unit_split(spark, d):
    docs = wide_table(spark, d, "documents", "doc_id", "text")
    # Lines are stripped first, so no line counts as indented.
    stripped = F.array_join(T.nonblank_lines(c("text")), "\n")
    rows = docs.select("doc_id", F.posexplode(T.split_points(F.concat(stripped, F.lit("\n")))).alias("p", "unit"))
    return rows.select("doc_id", (c("p") + 1).cast("bigint").alias("seq"), "unit")


@query(
    "char_split",
    f"""WITH RECURSIVE cut AS (
      SELECT doc_id, text AS rest, 0 AS seq, CAST(NULL AS VARCHAR) AS piece, length(text) > 6000 AS is_long FROM documents
      UNION ALL
      SELECT doc_id, substr(rest, cut_at + 1), seq + 1, substr(rest, 1, cut_at), is_long FROM (
        SELECT *, CASE WHEN NOT is_long OR length(rest) <= 6000 THEN length(rest)
          WHEN strpos(reverse(substr(rest, 3601, 2400)), ' ') > 0
          THEN 3600 + 2400 - strpos(reverse(substr(rest, 3601, 2400)), ' ') ELSE 6000 END AS cut_at
        FROM cut WHERE length(rest) > 0))
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS seq,
           CASE WHEN is_long THEN {q_strip('piece')} ELSE piece END AS piece
    FROM cut WHERE seq > 0 AND (NOT is_long OR {q_strip('piece')} <> '')""",
)
def char_split(spark, d):
    docs = wide_table(spark, d, "documents", "doc_id", "text").where(F.length("text") > 0)
    rows = docs.select("doc_id", F.posexplode(T.split_long(c("text"))).alias("p", "piece"))
    return rows.select("doc_id", (c("p") + 1).cast("bigint").alias("seq"), "piece")


@query(
    "overflow_candidates",
    f"""SELECT conv_id, turn, {q_count('text')} AS n_words FROM (
      SELECT conv_id, turn, rtrim(text, '.') AS text FROM conversations)
    WHERE {q_count('text')} >= 120 AND NOT regexp_matches({q_strip('text')}, '[.!?]["'']?$')""",
)
def overflow_candidates(spark, d):
    turns = table(spark, d, "conversations").withColumn("text", F.rtrim("text", F.lit(".")))
    return turns.where(T.looks_like_overflow(c("text"))).select(
        "conv_id", "turn", T.word_count(c("text")).cast("bigint").alias("n_words")
    )


@query(
    "chunk_prefix",
    """SELECT o_orderkey,
      array_to_string(list_filter(['order_' || o_orderkey,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority || CASE WHEN o_orderstatus = 'O' THEN ' ' || 'Open' ELSE '' END END,
        CASE WHEN o_totalprice > 100000 THEN 'published_month: ' || strftime(o_orderdate, '%B %Y')
             ELSE 'published_date: ' || strftime(o_orderdate, '%Y-%m-%d') END,
        CASE WHEN o_totalprice > 200000 THEN 'Large' END], lambda p: p IS NOT NULL), ' > ') || chr(10) || chr(10) AS prefix
    FROM orders""",
)
def chunk_prefix(spark, d):
    o = table(spark, d, "orders")
    large = c("o_totalprice") > 100000
    return o.select(
        "o_orderkey",
        T.chunk_prefix(
            F.concat(F.lit("order_"), c("o_orderkey").cast("string")),
            F.when(c("o_orderstatus") != "P", c("o_orderpriority")).otherwise("  "),
            F.when(c("o_orderstatus") == "O", "Open"),
            F.when(large, F.date_format("o_orderdate", "MMMM yyyy")),
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.when(c("o_totalprice") > 200000, "Large"),
        ).alias("prefix"),
    )


@query(
    "prefix_strip",
    f"""SELECT conv_id, turn, {q_strip('text')} AS body FROM conversations""",
)
def prefix_strip(spark, d):
    t = table(spark, d, "conversations")
    head = F.concat(F.lit("conv "), c("conv_id").cast("string"), F.lit(" > "), c("role"), F.lit("\n\n"))
    full = F.when(c("role") == "user", F.concat(head, c("text"))).otherwise(c("text"))
    return t.select("conv_id", "turn", T.strip_prefix_head(full).alias("body"))


@query(
    "fence_strip",
    """SELECT event_id, props AS body FROM events""",
)
def fence_strip(spark, d):
    fenced = F.concat(F.lit("```json\n"), c("props"), F.lit("\n```\n"))
    return table(spark, d, "events").select("event_id", T.strip_fences(fenced).alias("body"))


@query(
    "space_squeeze",
    f"SELECT conv_id, turn, regexp_replace(text || '  x ' || chr(10) || chr(10) || role, '{WS}{{2,}}', ' ', 'g') AS body FROM conversations",
)
def space_squeeze(spark, d):
    text = F.concat(c("text"), F.lit("  x \n\n"), c("role"))
    return table(spark, d, "conversations").select("conv_id", "turn", T.squeeze(text).alias("body"))


@query(
    "line_kinds",
    rf"""WITH {Q_LINES} SELECT doc_id, line_no,
      regexp_full_match(line, '(?i)(?:bullet_point|bullet|•|◦|▪|‣|–|-|—)') AS lone_marker,
      regexp_full_match(line, '(?i)page\s*\d+') AS page_counter,
      length(line) <= 2 AND regexp_full_match(line, '\p{{L}}+') AS short_letters,
      regexp_matches(line, '[0-9%₹$€:+/#]') AS digits_or_symbols,
      regexp_matches(line, '^[:.\-–—%\d]') AS noise_start,
      upper(line) = line AND lower(line) <> line AS all_caps,
      {q_count('line')} < 10 AS too_small,
      regexp_matches(line, '[.!?]["'']?$') AS sentence_end
    FROM lines""",
)
def line_kinds(spark, d):
    ln = c("line")
    return document_lines(spark, d).select(
        "doc_id",
        "line_no",
        T.is_lone_marker(ln).alias("lone_marker"),
        T.is_page_counter(ln).alias("page_counter"),
        ln.rlike(r"^\p{L}{1,2}$").alias("short_letters"),
        T.has_digits_or_symbols(ln).alias("digits_or_symbols"),
        T.starts_noise(ln).alias("noise_start"),
        T.is_all_caps(ln).alias("all_caps"),
        T.is_too_small(T.word_count(ln), F.lit(False)).alias("too_small"),
        T.ends_sentence(ln).alias("sentence_end"),
    )


@query(
    "term_candidates",
    rf"""WITH {Q_LINES}, facts AS (
      SELECT *, {q_count('line')} AS n, len(regexp_extract_all(line, '\p{{L}}')) AS letters,
             len(regexp_extract_all(line, '\p{{Lu}}')) AS uppers FROM lines)
    SELECT doc_id, line_no, line FROM facts WHERE n <= 8 AND (
      (letters > 0 AND uppers * 1.0 / letters >= 0.6)
      OR (regexp_full_match(line, '[A-Z0-9/&\-\s.()]{{1,30}}') AND upper(line) = line)
      OR (n <= 3 AND length(line) < 40 AND NOT regexp_matches(line, '[.:;]')
          AND (upper(line) = line OR regexp_matches(line, '^\p{{Lu}}'))))""",
)
def term_candidates(spark, d):
    return document_lines(spark, d).where(T.is_term_candidate(c("line")))


@query(
    "number_cells",
    r"""SELECT l_orderkey, l_linenumber, cell,
      regexp_full_match(replace(replace(trim(cell), ',', ''), ' ', ''), '[+-]?\d+(\.\d+)?%?') AS number_like,
      regexp_full_match(trim(replace(replace(replace(cell, ',', ''), '₹', ''), 'Rs', '')), '[\-\d.]+') AS currency_number,
      regexp_full_match(replace(cell, ',', ''), '[\-\d.,]+') AS numeric_token
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag
      WHEN 'A' THEN 'Rs ' || CAST(l_partkey AS VARCHAR) WHEN 'N' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ',000%'
      ELSE l_linestatus || CAST(l_suppkey AS VARCHAR) END AS cell FROM lineitem)""",
)
def number_cells(spark, d):
    cell = (
        F.when(c("l_returnflag") == "A", F.concat(F.lit("Rs "), c("l_partkey").cast("string")))
        .when(c("l_returnflag") == "N", F.concat(c("l_quantity").cast("bigint").cast("string"), F.lit(",000%")))
        .otherwise(F.concat("l_linestatus", c("l_suppkey").cast("string")))
    )
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", cell.alias("cell"))
    return rows.select(
        "*",
        T.is_number_like(c("cell")).alias("number_like"),
        T.is_currency_number(c("cell")).alias("currency_number"),
        T.is_numeric_token(c("cell")).alias("numeric_token"),
    )


@query(
    "mostly_numeric_lines",
    r"""WITH t AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || ' ' || CAST(o_custkey AS VARCHAR) || ' ' || o_orderpriority AS line,
        CASE WHEN o_orderstatus = 'F' THEN [CAST(o_orderkey AS VARCHAR)] ELSE [CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR)] END AS nums FROM orders),
    w AS (SELECT *, string_split(line, ' ') AS toks FROM t),
    f AS (SELECT *, list_filter(toks, lambda x: regexp_full_match(x, '[\-\d.,]+')) AS digits FROM w)
    SELECT o_orderkey, line FROM f
    WHERE len(digits) * 1.0 / len(toks) >= 0.5
      AND len(list_filter(digits, lambda x: list_contains(nums, x))) >= greatest(1, CAST(floor(0.6 * len(digits)) AS BIGINT))""",
)
def mostly_numeric_lines(spark, d):
    key, cust = c("o_orderkey").cast("string"), c("o_custkey").cast("string")
    nums = F.when(c("o_orderstatus") == "F", F.array(key)).otherwise(F.array(cust, key))
    rows = table(spark, d, "orders").withColumn("line", F.concat_ws(" ", key, cust, "o_orderpriority"))
    return rows.where(T.mostly_numeric(c("line"), nums)).select("o_orderkey", "line")


@query(
    "date_only_lines",
    r"""SELECT o_orderkey, t AS line FROM (SELECT o_orderkey, CASE o_orderstatus
        WHEN 'F' THEN strftime(o_orderdate, '%-d %B %Y') WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
        ELSE 'due ' || strftime(o_orderdate, '%b %-d, %Y') END AS t FROM orders) WHERE NOT starts_with(t, 'due')""",
)
def date_only_lines(spark, d):
    dt = c("o_orderdate")
    line = (
        F.when(c("o_orderstatus") == "F", F.date_format(dt, "d MMMM yyyy"))
        .when(c("o_orderstatus") == "O", F.date_format(dt, "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("due "), F.date_format(dt, "MMM d, yyyy")))
    )
    return table(spark, d, "orders").select("o_orderkey", line.alias("line")).where(is_date_only(c("line")))


@query(
    "document_chunk_report",
    f"""WITH {q_clean('documents', 'doc_id', 'text')},
    w AS (SELECT d.source, c.doc_id, {q_words('c.c')} AS ws FROM cleaned c JOIN documents d ON d.doc_id = c.doc_id)
    SELECT source, count(*) AS documents, CAST(sum((len(ws) + 179) // 180) AS BIGINT) AS chunks,
           CAST(sum(len(ws)) AS BIGINT) AS words, CAST(max((len(ws) + 179) // 180) AS BIGINT) AS most_chunks
    FROM w GROUP BY source""",
)
def document_chunk_report(spark, d):
    docs = wide_table(spark, d, "documents", "doc_id", "source", "text")
    cleaned = docs.select("source", T.clean_text(c("text")).alias("t"))
    cut = cleaned.select("source", T.word_windows(c("t"), 180).alias("w"))
    sized = cut.select(
        "source",
        F.size("w").cast("bigint").alias("n"),
        F.coalesce(F.when(F.size("w") > 0, (F.size("w") - 1) * 180 + T.word_count(F.element_at("w", -1))), F.lit(0))
        .cast("bigint").alias("words"),
    )
    return sized.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n").alias("chunks"), F.sum("words").alias("words"),
        F.max("n").alias("most_chunks"),
    )
