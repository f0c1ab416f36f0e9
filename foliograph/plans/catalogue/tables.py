"""Queries over tables and charts made from rows of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.functions import charts as C
from foliograph.functions import tables as X
from foliograph.operators import ordered as O
from foliograph.operators import repair as R
from foliograph.operators.ordered import upper_median
from foliograph.plans.registry import Q_LINES, document_lines, q_count, q_norm, q_strip, query, table, text_array, wide_table

c = F.col
SHOW = "lambda v: coalesce(v, '<null>')"


def _line_cells(spark, d):
    """Each line is a table: its words are the cells, four to a row."""
    words = F.split("line", " ")
    lines = document_lines(spark, d).withColumn("w", words)
    n = F.floor((F.size("w") + 3) / 4).cast("int")
    rows = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(c("w"), i * 4 + 1, F.lit(4)))
    return lines.select("doc_id", "line_no", F.slice("w", 1, 3).alias("headers"), rows.alias("rows"))


Q_CELLS = f"""{Q_LINES}, cells AS (
  SELECT doc_id, line_no, string_split(line, ' ') AS w FROM lines),
grid AS (
  SELECT doc_id, line_no, w[1:3] AS headers, unnest(generate_series(0, (len(w) - 1) // 4)) AS i, w FROM cells),
rws AS (SELECT doc_id, line_no, headers, i, w[i * 4 + 1 : i * 4 + 4] AS r FROM grid)"""


@query(
    "markdown_rows",
    rf"""WITH {Q_CELLS}, padded AS (
      SELECT *, CASE WHEN len(r) > len(headers)
          THEN list_concat(r[1 : len(headers) - 1], [array_to_string(r[len(headers):], ' | ')])
          ELSE list_concat(r, list_transform(generate_series(1, len(headers) - len(r)), lambda k: '')) END AS p FROM rws),
    drawn AS (SELECT doc_id, line_no, headers, i,
        '| ' || array_to_string(list_transform(p, lambda v: replace(v, '|', '\|')), ' | ') || ' |' AS l FROM padded)
    SELECT doc_id, line_no, '| ' || array_to_string(any_value(headers), ' | ') || ' |' || chr(10) || '| ' ||
      array_to_string(list_transform(any_value(headers), lambda h: '---'), ' | ') || ' |' || chr(10) ||
      string_agg(l, chr(10) ORDER BY i) AS md FROM drawn GROUP BY doc_id, line_no""",
)
def markdown_rows(spark, d):
    return _line_cells(spark, d).select("doc_id", "line_no", X.markdown(c("headers"), c("rows")).alias("md"))


@query(
    "row_normalise",
    f"""WITH {Q_CELLS} SELECT doc_id, line_no, string_agg(array_to_string(list_transform(
        list_concat(r, list_value(NULL, NULL, NULL)[1 : greatest(len(headers) - len(r), 0)]), {SHOW}), ' | '), ' / ' ORDER BY i) AS cells
    FROM rws GROUP BY doc_id, line_no""",
)
def row_normalise(spark, d):
    shaped = X.normalise_rows(c("headers"), c("rows"))
    return _line_cells(spark, d).select(
        "doc_id", "line_no", F.array_join(F.transform(shaped, lambda r: text_array(r)), " / ").alias("cells")
    )


def _shifted(spark, d):
    """Line items as one-row tables; some rows end blank with a number in front."""
    qty = c("l_quantity").cast("bigint").cast("string")
    row = F.when(
        c("l_returnflag") == "A", F.array("l_linestatus", qty, c("l_suppkey").cast("string"), F.lit(""))
    ).otherwise(F.array("l_linestatus", F.lit("n/a"), qty, F.lit("x")))
    items = wide_table(
        spark, d, "lineitem",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity",
    )
    return items.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.array(F.lit(""), F.lit("May"), F.lit("April"), F.lit("March")).alias("headers"),
        F.array(row).alias("rows"),
    )


@query(
    "row_rotate",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      CASE WHEN l_returnflag = 'A' THEN '' || ' | May | April | March' ELSE ' | May | April | March' END AS headers,
      CASE WHEN l_returnflag = 'A' THEN l_linestatus || ' |  | ' || CAST(l_quantity AS BIGINT) || ' | ' || l_suppkey
           ELSE l_linestatus || ' | n/a | ' || CAST(l_quantity AS BIGINT) || ' | x' END AS cells,
      l_returnflag = 'A' AS rotated FROM lineitem""",
)
def row_rotate(spark, d):
    fixed = _shifted(spark, d).withColumn("t", X.rotate_shifted_rows(c("headers"), c("rows")))
    return fixed.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        text_array(c("t.headers")).alias("headers"),
        text_array(F.get("t.rows", F.lit(0))).alias("cells"),
        c("t.rotated").alias("rotated"),
    )


@query(
    "row_rotate_wide",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      CASE WHEN l_returnflag = 'A' THEN 'May | April | March' ELSE ' | May | April | March' END AS headers,
      CAST(4 AS BIGINT) AS width FROM lineitem""",
)
def row_rotate_wide(spark, d):
    fixed = _shifted(spark, d).withColumn("t", X.rotate_shifted_rows(c("headers"), c("rows"), keep_wide=True))
    return fixed.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        text_array(c("t.headers")).alias("headers"),
        F.size(F.get("t.rows", F.lit(0))).cast("bigint").alias("width"),
    )


@query(
    "blank_lead_drop",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      CASE WHEN l_returnflag = 'A' THEN 'May | April | March' ELSE ' | May | April | March' END AS headers,
      CASE WHEN l_returnflag = 'A' THEN l_linestatus || ' |  | ' || CAST(l_quantity AS BIGINT) || ' | ' || l_suppkey
           ELSE l_linestatus || ' | n/a | ' || CAST(l_quantity AS BIGINT) || ' | x' END AS cells FROM lineitem""",
)
def blank_lead_drop(spark, d):
    fixed = _shifted(spark, d).withColumn("t", X.drop_blank_lead(c("headers"), c("rows")))
    return fixed.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        text_array(c("t.headers")).alias("headers"),
        text_array(F.get("t.rows", F.lit(0))).alias("cells"),
    )


@query(
    "numeric_fraction",
    """SELECT l_shipmode, count(*) AS n, CAST(sum(nums) AS BIGINT) AS numeric_cells FROM (
      SELECT l_returnflag || l_linestatus AS l_shipmode,
        2 + CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS nums FROM lineitem) GROUP BY l_shipmode""",
)
def numeric_fraction(spark, d):
    row = F.array(
        c("l_returnflag"), c("l_quantity").cast("bigint").cast("string"), c("l_suppkey").cast("string"),
        F.when(c("l_discount") > 0.05, "1,000.5"), F.lit("n/a"),
    )
    rows = table(spark, d, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("l_shipmode"), X.numeric_share(F.array(row)).alias("share")
    )
    return rows.groupBy("l_shipmode").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.bround(c("share") * 4, 0).cast("bigint")).alias("numeric_cells")
    )


@query(
    "upper_median",
    """SELECT l_returnflag, l_linestatus, list_sort(list(l_extendedprice))[count(*) // 2 + 1] AS median
    FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def upper_median_price(spark, d):
    items = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    return upper_median(items, ["l_returnflag", "l_linestatus"], "l_extendedprice", "median", bucket_width=500.0)


@query(
    "table_similarity_dups",
    f"""WITH {Q_LINES}, t AS (
      SELECT doc_id, line_no, list_transform(list_filter(string_split(line, ' '), lambda w: trim(w) <> ''), lambda w: {q_norm('w')}) AS h FROM lines),
    f AS (SELECT doc_id, h AS nh FROM t WHERE line_no = 1),
    j AS (SELECT t.doc_id, max(CASE WHEN len(nh) > 0 AND len(h) > 0
        AND len(list_intersect(list_distinct(nh), list_distinct(h))) * 10 >= len(nh) * 7 THEN 1 ELSE 0 END) AS dup
      FROM t JOIN f ON t.doc_id = f.doc_id WHERE t.line_no > 1 GROUP BY t.doc_id)
    SELECT f.doc_id, coalesce(dup, 0) = 1 AS duplicate FROM f LEFT JOIN j ON f.doc_id = j.doc_id""",
)
def table_similarity_dups(spark, d):
    """First line of a document as a new table header, the others as existing ones."""
    from foliograph.functions.text import has_line, nonblank_lines

    docs = wide_table(spark, d, "documents", "doc_id", "text").where(has_line(c("text"))).withColumn("l", nonblank_lines(c("text")))
    none = F.array().cast("array<array<string>>")
    heads = F.transform("l", lambda x: F.struct(F.split(x, " ").alias("headers"), none.alias("rows")))
    shaped = docs.withColumn("t", heads)
    rest = F.slice(c("t"), F.lit(2), F.greatest(F.size("t") - 1, F.lit(0)))
    return shaped.select("doc_id", X.is_duplicate_table(F.get("t", F.lit(0)), rest).alias("duplicate"))


@query(
    "nearest_header_assign",
    """WITH h AS (SELECT r_regionkey AS i, r_name, 20000.0 + 20000.0 * r_regionkey AS x FROM region),
    p AS (SELECT l_returnflag, l_linestatus, l_extendedprice,
        (SELECT list(struct_pack(i := i, n := r_name, x := x) ORDER BY i) FROM h) AS hs FROM lineitem),
    a AS (SELECT l_returnflag, l_linestatus,
        list_sort(list_transform(hs, lambda q: struct_pack(d := abs(l_extendedprice - q.x), i := q.i, n := q.n)))[1].n AS header FROM p)
    SELECT l_returnflag, l_linestatus, header, count(*) AS n FROM a GROUP BY ALL""",
)
def nearest_header_assign(spark, d):
    """Each price under the nearest of the region positions, ties to the first.

    Prices and positions are put in one order and filled from both sides, so no
    list of positions is gathered and no price meets more than two of them.
    """
    x = 20000.0 + 20000.0 * c("r_regionkey")
    head = F.struct(x.alias("x"), c("r_regionkey").cast("long").alias("i"), c("r_name").alias("n"))
    heads = table(spark, d, "region").select(F.lit(1).alias("one"), x.alias("x"), F.lit(0).alias("is_price"), head.alias("h"))
    prices = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus", c("l_extendedprice").cast("double").alias("x")).agg(F.count("*").alias("m"))
    rows = prices.withColumns({"one": F.lit(1), "is_price": F.lit(1)}).unionByName(heads, allowMissingColumns=True)
    below = O.fill_forward(rows, ["one"], "x", {"h": "below"}, ["is_price"])
    both = O.fill_forward(below.withColumn("down", -c("x")), ["one"], "down", {"h": "above"}, ["is_price"])
    near = lambda h: F.when(h.isNotNull(), F.struct(F.abs(c("x") - h["x"]).alias("d"), h["i"].alias("i"), h["n"].alias("n")))
    placed = both.where("is_price = 1").withColumn("header", F.array_min(F.array_compact(F.array(near(c("below")), near(c("above")))))["n"])
    return placed.groupBy("l_returnflag", "l_linestatus", "header").agg(F.sum("m").alias("n"))


@query(
    "key_value_rows",
    """SELECT c_custkey, 'c_name=' || c_name || ' / segment=' || c_mktsegment || ' / nation=' || c_nationkey AS cells FROM customer""",
)
def key_value_rows(spark, d):
    m = F.create_map(
        F.lit("c_name"), "c_name", F.lit("segment"), "c_mktsegment", F.lit("nation"), c("c_nationkey").cast("string")
    )
    rows = X.key_value_rows(m)
    return table(spark, d, "customer").select(
        "c_custkey", F.array_join(F.transform(rows, lambda r: F.array_join(r, "=")), " / ").alias("cells")
    )


@query(
    "zip_columns",
    """WITH t AS (SELECT p_partkey, string_split(p_name, ' ') AS a, [p_brand] AS b, [p_type, CAST(p_size AS VARCHAR), 'x'] AS e FROM part),
    g AS (SELECT *, unnest(generate_series(1, greatest(len(a), 3))) AS i FROM t)
    SELECT p_partkey, string_agg(coalesce(a[i], '') || '|' || coalesce(b[i], '') || '|' || coalesce(e[i], ''), ' / ' ORDER BY i) AS cells
    FROM g GROUP BY p_partkey""",
)
def zip_columns(spark, d):
    cols = F.array(
        F.split("p_name", " "), F.array("p_brand"), F.array(c("p_type"), c("p_size").cast("string"), F.lit("x"))
    )
    rows = X.zip_columns(cols)
    return table(spark, d, "part").select(
        "p_partkey", F.array_join(F.transform(rows, lambda r: F.array_join(r, "|")), " / ").alias("cells")
    )


@query(
    "object_rows",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'key | status | price' ELSE 'key | status' END AS headers,
      CASE WHEN o_orderstatus = 'F' THEN o_orderkey || ' | F | <null> / <null> | second | ' || o_custkey
           ELSE o_orderkey || ' | ' || o_orderstatus || ' / only | <null>' END AS cells FROM orders""",
)
def object_rows(spark, d):
    """Rows given as JSON objects or lists become list rows under one header order."""
    key, cust = c("o_orderkey").cast("string"), c("o_custkey").cast("string")
    rows = F.when(
        c("o_orderstatus") == "F",
        F.array(
            F.format_string('{"key": %s, "status": "F"}', key), F.format_string('{"status": "second", "price": %s}', cust)
        ),
    ).otherwise(F.array(F.format_string('{"key": "%s", "status": "%s"}', key, c("o_orderstatus")), F.lit('["only"]')))
    shaped = table(spark, d, "orders").select(
        "o_orderkey", X.shape_json_table(F.array().cast("array<string>"), rows).alias("t")
    )
    return shaped.select(
        "o_orderkey",
        text_array(c("t.headers")).alias("headers"),
        F.array_join(F.transform("t.rows", lambda r: text_array(r)), " / ").alias("cells"),
    )


@query(
    "table_text",
    """SELECT s_suppkey, 'suppliers > Balances' || chr(10) || chr(10) ||
      CASE WHEN s_acctbal > 0 THEN 'In credit ' ELSE '' END || 'Balances' || chr(10) || chr(10) ||
      '| Name | Nation |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || s_name || ' | ' || s_nationkey || ' |' AS text FROM supplier""",
)
def table_text(spark, d):
    rows = F.array(F.array(c("s_name"), c("s_nationkey").cast("string")))
    text = X.table_text(
        F.lit("suppliers > Balances\n\n"), F.when(c("s_acctbal") > 0, "In credit"), F.lit("Balances"), F.lit(""),
        F.array(F.lit("Name"), F.lit("Nation")), rows,
    )
    return table(spark, d, "supplier").select("s_suppkey", text.alias("text"))


@query(
    "chart_text",
    """SELECT p_partkey, 'parts' || chr(10) || p_name || chr(10) || chr(10) || 'chart_type: bar' || chr(10) || chr(10) ||
      'Series: ' || p_brand || chr(10) || '[' || p_size || ', null, "' || p_type || '"]' AS text FROM part""",
)
def chart_text(spark, d):
    points = C.json_list_text(F.format_string('[%s,null,"%s"]', c("p_size").cast("string"), c("p_type")))
    series = F.array(F.struct(c("p_brand").alias("name"), points.alias("points")))
    text = C.chart_text(F.lit("parts\n\n"), F.lit(None).cast("string"), c("p_name"), F.lit("bar"), series, F.lit("{}"))
    return table(spark, d, "part").select("p_partkey", text.alias("text"))


@query(
    "chart_inference",
    """SELECT p_partkey, p_brand AS title, p_partkey AS second, CASE WHEN p_size > 25 THEN 7 END AS last_value FROM part""",
)
def chart_inference(spark, d):
    """A part's sizes as a section text; numbers become values, names become labels."""
    content = F.concat(
        c("p_name"), F.lit("\n"), c("p_size").cast("string"), F.lit("; "), c("p_partkey").cast("string"),
        F.lit("; 12,"), F.format_string("%03d", c("p_size")), F.lit("\n"), F.when(c("p_size") > 25, "7").otherwise("none"),
    )
    made = table(spark, d, "part").select("p_partkey", "p_size", C.infer_chart(c("p_brand"), content).alias("ch"))
    last = F.get("ch.y_values", F.lit(3))
    return made.select(
        "p_partkey",
        c("ch.title").alias("title"),
        F.get("ch.y_values", F.lit(1)).cast("bigint").alias("second"),
        last.cast("int").alias("last_value"),
    )


@query(
    "row_repair",
    """SELECT o_orderkey, 'Total | ' || o_custkey || ' | ' || CAST(floor(o_totalprice) AS BIGINT) AS cells FROM orders""",
)
def row_repair(spark, d):
    """A row whose cells came out shifted is realigned from the page's spans."""
    price, cust = F.floor("o_totalprice").cast("string"), c("o_custkey").cast("string")

    def span(text, x, y):
        return F.struct(text.alias("text"), F.lit(x).alias("x"), F.lit(y).alias("y"))

    def line(text, y, *spans):
        return F.struct(text.alias("text"), F.lit(y).alias("y"), F.array(*spans).alias("spans"))

    lines = F.array(
        line(F.lit("Item Customer Price"), 10.0, span(F.lit("Item"), 5.0, 10.0), span(F.lit("Customer"), 100.0, 10.0), span(F.lit("Price"), 200.0, 10.0)),
        line(F.lit("Total"), 30.0, span(F.lit("Total"), 5.0, 30.0)),
        line(F.concat_ws(" ", price, cust), 31.0, span(price, 195.0, 31.0), span(cust, 110.0, 31.0)),
    )
    heads = F.array(F.lit("Item"), F.lit("Customer"), F.lit("Price"))
    broken = F.array(F.array(F.lit("Total"), F.lit("n/a"), price))
    return table(spark, d, "orders").select(
        "o_orderkey", text_array(F.get(R.repair_table(heads, broken, lines), F.lit(0))).alias("cells")
    )


@query(
    "glossary_pairs",
    """SELECT p_partkey, upper(p_brand) AS term, 'a ' || p_name || ' of the usual kind. as sold' AS definition, p_type AS second FROM part""",
)
def glossary_pairs(spark, d):
    content = F.concat(
        F.upper("p_brand"), F.lit("\na "), c("p_name"), F.lit(" of the usual kind.\nas sold\n"),
        c("p_type"), F.lit("\nthe type of the part, as listed."),
    )
    pairs = table(spark, d, "part").select("p_partkey", R.glossary_pairs(content).alias("g"))
    return pairs.select(
        "p_partkey",
        F.get(F.get("g", F.lit(0)), F.lit(0)).alias("term"),
        F.get(F.get("g", F.lit(0)), F.lit(1)).alias("definition"),
        F.get(F.get("g", F.lit(1)), F.lit(0)).alias("second"),
    )


Q_TERM = r"""n <= 8 AND ((letters > 0 AND uppers * 1.0 / letters >= 0.6)
      OR (regexp_full_match(line, '[A-Z0-9/&\-\s.()]{1,30}') AND upper(line) = line)
      OR (n <= 3 AND length(line) < 40 AND NOT regexp_matches(line, '[.:;]')
          AND (upper(line) = line OR regexp_matches(line, '^\p{Lu}'))))"""


@query(
    "glossary_tables",
    rf"""WITH d AS (
      SELECT doc_id, coalesce(regexp_replace(text, '[.,] +', chr(10), 'g'), '') AS content,
        CASE WHEN doc_id % 5 = 0 THEN 'Notes' ELSE 'A Glossary of ' || source END AS heading FROM documents),
    raw AS (SELECT doc_id, unnest(string_split(content, chr(10))) AS ln,
      generate_subscripts(string_split(content, chr(10)), 1) AS pos FROM d WHERE heading <> 'Notes'),
    lines AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i, {q_strip('ln')} AS line
      FROM raw WHERE {q_strip('ln')} <> ''),
    facts AS (SELECT *, {q_count('line')} AS n, len(regexp_extract_all(line, '\p{{L}}')) AS letters,
      len(regexp_extract_all(line, '\p{{Lu}}')) AS uppers FROM lines),
    marked AS (SELECT doc_id, i, line, {Q_TERM} AS term FROM facts),
    islands AS (SELECT *, count(*) FILTER (term) OVER (PARTITION BY doc_id ORDER BY i) AS g,
      count(*) FILTER (term) OVER (PARTITION BY doc_id) AS terms, count(*) OVER (PARTITION BY doc_id) AS n FROM marked),
    pairs AS (
      SELECT doc_id, g AS k, max(line) FILTER (term) AS a, coalesce(string_agg(line, ' ' ORDER BY i) FILTER (NOT term), '') AS b
      FROM islands WHERE g > 0 GROUP BY doc_id, g
      UNION ALL SELECT doc_id, (i + 1) // 2, max(line) FILTER (i % 2 = 1), max(line) FILTER (i % 2 = 0)
      FROM islands WHERE terms = 0 AND i <= n - n % 2 GROUP BY doc_id, (i + 1) // 2),
    made AS (SELECT doc_id, count(*) AS n_rows, string_agg(a || ' = ' || b, chr(10) ORDER BY k) AS pairs FROM pairs GROUP BY doc_id),
    fresh AS (SELECT * FROM made WHERE n_rows <> 1 + doc_id % 4)
    SELECT d.doc_id, f.doc_id IS NOT NULL AS made, coalesce(n_rows, 0) AS n_rows, coalesce(pairs, '') AS pairs,
      CASE WHEN f.doc_id IS NULL THEN d.content ELSE '' END AS left_over
    FROM d LEFT JOIN fresh f ON d.doc_id = f.doc_id""",
)
def glossary_tables(spark, d):
    """Each text is a section, mostly a glossary, on a page whose one table has its title and one to four rows."""
    content = F.coalesce(F.regexp_replace("text", "[.,] +", "\n"), F.lit(""))
    title = F.concat(F.lit("A Glossary of "), c("source"))
    docs = wide_table(spark, d, "documents", "doc_id", "source", "text")
    sections = F.array(F.struct(F.when(c("doc_id") % 5 == 0, "Notes").otherwise(title).alias("heading"), content.alias("content")))
    rows = F.transform(F.sequence(F.lit(1), (c("doc_id") % 4 + 1).cast("int")), lambda i: F.array(i.cast("string")))
    pages = docs.select("doc_id", sections.alias("sections"), F.array(F.struct(title.alias("title"), rows.alias("rows"))).alias("tables"))
    pages = pages.withColumn("new", R.glossary_tables(c("sections"), c("tables"), F.lit(1)))
    cells = F.flatten(F.transform("new", lambda t: t["rows"]))
    return pages.select(
        "doc_id",
        (F.size("new") > 0).alias("made"),
        F.size(cells).cast("bigint").alias("n_rows"),
        F.array_join(F.transform(cells, lambda r: F.concat(F.get(r, F.lit(0)), F.lit(" = "), F.get(r, F.lit(1)))), "\n").alias("pairs"),
        F.get(R.clear_used_glossaries(c("sections"), c("new")), F.lit(0))["content"].alias("left_over"),
    )


@query(
    "typed_tables",
    """WITH p AS (SELECT *, p_partkey % 4 AS k, p_partkey % 3 + 1 AS n FROM part),
    r AS (SELECT *, unnest(range(0, n)) AS i FROM p)
    SELECT p_partkey, 0::BIGINT AS number, p_name AS title,
      CASE k WHEN 0 THEN 'name | size | col_3' WHEN 1 THEN 'brand | size' ELSE 'name | size' END AS headers,
      string_agg(CASE k WHEN 0 THEN i || ' | ' || p_size || ' | ' || p_type WHEN 1 THEN p_brand || ' | ' || (p_size + i)
        ELSE i || ' | ' || p_type END, ' / ' ORDER BY i) AS cells
    FROM r WHERE k < 3 GROUP BY ALL
    UNION ALL SELECT p_partkey, 0, p_brand, 'Part Key | Size', string_agg(p_partkey || ' | ' || (p_size + i), ' / ' ORDER BY i)
    FROM r WHERE k = 3 GROUP BY p_partkey, p_brand
    UNION ALL SELECT p_partkey, 1, p_name, 'Value', p_type || ' / ' || p_brand FROM p WHERE k = 3
    UNION ALL SELECT p_partkey, 2, 'Cols', 'a | b', string_agg(i || ' | ' || CASE WHEN i = 0 THEN p_type ELSE '' END, ' / ' ORDER BY i)
    FROM r WHERE k = 3 GROUP BY p_partkey""",
)
def typed_tables(spark, d):
    """Tables under every alias: surplus cells, ``cells``, rows as objects without headers, and segments of three shapes."""
    from foliograph.sources.pages import typed_pages

    part = table(spark, d, "part").withColumn("i", F.sequence(F.lit(0), (c("p_partkey") % 3).cast("int")))
    name, brand, kind = c("p_name"), c("p_brand"), c("p_type")
    size, key = c("p_size").cast("string"), c("p_partkey").cast("string")
    each = lambda f: F.transform("i", f)
    shapes = [
        F.struct(name.alias("title"), F.array(F.lit("name"), F.lit("size")).alias("headers"), each(lambda i: F.array(i.cast("string"), size, kind)).alias("rows")),
        F.struct(name.alias("name"), F.array(F.lit("brand"), F.lit("size")).alias("columns"), each(lambda i: F.array(brand, (c("p_size") + i).cast("string"))).alias("cells")),
        F.struct(name.alias("title"), each(lambda i: F.struct(i.cast("string").alias("name"), kind.alias("size"))).alias("rows")),
    ]
    first = F.to_json(F.struct(brand.alias("section"), each(lambda i: F.struct(c("p_partkey").alias("part_key"), (c("p_size") + i).alias("size"))).alias("items")))
    second = F.to_json(F.struct(F.array(kind, brand).alias("items")))
    columns = F.array(
        F.struct(F.lit("a").alias("header"), each(lambda i: i.cast("string")).alias("values")),
        F.struct(F.lit("b").alias("header"), F.array(kind).alias("values")),
    )
    third = F.to_json(F.struct(F.lit("Cols").alias("section"), columns.alias("columns")))
    segmented = F.concat(F.lit('{"type":"table","title":'), F.to_json(F.array(name)), F.lit(',"data":['), F.concat_ws(",", first, second, third), F.lit("]}"))
    segmented = F.replace(F.replace(segmented, F.lit('"title":['), F.lit('"title":')), F.lit('],"data"'), F.lit(',"data"'))
    chosen = F.lit(None).cast("string")
    for k, shape in enumerate(shapes):
        chosen = F.when(c("p_partkey") % 4 == k, F.to_json(shape)).otherwise(chosen)
    json = F.concat(F.lit('{"tables":['), F.coalesce(chosen, segmented), F.lit("]}"))
    pages = part.select(key.alias("source"), F.lit(1).alias("page"), json.alias("json"))
    tables = typed_pages(pages, finished=False).select("source", F.posexplode("tables").alias("number", "t"))
    return tables.select(
        c("source").cast("bigint").alias("p_partkey"), c("number").cast("bigint").alias("number"), c("t.title").alias("title"),
        text_array(c("t.headers")).alias("headers"), F.array_join(F.transform("t.rows", lambda r: text_array(r)), " / ").alias("cells"),
    )


@query(
    "typed_charts",
    """WITH l AS (SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS i, l_quantity::BIGINT AS q FROM lineitem)
    SELECT l_suppkey, count(*) AS n_values, sum(q)::BIGINT AS total, min(CASE WHEN i = 1 THEN q END) AS first_value, 2::BIGINT AS n_labels
    FROM l GROUP BY l_suppkey HAVING count(*) >= 3""",
)
def typed_charts(spark, d):
    """All line quantities of a supplier as one section text: every number becomes a value."""
    rows = table(spark, d, "lineitem").select("l_suppkey", F.struct("l_orderkey", "l_linenumber", c("l_quantity").cast("bigint").alias("q")).alias("x"))
    text = rows.groupBy("l_suppkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["q"].cast("string")), "; ").alias("t"))
    made = text.withColumn("ch", C.infer_chart(F.lit("Quantities"), F.concat(F.lit("one\ntwo\n"), c("t"))))
    whole = F.aggregate("ch.y_values", F.lit(0.0), lambda a, v: a + v)
    return made.where(c("ch").isNotNull()).select(
        "l_suppkey", F.size("ch.y_values").cast("bigint").alias("n_values"), whole.cast("bigint").alias("total"),
        F.get("ch.y_values", F.lit(0)).cast("bigint").alias("first_value"), F.size("ch.x_values").cast("bigint").alias("n_labels"),
    )
