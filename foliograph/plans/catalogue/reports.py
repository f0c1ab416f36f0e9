"""Queries over usage, status, files and images."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.functions.text import approx_tokens
from foliograph.operators import metrics as M
from foliograph.plans.registry import query, table
from foliograph.sources import files as S
from foliograph.sources.sinks import remaining_pages

c = F.col


def calls(spark, d):
    """Documents as calls: their text in, a third of it out, provider by language."""
    return table(spark, d, "documents").select(
        "doc_id", "source", "lang", approx_tokens(c("text")).cast("bigint").alias("input_tokens"),
        F.floor(c("n_chars") / 12).cast("bigint").alias("output_tokens"),
    )


Q_CALLS = """calls AS (SELECT doc_id, source, lang, CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END AS input_tokens,
  n_chars // 12 AS output_tokens FROM documents)"""
Q_SUMMARY = """count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_total, min(input_tokens) AS input_min, max(input_tokens) AS input_max,
  CAST(sum(output_tokens) AS BIGINT) AS output_total, min(output_tokens) AS output_min, max(output_tokens) AS output_max"""


@query("token_usage_summary", f"WITH {Q_CALLS} SELECT source, {Q_SUMMARY}, round_even(avg(input_tokens), 2) AS input_avg, round_even(avg(output_tokens), 2) AS output_avg FROM calls GROUP BY source")
def token_usage_summary(spark, d):
    return M.token_summary(calls(spark, d), ["source"])


@query("token_usage_total", f"WITH {Q_CALLS} SELECT {Q_SUMMARY}, round_even(avg(input_tokens), 2) AS input_avg, round_even(avg(output_tokens), 2) AS output_avg FROM calls")
def token_usage_total(spark, d):
    return M.token_summary(calls(spark, d))


@query(
    "token_cost",
    f"""WITH {Q_CALLS} SELECT source, CAST(sum(input_tokens) * 3 + sum(output_tokens) * 15 AS BIGINT) AS thousandths FROM calls GROUP BY source""",
)
def token_cost(spark, d):
    priced = calls(spark, d).groupBy("source").agg(F.sum("input_tokens").alias("i"), F.sum("output_tokens").alias("o"))
    total = M.cost(c("i"), c("o"), F.lit("3"), F.lit("15"))
    return priced.select("source", (total * 1000).cast("bigint").alias("thousandths"))


@query(
    "usage_rollup",
    f"""WITH {Q_CALLS} SELECT lang, source, count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_total,
      CAST(sum(output_tokens) AS BIGINT) AS output_total FROM calls GROUP BY ROLLUP (lang, source)""",
)
def usage_rollup(spark, d):
    return M.usage_report(calls(spark, d), ["lang", "source"]).drop("cost")


@query(
    "page_status",
    "SELECT 'conv_' || conv_id AS source, count(*) AS pages_done, CAST(max(turn) + 1 AS INTEGER) AS last_page FROM conversations GROUP BY conv_id",
)
def page_status(spark, d):
    pages = table(spark, d, "conversations").select(
        F.concat(F.lit("conv_"), c("conv_id").cast("string")).alias("source"), (c("turn") + 1).cast("int").alias("page")
    )
    return M.page_status(pages)


@query(
    "skip_existing",
    "SELECT o_custkey AS source, o_orderkey AS page FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def skip_existing(spark, d):
    """Orders without line items, as pages no run has finished."""
    pages = table(spark, d, "orders").select(c("o_custkey").alias("source"), c("o_orderkey").alias("page"))
    done = table(spark, d, "lineitem").select(c("l_orderkey").alias("page")).distinct().join(pages, "page")
    return remaining_pages(pages, done)


@query(
    "empty_page_fill",
    """SELECT c_custkey AS source, count(o_orderkey) AS n_chunks, CASE WHEN count(o_orderkey) = 0 THEN 'empty' ELSE 'text' END AS type
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def empty_page_fill(spark, d):
    counts = table(spark, d, "orders").groupBy(c("o_custkey").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    pages = table(spark, d, "customer").select(c("c_custkey").alias("source"))
    n = F.coalesce(c("n"), F.lit(0))
    return pages.join(counts, "source", "left").select(
        "source", n.alias("n_chunks"), F.when(n == 0, "empty").otherwise("text").alias("type")
    )


@query(
    "file_kinds",
    r"""SELECT page_id, lower(regexp_extract(url || ext, '(\.[^./?#]+)(?:[?#].*)?$', 1)) AS suffix,
      CASE WHEN ext IN ('.PDF') THEN 'document' WHEN ext IN ('.Png', '.tiff') THEN 'image' ELSE 'other' END AS kind
    FROM (SELECT page_id, url, CASE length(url) % 4 WHEN 0 THEN '/a.PDF' WHEN 1 THEN '/b.Png' WHEN 2 THEN '/c.tiff' ELSE '/d.txt' END AS e, e[3:] AS ext FROM pages)""",
)
def file_kinds(spark, d):
    n = F.length("url") % 4
    path = F.concat("url", F.when(n == 0, "/a.PDF").when(n == 1, "/b.Png").when(n == 2, "/c.tiff").otherwise("/d.txt"))
    # Query strings in a URL are not part of its suffix.
    bare = F.regexp_replace("url", r"[?#].*$", "")
    path = F.concat(bare, F.substring(path, F.length("url") + 1, F.lit(10)))
    return table(spark, d, "pages").select("page_id", S.suffix(path).alias("suffix"), S.file_kind(path).alias("kind"))


@query(
    "path_parts",
    """SELECT p_partkey, p_name AS stem, p_type || '<' || p_brand || '<' || 'data' AS parents FROM part""",
)
def path_parts(spark, d):
    path = F.concat(F.lit("file:///data/"), c("p_brand"), F.lit("/"), c("p_type"), F.lit("/"), c("p_name"), F.lit(".pdf"))
    return table(spark, d, "part").select(
        "p_partkey", S.stem(path).alias("stem"), F.array_join(S.parent_folders(path), "<").alias("parents")
    )


@query(
    "image_tokens",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round_even((l_suppkey + 100) * (CAST(l_quantity AS BIGINT) * 40) / 750.0, 0) AS BIGINT) AS tokens FROM lineitem""",
)
def image_tokens(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        M.image_tokens(c("l_suppkey") + 100, c("l_quantity").cast("bigint") * 40).alias("tokens"),
    )


@query(
    "safe_concurrency",
    """WITH s AS (SELECT source, greatest(800, CAST(floor(sum(n_chars) * 1.0 / count(*)) AS BIGINT)) AS m FROM documents GROUP BY source)
    SELECT source, m AS mean_tokens, greatest(2, least(greatest(1, 700000 // m) * 5 // 60, 58, 32)) AS calls FROM s""",
)
def safe_concurrency(spark, d):
    s = table(spark, d, "documents").groupBy("source").agg(F.sum("n_chars").alias("t"), F.count(F.lit(1)).alias("n"))
    m = s.select("source", M.mean_call_tokens(F.lit(0), c("t") / c("n")).alias("m"))
    return m.select("source", c("m").cast("bigint").alias("mean_tokens"), M.safe_concurrency(c("m")).cast("bigint").alias("calls"))


@query(
    "rendering_choice",
    """SELECT doc_id, CASE WHEN n_chars * 4000 <= 3919872 THEN 'png' WHEN n_chars * 900 <= 3919872 THEN 'jpeg90' WHEN n_chars * 300 <= 3919872 THEN 'jpeg60' END AS format FROM documents""",
)
def rendering_choice(spark, d):
    """First of the ranked renderings under the byte budget."""
    made = F.array(
        *[F.struct(F.lit(n).alias("format"), (c("n_chars") * k).alias("bytes")) for n, k in (("png", 4000), ("jpeg90", 900), ("jpeg60", 300))]
    )
    return table(spark, d, "documents").select("doc_id", S.first_rendering(made, S.byte_budget(F.lit(True)))["format"].alias("format"))


@query(
    "image_sizes",
    "SELECT p_partkey, p_size AS width, CAST(p_partkey + 1 AS INTEGER) AS height FROM part",
)
def image_sizes(spark, d):
    """Header bytes of a PNG, GIF or BMP of each part's size, read back; a GIF has two bytes a side, so larger ones are BMP."""
    w, h = c("p_size"), (c("p_partkey") + 1).cast("int")

    def big(x):
        return F.lpad(F.hex(x), 8, "0")

    def little(x, n):
        return F.concat(*[F.substring(big(x), 7 - 2 * i, 2) for i in range(n)])

    kind = F.pmod(c("p_partkey"), F.lit(3))
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), big(w), big(h))
    gif = F.concat(F.lit("474946383961"), little(w, 2), little(h, 2), F.lit("00000000000000000000000000000000"))
    bmp = F.concat(F.lit("424D" + "00" * 16), little(w, 4), little(h, 4))
    content = F.unhex(F.when(kind == 0, png).when((kind == 1) & (F.greatest(w, h) < 1 << 16), gif).otherwise(bmp))
    return table(spark, d, "part").select("p_partkey", S.image_size(content).alias("s")).select("p_partkey", "s.width", "s.height")


@query(
    "page_scale",
    "SELECT p_partkey, CASE WHEN 1600.0 / (p_size + 10) <= 2000.0 / (p_size + 14) THEN 'width' ELSE 'height' END AS bound FROM part",
)
def page_scale(spark, d):
    w, h = c("p_size") + 10, c("p_size") + 14
    by_width = S.fit_scale(w, h) == F.lit(1600) / w
    return table(spark, d, "part").select("p_partkey", F.when(by_width, "width").otherwise("height").alias("bound"))


@query(
    "provider_keys",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Gemini' WHEN 'MACHINERY' THEN 'Claude' WHEN 'FURNITURE' THEN 'OpenAI'
      ELSE lower(c_mktsegment) END AS provider FROM customer""",
)
def provider_keys(spark, d):
    label = (
        F.when(c("c_mktsegment") == "BUILDING", "Gemini (flash)").when(c("c_mktsegment") == "MACHINERY", "Bedrock model")
        .when(c("c_mktsegment") == "FURNITURE", "an OpenAI model").otherwise(F.concat("c_mktsegment", F.lit(" x")))
    )
    return table(spark, d, "customer").select("c_custkey", M.provider_key(label).alias("provider"))


@query(
    "tables_and_charts_union",
    """SELECT n_nationkey AS id, 'table' AS kind, n_name AS name FROM nation UNION ALL SELECT s_suppkey, 'chart', s_name FROM supplier""",
)
def tables_and_charts_union(spark, d):
    """Items of both kinds in one bag, duplicates kept."""
    t = table(spark, d, "nation").select(c("n_nationkey").cast("bigint").alias("id"), F.lit("table").alias("kind"), c("n_name").alias("name"))
    return t.unionByName(table(spark, d, "supplier").select(c("s_suppkey").alias("id"), F.lit("chart").alias("kind"), c("s_name").alias("name")))
