"""Queries over dates, written from the order dates in many forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.functions import dates as D
from foliograph.operators.reports import strongest_source
from foliograph.plans.registry import query, wide_table

c = F.col


def dt():
    return F.col("o_orderdate")


def _fmt(pattern: str):
    return F.date_format(dt(), pattern)


def _orders(spark, d):
    return wide_table(
        spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice"
    )


@query(
    "spoken_date",
    """SELECT o_orderkey, CAST(day(o_orderdate) AS VARCHAR) ||
      CASE WHEN day(o_orderdate) IN (1, 21, 31) THEN 'st' WHEN day(o_orderdate) IN (2, 22) THEN 'nd'
           WHEN day(o_orderdate) IN (3, 23) THEN 'rd' ELSE 'th' END || strftime(o_orderdate, ' %B %Y') AS spoken,
      strftime(o_orderdate, '%B %Y') AS month FROM orders""",
)
def spoken_date(spark, d):
    return _orders(spark, d).select("o_orderkey", D.spoken_date(dt()).alias("spoken"), D.month_label(dt()).alias("month"))


@query(
    "month_year_parse",
    """SELECT o_orderkey, CAST(strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS VARCHAR) AS first_day FROM orders""",
)
def month_year_parse(spark, d):
    text = (
        F.when(c("o_orderstatus") == "F", F.concat(F.lit("Report for "), _fmt("MMMM yyyy"), F.lit(", then May 1999")))
        .when(c("o_orderstatus") == "O", F.concat(F.lit("(as of "), _fmt("MMM yyyy"), F.lit(")")))
        .otherwise(F.upper(F.concat(F.lit("issue "), _fmt("MMM  yyyy"))))
    )
    # Years before 2000 are not month-year dates, so the text moves into this century.
    moved = _orders(spark, d).withColumn("o_orderdate", F.expr("o_orderdate + interval 40 years"))
    parsed = F.expr("add_months(parsed, -480)")
    return moved.select("o_orderkey", D.month_year(text).alias("parsed")).select(
        "o_orderkey", F.date_format(parsed, "yyyy-MM-dd").alias("first_day")
    )


@query("date_forms", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def date_forms(spark, d):
    """Every order date written in one of six forms and read back."""
    shape = F.pmod(F.hash("o_orderkey"), F.lit(6))
    text = (
        F.when(shape == 0, _fmt("d MMMM yyyy"))
        .when(shape == 1, _fmt("MMM d, yyyy"))
        .when(shape == 2, _fmt("yyyy-MM-dd"))
        .when(shape == 3, _fmt("MM/dd/yyyy"))
        .when(shape == 4, F.concat(D.ordinal(F.dayofmonth(dt())), _fmt(" MMMM yyyy")))
        .otherwise(_fmt("M-d-yyyy"))
    )
    return _orders(spark, d).select("o_orderkey", F.date_format(D.parse_date(text), "yyyy-MM-dd").alias("day"))


@query(
    "day_month_order",
    """SELECT o_orderkey, CASE WHEN day(o_orderdate) > 12 THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE printf('%04d-%02d-%02d', year(o_orderdate), day(o_orderdate), month(o_orderdate)) END AS day FROM orders""",
)
def day_month_order(spark, d):
    """Day-first numbers: read month first unless that is impossible."""
    return _orders(spark, d).select(
        "o_orderkey", F.date_format(D.parse_date(_fmt("dd/MM/yyyy")), "yyyy-MM-dd").alias("day")
    )


@query("two_digit_years", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def two_digit_years(spark, d):
    day = D.parse_date(_fmt("MM/dd/yy"), F.lit(2000))
    return _orders(spark, d).select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"))


@query(
    "last_full_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def last_full_date(spark, d):
    next_day = F.date_format(F.date_add(dt(), 1), "d MMM yyyy")
    tail = F.when(c("o_orderstatus") == "F", F.concat(F.lit(" or "), next_day)).otherwise(" or 31 February 2001")
    text = F.concat(F.lit("valid 1 May 1995, "), _fmt("yyyy-MM-dd"), tail)
    return _orders(spark, d).select("o_orderkey", F.date_format(D.last_full_date(text), "yyyy-MM-dd").alias("day"))


@query("filename_dates", "SELECT o_orderkey, strftime(o_orderdate + INTERVAL 40 YEAR, '%Y-%m-%d') AS day FROM orders")
def filename_dates(spark, d):
    shape = F.pmod(F.hash("o_orderkey"), F.lit(5))
    stem = F.concat(
        F.lit("statement "),
        F.when(shape == 0, _fmt("yyyy-MM-dd"))
        .when(shape == 1, _fmt("yyyyMMdd"))
        .when(shape == 2, _fmt("MM.dd.yyyy"))
        .when(shape == 3, _fmt("MMM-dd-yyyy"))
        .otherwise(_fmt("d MMMM yyyy")),
        F.lit(" v7"),
    )
    moved = _orders(spark, d).withColumn("o_orderdate", F.expr("o_orderdate + interval 40 years"))
    return moved.select("o_orderkey", F.date_format(D.stem_date(stem), "yyyy-MM-dd").alias("day"))


@query(
    "relaxed_filename_dates",
    """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 40 YEAR + CASE WHEN o_orderstatus = 'O' THEN INTERVAL 0 DAY ELSE INTERVAL 2 DAY END, '%Y-%m-%d') AS day FROM orders""",
)
def relaxed_filename_dates(spark, d):
    """Of two dates in a name, the one that starts last; a stamped tail goes first."""
    later = F.date_add(dt(), 2)
    stem = F.when(
        c("o_orderstatus") == "O", F.concat(F.lit("x 20010203 "), _fmt("yyyy_MM_dd"), F.lit("T10_11_12.345Z"))
    ).otherwise(F.concat(_fmt("yyyy-MM-dd"), F.lit(" to "), F.date_format(later, "d MMM yyyy"), F.lit(" final")))
    moved = _orders(spark, d).withColumn("o_orderdate", F.expr("o_orderdate + interval 40 years"))
    return moved.select("o_orderkey", F.date_format(D.relaxed_stem_date(stem), "yyyy-MM-dd").alias("day"))


@query(
    "folder_dates",
    """SELECT o_orderkey, CAST(year(o_orderdate) + 40 AS BIGINT) AS near_year,
      strftime(date_trunc('month', o_orderdate + INTERVAL 40 YEAR), '%Y-%m-%d') AS month_day,
      strftime(o_orderdate + INTERVAL 40 YEAR, '%Y-%m-%d') AS stem_day,
      strftime(o_orderdate + INTERVAL 40 YEAR, '%Y-%m-%d') AS folder_day FROM orders""",
)
def folder_dates(spark, d):
    moved = _orders(spark, d).withColumn("o_orderdate", F.expr("o_orderdate + interval 40 years"))
    parents = F.array(F.lit("reports"), _fmt("MMMM yyyy"), _fmt("yyyy-M-d"), F.lit("2001"))
    return moved.select(
        "o_orderkey",
        D.folder_year(parents).cast("bigint").alias("near_year"),
        F.date_format(D.folder_month(parents), "yyyy-MM-dd").alias("month_day"),
        F.date_format(D.day_month_in_year(_fmt("d MMMM"), D.folder_year(parents)), "yyyy-MM-dd").alias("stem_day"),
        F.date_format(D.folder_date(parents), "yyyy-MM-dd").alias("folder_day"),
    )


@query("meta_years", "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y FROM orders")
def meta_years(spark, d):
    return _orders(spark, d).select(
        "o_orderkey", D.meta_year(F.concat(F.lit("D:"), _fmt("yyyyMMddHHmmss"))).cast("bigint").alias("y")
    )


@query(
    "first_named_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def first_named_date(spark, d):
    text = F.concat(F.lit("Published "), _fmt("MMMM d, yyyy"), F.lit(" and again on 5 May 2005"))
    return _orders(spark, d).select("o_orderkey", F.date_format(D.first_named_date(text), "yyyy-MM-dd").alias("day"))


@query(
    "date_precedence",
    """WITH o AS (SELECT o_orderkey, o_orderstatus AS s, left(o_orderpriority, 1) AS p, o_orderdate + INTERVAL 40 YEAR AS d FROM orders)
    SELECT o_orderkey,
      CASE WHEN p = '1' THEN 'footer' WHEN p = '2' THEN 'title/subtitle' WHEN p = '3' THEN 'page'
           WHEN s = 'O' THEN 'folder' ELSE 'filename' END AS source,
      CASE WHEN p IN ('1', '2') OR (p > '3' AND s = 'O') THEN 'month' ELSE 'day' END AS precision,
      strftime(CASE WHEN p IN ('1', '2') OR (p > '3' AND s = 'O') THEN date_trunc('month', d) ELSE d END, '%Y-%m-%d') AS day
    FROM o""",
)
def date_precedence(spark, d):
    """Dates in footer, title, page, folder and file name; the first in order wins."""
    moved = _orders(spark, d).withColumn("o_orderdate", F.expr("o_orderdate + interval 40 years"))
    p = F.substring("o_orderpriority", 1, 1)
    null = F.lit(None).cast("string")
    facts = moved.select(
        "o_orderkey",
        F.concat(F.lit("orders "), _fmt("yyyyMMdd")).alias("stem"),
        F.array(F.when(c("o_orderstatus") == "O", _fmt("MMMM yyyy")).otherwise("misc")).alias("parents"),
        F.when(p == "1", F.concat(F.lit("as of "), _fmt("MMM yyyy"))).alias("footer"),
        F.when(p == "2", F.concat(F.lit("Factsheet "), _fmt("MMMM yyyy"))).alias("title"),
        F.when(p == "3", F.concat(F.lit("Signed on "), _fmt("d MMMM yyyy"))).alias("page_text"),
    )
    r = facts.select(
        "o_orderkey",
        D.stronger_date(
            c("stem"),
            D.resolve_document_date(c("stem"), c("parents"), c("footer"), c("title"), null, null, c("page_text")),
        ).alias("r"),
    )
    return r.select("o_orderkey", "r.source", "r.precision", F.date_format("r.date", "yyyy-MM-dd").alias("day"))


@query(
    "latest_dated_order",
    """SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS day,
         max(o_orderkey) FILTER (WHERE o_orderdate = m) AS o_orderkey
    FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) GROUP BY o_custkey""",
)
def latest_dated_order(spark, d):
    """Strongest entry per key: latest date, then highest key."""
    best = strongest_source(_orders(spark, d), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return best.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey")
