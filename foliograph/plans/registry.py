"""Query registry: each query with the SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph import constants as K
from foliograph.functions.text import nonblank_lines
from foliograph.session import reach_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL counterpart if there is one."""

    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reach_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table for heavy per-row work, on all cores.

    Large inputs come in more splits than there are cores and stay as they are;
    only an input with fewer splits is dealt out.
    """
    df = table(spark, sf_dir, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-blank stripped lines of the documents with their 1-based number."""
    return wide_table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", F.posexplode(nonblank_lines(F.col("text"))).alias("p", "line")
    ).select("doc_id", (F.col("p") + 1).cast("bigint").alias("line_no"), "line")


def text_array(x: Column, sep: str = " | ") -> Column:
    return F.array_join(F.transform(x, lambda v: F.coalesce(v, F.lit("<null>"))), sep)


# --- SQL building blocks ------------------------------------------------------
WS = f"[{K.SPACE_CLASS}]"
NOT_WS = f"[^{K.SPACE_CLASS}]"
SPACES = K.SPACE_CHARS


def q_strip(x: str) -> str:
    return f"trim({x}, '{SPACES}')"


def q_words(x: str) -> str:
    return f"regexp_extract_all({x}, '{NOT_WS}+')"


def q_count(x: str) -> str:
    return f"len({q_words(x)})"


def q_norm(x: str) -> str:
    return rf"trim(regexp_replace(lower({x}), '[^0-9A-Za-z\-.%]+', ' ', 'g'))"


def q_tokens(x: str) -> str:
    return f"list_distinct(list_filter(list_transform({q_words(x)}, lambda w: {q_norm('w')}), lambda w: w <> ''))"


Q_LINES = f"""
raw_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS ln,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
lines AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS line_no, {q_strip('ln')} AS line
  FROM raw_lines WHERE {q_strip('ln')} <> '')"""


def q_clean(base: str, key: str, text: str, out: str = "cleaned") -> str:
    """CTEs that clean ``text`` of ``base`` line by line; ``out`` has key and c."""
    return rf"""
{out}_l AS (
  SELECT {key}, unnest(string_split({text}, chr(10))) AS ln,
         generate_subscripts(string_split({text}, chr(10)), 1) AS pos FROM {base}),
{out}_b AS (
  SELECT *, max(pos) OVER (PARTITION BY {key}) AS n,
         CASE WHEN ln <> '' AND ln = lag(ln) OVER (PARTITION BY {key} ORDER BY pos) THEN 0 ELSE 1 END AS brk
  FROM {out}_l),
{out}_r AS (SELECT *, sum(brk) OVER (PARTITION BY {key} ORDER BY pos) AS run FROM {out}_b),
{out}_k AS (
  SELECT {key}, pos, {q_strip('ln')} AS s, n, ln,
         row_number() OVER (PARTITION BY {key}, run ORDER BY pos) AS k FROM {out}_r),
{out}_j AS (
  SELECT {key}, string_agg(s, ' ' ORDER BY pos) AS j FROM {out}_k
  WHERE NOT (k % 2 = 0 AND pos < n AND ln <> '') AND s <> ''
    AND NOT regexp_full_match(s, '(?i)(?:{K.LONE_MARKERS}|page\s*\d+)')
    AND NOT regexp_full_match(s, '\p{{L}}{{1,2}}')
  GROUP BY {key}),
{out} AS (
  SELECT b.{key} AS {key},
    coalesce({q_strip(rf"regexp_replace(regexp_replace({q_strip(f"regexp_replace(j, '{WS}{{2,}}', ' ', 'g')")}, '{WS}+([.,;:!?])', '\1', 'g'), '([.,;:!?])({NOT_WS})', '\1 \2', 'g')")}, '') AS c
  FROM {base} b LEFT JOIN {out}_j j ON b.{key} = j.{key})"""


def q_trivial(x: str) -> str:
    """Condition for a trivial heading, spelled out on the list of its words."""
    toks = f"regexp_extract_all({x}, '[0-9A-Za-z]+')"
    stop = ", ".join(f"'{w}'" for w in K.STOPWORDS)
    small = f"len(list_filter({toks}, lambda w: lower(w) IN ({stop}) OR length(w) <= 3))"
    lower_all = f"len(list_filter({toks}, lambda w: w <> lower(w))) = 0"
    return f"""(CASE WHEN {q_strip(x)} = '' THEN true
      WHEN regexp_matches({x}, '[.!?]["'')\\]]?{WS}*$') THEN false
      WHEN len({toks}) = 0 THEN true WHEN len({toks}) > 5 THEN false
      WHEN regexp_matches({x}, '[0-9%₹$€:+/#]') THEN false
      ELSE {lower_all} OR {small} * 1.0 / len({toks}) >= 0.6
           OR length(array_to_string({toks}, '')) * 1.0 / len({toks}) <= 6 END)"""
