"""Queries written as SQL text over the registered functions."""

from __future__ import annotations

from foliograph.plans.catalogue import pages, text  # noqa: F401  their SQL is used again
from foliograph.plans.registry import ORACLE, q_count, query, wide_table
from foliograph.plans.sql import register


def run_sql(spark, d, text, **tables):
    """SQL text over whole tables, handed over by name."""
    register(spark)
    return spark.sql(text, **{name: wide_table(spark, d, name, *columns) for name, columns in tables.items()})


@query("sql_word_windows", ORACLE["word_window_chunks"])
def sql_word_windows(spark, d):
    return run_sql(
        spark, d,
        "SELECT doc_id, CAST(seq AS BIGINT) AS seq, CAST(n AS BIGINT) AS n_words, part AS text FROM {documents}, LATERAL word_windows(text, 180)",
        documents=("doc_id", "text"),
    )


@query("sql_json_parts", ORACLE["json_candidates"])
def sql_json_parts(spark, d):
    return run_sql(
        spark, d,
        """SELECT event_id, position, candidate FROM {events},
        LATERAL json_parts('Sure: ' || props || ' then [' || event_id || ', "a ] b"] done.')""",
        events=("event_id", "props"),
    )


@query(
    "sql_text_facts",
    f"""SELECT source, lang, CAST(sum({q_count('text')}) AS BIGINT) AS n_words,
    CAST(sum(CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END) AS BIGINT) AS n_tokens,
    CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY source, lang""",
)
def sql_text_facts(spark, d):
    return run_sql(
        spark, d,
        """SELECT source, lang, sum(n_words(text)) AS n_words, sum(n_tokens(text)) AS n_tokens, sum(length(normal_newlines(text))) AS n_chars
        FROM {documents} GROUP BY source, lang""",
        documents=("source", "lang", "text"),
    )
