"""The library's functions under SQL names, for sessions that work in SQL text.

Scalar and table functions are SQL functions, which Spark puts into the plan as
expressions; only the cutting of JSON out of prose is a Python table function.
All are temporary: they belong to the session that registers them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from foliograph.functions.jsonx import balanced_spans
from foliograph.session import reach_package

#: Names and definitions; a null text counts as an empty one, and white space is that of Unicode.
FUNCTIONS = {
    "normal_newlines": r"(t STRING) RETURNS STRING RETURN regexp_replace(coalesce(t, ''), '\r\n?', '\n')",
    "squeezed": r"(t STRING) RETURNS STRING RETURN regexp_replace(t, '(?U)\\s{2,}', ' ')",
    "n_words": r"(t STRING) RETURNS INT RETURN coalesce(regexp_count(t, '(?U)\\S+'), 0)",
    "n_tokens": "(t STRING) RETURNS INT RETURN CASE WHEN length(coalesce(t, '')) = 0 THEN 0 ELSE greatest(1, CAST(floor(length(t) / 4) AS INT)) END",
    "normal_token": r"(t STRING) RETURNS STRING RETURN trim(regexp_replace(lower(coalesce(t, '')), '[^0-9A-Za-z\\-.%]+', ' '))",
    "word_windows": r"""(t STRING, wide INT) RETURNS TABLE (seq INT, n INT, part STRING)
        RETURN SELECT at + 1, size(w), array_join(w, ' ') FROM (
          SELECT posexplode(transform(
            sequence(0, greatest(size(regexp_extract_all(coalesce(t, ''), '(?U)\\S+', 0)) - 1, 0) DIV wide),
            k -> slice(regexp_extract_all(coalesce(t, ''), '(?U)\\S+', 0), k * wide + 1, wide))) AS (at, w))
        WHERE size(w) > 0""",
}


@udtf(returnType="position int, candidate string")
class JsonCandidates:
    """Outermost bracketed parts of a text, in order; none of a null text."""

    def eval(self, text: str) -> Iterator[tuple[int, str]]:
        yield from enumerate(balanced_spans(text or ""), 1)


def register(spark: SparkSession) -> list[str]:
    """Register all functions in the session; gives their names."""
    reach_package(spark)
    for name, definition in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {definition}")
    spark.udtf.register("json_parts", JsonCandidates)
    return [*FUNCTIONS, "json_parts"]
