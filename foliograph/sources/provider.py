"""Extraction providers: the only place that talks to a model."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph import constants as K
from foliograph.functions.jsonx import (
    json_candidates,
    mend_json,
    mend_literal,
    merge_page_objects,
    unwrap_single,
)
from foliograph.functions.text import approx_tokens, strip_fences


class Provider(Protocol):
    """One call: image bytes and prompt in, text and token counts out."""

    def label(self) -> str: ...

    def extract(self, image: bytes, mime: str, prompt: str) -> tuple[str, int | None, int | None]: ...


REPLY = "reply string, input_tokens bigint, output_tokens bigint, attempts int, failure string"


def call_provider(
    pages: DataFrame,
    make: Callable[[], Provider],
    prompt: str,
    attempts: int = K.MAX_ATTEMPTS,
    base_wait: float = K.RETRY_BASE_SECONDS,
) -> DataFrame:
    """Call the provider once per page, with retries and growing waits.

    ``pages`` has source, page, image and mime. A page that keeps failing gets
    a ``failure`` text, not a failed task. Images do not leave the task.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()

        def ask(image: bytes | None, mime: str) -> tuple:
            if not image:
                return None, 0, 0, 0, "no_image_bytes"
            for n in range(1, attempts + 1):
                try:
                    return (*provider.extract(bytes(image), mime, prompt), n, None)
                except Exception as e:  # any provider error is retried, then recorded
                    error = str(e)
                    if n < attempts:
                        time.sleep(base_wait * 2 ** (n - 1))
            return None, 0, 0, attempts, f"invoke_failed: {error}"

        for pdf in batches:
            got = [ask(i, m) for i, m in zip(pdf["image"], pdf["mime"])]
            out = pd.DataFrame(got, columns=["reply", "input_tokens", "output_tokens", "attempts", "failure"])
            yield pd.concat([pdf[["source", "page"]].reset_index(drop=True), out], axis=1)

    return pages.select("source", "page", "image", "mime").mapInPandas(work, f"source string, page int, {REPLY}")


def replay(pages: DataFrame, replies: DataFrame) -> DataFrame:
    """Stored replies in place of calls: a join on (source, page)."""
    return pages.select("source", "page").join(
        replies.select("source", "page", "reply", "input_tokens", "output_tokens"), ["source", "page"], "left"
    ).select(
        "source", "page", "reply", "input_tokens", "output_tokens",
        F.lit(1).alias("attempts"),
        F.when(F.col("reply").isNull(), "no_image_bytes").alias("failure"),
    )


def read_replies(replies: DataFrame) -> DataFrame:
    """Page objects from reply texts, with a status per page.

    Status is ``ok``, ``no_tables_or_charts``, ``json_parse_failed`` or the
    failure of the call. Provider token counts and estimates are both kept.
    """
    cut = replies.withColumn("__text", strip_fences(F.col("reply")))
    # a text that is JSON as it stands goes to Python as a null
    broken = F.when(F.try_parse_json("__text").isNull(), F.col("__text"))
    cut = cut.withColumn("__parts", json_candidates(broken))
    parts = cut.withColumn("__parts", F.when(F.size("__parts") > 0, F.col("__parts")).otherwise(F.array("__text")))
    mended = F.transform("__parts", mend_json)
    known = parts.withColumn("__json", mended)
    # Literals need Python, so they are tried once, on the whole text.
    whole = known.withColumn(
        "__whole", mend_literal(F.col("__text"), F.get(F.array_compact("__json"), F.lit(0)))
    )
    objects = F.array_compact(
        F.transform(
            F.when(F.size(F.array_compact("__json")) > 0, F.array_compact("__json")).otherwise(F.array("__whole")),
            unwrap_single,
        )
    )
    merged = whole.withColumn("__objects", objects).withColumn("__page", merge_page_objects(F.col("__objects")))
    empty = (F.size("__page.tables") == 0) & (F.size("__page.charts") == 0)
    status = (
        F.when(F.col("failure").isNotNull(), F.regexp_extract("failure", "^[a-z_]+", 0))
        .when(F.size("__objects") == 0, "json_parse_failed")
        .when(empty, "no_tables_or_charts")
        .otherwise("ok")
    )
    body = F.to_json(
        F.struct("__page.title", "__page.subtitle", "__page.narrative_text"), {"ignoreNullFields": "false"}
    )
    lists = [F.concat(F.lit(f'"{n}":['), F.array_join(f"__page.{n}", ","), F.lit("]")) for n in ("tables", "charts")]
    return merged.select(
        "source",
        "page",
        status.alias("status"),
        F.concat(F.regexp_replace(body, r"\}$", ","), F.concat_ws(",", *lists), F.lit("}")).alias("json"),
        "input_tokens",
        "output_tokens",
        F.when(empty, 0).otherwise(approx_tokens(F.concat(F.lit("{"), F.concat_ws(", ", *lists), F.lit("}")))).alias("estimated_output_tokens"),
        "attempts",
    )


def padded_prompt(prompt: str, appendix: str = "", target_tokens: int = 1200) -> str:
    """The prompt and its appendix, filled up with comment lines to four characters a target token."""
    text = "\n\n".join(part.strip() for part in (prompt, appendix) if part.strip())
    line = "\n# (left blank)"
    return text + line * max(0, -(-(4 * target_tokens - len(text)) // len(line)))
