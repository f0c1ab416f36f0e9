"""Token, cost and status reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph import constants as K


def token_summary(calls: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Total, smallest, largest and mean tokens per direction; zeros without calls."""
    aggs = []
    for name in ("input", "output"):
        c = F.col(f"{name}_tokens")
        aggs += [
            F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"{name}_total"),
            F.coalesce(F.min(c), F.lit(0)).cast("bigint").alias(f"{name}_min"),
            F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(f"{name}_max"),
            F.bround(F.coalesce(F.avg(c), F.lit(0.0)), 2).alias(f"{name}_avg"),
        ]
    return calls.groupBy(*(keys or [])).agg(F.count(F.lit(1)).alias("calls"), *aggs)


def cost(input_tokens: Column, output_tokens: Column, price_in: Column, price_out: Column) -> Column:
    """Price per thousand tokens, exact in decimals."""
    d = "decimal(20,6)"
    return (
        input_tokens.cast(d) * price_in.cast("decimal(12,6)") + output_tokens.cast(d) * price_out.cast("decimal(12,6)")
    ) / F.lit(1000)


def usage_report(calls: DataFrame, dims: list[str], price_in: float = 0.0, price_out: float = 0.0) -> DataFrame:
    """Usage by ``dims`` with running totals over them, priced."""
    rolled = calls.rollup(*dims).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("input_tokens").alias("input_total"),
        F.sum("output_tokens").alias("output_total"),
    )
    return rolled.withColumn(
        "cost", cost(F.col("input_total"), F.col("output_total"), F.lit(price_in), F.lit(price_out))
    )


def image_tokens(width: Column, height: Column, divisor: int = K.IMAGE_TOKEN_DIVISOR) -> Column:
    return F.bround(width.cast("bigint") * height.cast("bigint") / divisor).cast("bigint")


def mean_call_tokens(prompt_tokens: Column, mean_image_tokens: Column) -> Column:
    return F.greatest(F.lit(800), F.floor(prompt_tokens + mean_image_tokens).cast("int"))


def safe_concurrency(mean_tokens: Column, rpm: int = 700, tpm: int = 700_000, latency: float = 5.0, most: int = 32) -> Column:
    """Calls in flight that keep requests and tokens per minute under their limits."""
    per_minute = F.greatest(F.lit(1), F.floor(F.lit(tpm) / F.greatest(F.lit(1), mean_tokens)))
    by_tokens = F.floor(per_minute * latency / 60).cast("int")
    return F.greatest(F.lit(2), F.least(by_tokens, F.lit(int(rpm * latency // 60)), F.lit(most)))


def page_status(pages: DataFrame, calls: DataFrame | None = None) -> DataFrame:
    """Pages done per source; the first step of a resume."""
    return pages.groupBy("source").agg(F.count(F.lit(1)).alias("pages_done"), F.max("page").alias("last_page"))


def provider_key(label: Column) -> Column:
    """Short provider name from a label: a known vendor, else its first word."""
    low = F.lower(F.coalesce(label, F.lit("")))
    word = F.regexp_replace(F.get(F.split(F.trim(low), r"\s+"), F.lit(0)), "[^a-zA-Z0-9]+", "")
    return (
        F.when(low.contains("gemini"), "Gemini")
        .when(low.contains("openai"), "OpenAI")
        .when(low.contains("claude") | low.contains("bedrock"), "Claude")
        .when(word != "", word)
        .otherwise("LLM")
    )
