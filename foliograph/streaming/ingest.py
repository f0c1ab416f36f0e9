"""Page files and page tables as streams.

Chunking a page needs nothing but the page, so it runs on a stream without
state. Stitching needs page order: ``streaming.stitch`` keeps it as state,
``operators.stitch`` reads the finished table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliograph.operators.blocks import page_blocks
from foliograph.operators.chunks import chunk_pages
from foliograph.plans.pipeline import NO_DATE
from foliograph.session import checkpoint_dir
from foliograph.sources.pages import page_source, typed_pages


def stream_page_json(spark: SparkSession, root: str) -> DataFrame:
    """New page files below ``root`` as (source, page, json)."""
    path = F.url_decode(F.col("_metadata.file_path"))
    return (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .load(root)
        .select(path.alias("path"), F.col("value").alias("json"))
        .select(
            page_source(F.col("path"), root).alias("source"),
            F.regexp_extract("path", r"page_(\d+)\.json$", 1).try_cast("int").alias("page"),
            "json",
        )
        .where(F.col("page").isNotNull())
    )


def chunk_stream(pages: DataFrame, cap: int = 0) -> DataFrame:
    """Chunks per page of a stream of page JSON. Titles do not carry across pages here."""
    typed = typed_pages(pages)
    ready = typed.select(
        "source", "page", F.col("title").alias("page_title"), F.col("subtitle").alias("page_subtitle"),
        *[F.lit(None).cast(t).alias(n) for n, t in NO_DATE.items()],
        page_blocks(F.col("tables"), F.col("charts"), F.col("sections"), F.col("page")).alias("blocks"),
    )
    return chunk_pages(ready, cap)


def write_stream(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished pages to a parquet table until the input is used up."""
    return (
        pages.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table as a stream of its files."""
    path = f"{sf_dir}/{name}.parquet"
    # a pattern, since streams of files take no single file
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path.replace(f"{name[-1]}.parquet", f"[{name[-1]}].parquet"))


def finished(stream: DataFrame, label: str) -> DataFrame:
    """What a stream gives out until its input is used up, written to the shared folder and read back."""
    spark = stream.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    write_stream(stream, f"{folder}/rows", f"{folder}/progress").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
