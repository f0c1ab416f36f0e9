"""Chunk tables and JSON output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType


def chunk_json() -> Column:
    """A chunk as ``{id, type, text, meta}`` text; null metadata is left out."""
    meta = F.struct(
        "source", "page", "published_date", "published_date_source", "published_month",
        F.when(F.col("overflow_consolidated"), True).alias("overflow_consolidated"), "overflow_count",
    )
    return F.to_json(F.struct("id", "type", "text", meta.alias("meta")))


def ordered(chunks: DataFrame) -> DataFrame:
    """Chunks ranged by source, page and seq, so one big source spans many files."""
    return chunks.repartitionByRange("source", "page", "seq").sortWithinPartitions("source", "page", "seq")


def write_chunks(chunks: DataFrame, path: str, provider: str = "default", mode: str = "overwrite") -> None:
    """Chunk table in parquet, one folder per provider."""
    ordered(chunks).withColumn("provider", F.lit(provider)).write.mode(mode).partitionBy("provider").parquet(path)


def write_chunk_json(chunks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines in one folder per source; the files of a folder are in page order."""
    ordered(chunks).select("source", chunk_json().alias("value")).write.mode(mode).partitionBy("source").text(path)


def write_pages(pages: DataFrame, path: str, mode: str = "append") -> None:
    """Finished pages, the record a later run resumes from."""
    pages.write.mode(mode).parquet(path)


def remaining_pages(pages: DataFrame, done: DataFrame) -> DataFrame:
    """Pages that no earlier run finished."""
    return pages.join(done.select("source", "page").distinct(), ["source", "page"], "left_anti")


def write_page_batches(pages: DataFrame, path: str, progress: str, provider: str = "default") -> StreamingQuery:
    """Write a stream of pages with (source, page) until its input is used up; each page is written once.

    A micro-batch has a folder of its own, named by the batch id, and replaces
    what lies there. So a batch that is run again, after a stop in the middle,
    changes nothing: it leaves out pages of earlier batches only. Pages that come
    twice in a batch are written once, and rows without source or page not at all.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        known = batch.where(F.col("source").isNotNull() & F.col("page").isNotNull()).dropDuplicates(["source", "page"])
        if batch_id:
            done = batch.sparkSession.read.schema("source string, page int, batch long").parquet(f"{path}/pages")
            known = remaining_pages(known, done.where(F.col("batch") < batch_id))
        known.withColumn("provider", F.lit(provider)).write.mode("overwrite").parquet(f"{path}/pages/batch={batch_id}")

    return (
        pages.writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).outputMode("append").start()
    )


def written_pages(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The pages that ``write_page_batches`` has written, with their provider and batch."""
    full = StructType([*schema.fields, StructField("provider", StringType()), StructField("batch", LongType())])
    return spark.read.schema(full).parquet(f"{path}/pages")


def manifest(pages: DataFrame) -> DataFrame:
    """What is there of each source: (source, provider, total_pages, done_pages, status), counted from page one.

    ``total_pages`` is the last page seen; ``status`` is "complete" if no page up to it is missing, else "partial".
    """
    seen = pages.groupBy("source", "provider").agg(F.max("page").cast("int").alias("total_pages"), F.count("*").alias("done_pages"))
    return seen.withColumn("status", F.when(F.col("done_pages") == F.col("total_pages"), "complete").otherwise("partial"))
