"""Helpers shared by the operators: tables, shared folders, checked broadcasts, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lookup tables up to this many rows are broadcast; larger ones are joined by key.
BROADCAST_ROWS = 20_000
#: Sets of ids up to this size are sent to all executors to pick rows; larger ones are joined by key.
PICKED_IDS = 200_000
#: Largest Arrow batch that an operator gives back, in bytes of payload.
BATCH_BYTES = 8 << 20
#: Columns of the ``documents`` table.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, as in tests, the folder set on the context or else the
    warehouse is taken; both are shared as well.
    """
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    )


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(left: DataFrame, right: DataFrame, on: Column, rows: int, how: str = "inner") -> DataFrame:
    """Join with a lookup of ``rows`` counted rows: broadcast up to ``BROADCAST_ROWS``, else by key.

    Beyond that bound the join shuffles by key and adaptive execution splits its
    skewed partitions.
    """
    return left.join(F.broadcast(right) if rows <= BROADCAST_ROWS else right, on, how)


def pick(df: DataFrame, ids: DataFrame, how: str, column: str = "doc_id") -> DataFrame:
    """Semi or anti join with the ids in ``ids``: rows with texts stay where they are if the ids are few enough to send."""
    ids = ids.select(column)
    return df.join(F.broadcast(ids) if ids.count() <= PICKED_IDS else ids, column, how)


def uniform(*cols: Column) -> Column:
    """A number in (0, 1) that depends on the values alone; the same in SQL by its MD5 digest."""
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def slices(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts stay near ``limit`` bytes together; one text is never cut."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
