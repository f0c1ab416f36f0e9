"""Queries that run as streams until their input is used up."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foliograph.plans.catalogue.pages import as_pages, window_chunks
from foliograph.plans.registry import ORACLE, query
from foliograph.session import checkpoint_dir
from foliograph.sources.sinks import manifest, write_page_batches, written_pages
from foliograph.streaming.ingest import finished, stream_table
from foliograph.streaming.stitch import keep_state_in_rocksdb, stitch_stream
from foliograph.streaming.windows import sessions, windows

c = F.col


@query("stream_stitch", ORACLE["page_stitch"])
def stream_stitch(spark, d):
    """Turns stitched by a stateful stream; the rows are those of "page_stitch"."""
    keep_state_in_rocksdb(spark)
    turns = stream_table(spark, d, "conversations").withColumn("arrived", c("_metadata.file_modification_time"))
    pages = window_chunks(as_pages(turns, "arrived"), "arrived")
    done = finished(stitch_stream(pages), "stream-stitch")
    return done.select("source", "page", F.get("chunks", F.lit(0))["text"].alias("text"), "stitched")


def event_stream(spark, d):
    events = stream_table(spark, d, "events")
    cents = F.round(c("value") * 100).cast("long").alias("cents")
    return events.select("event_id", c("ts").cast("timestamp").alias("ts"), "user_id", "event_type", cents)


def measures():
    return [F.count("*").alias("n_events"), F.sum("cents").alias("cents")]


@query(
    "stream_sessions",
    """WITH e AS (SELECT user_id, ts, CAST(round(value * 100) AS BIGINT) AS cents, max(ts) OVER () AS latest,
        lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL),
    s AS (SELECT *, count(CASE WHEN before IS NULL OR ts > before + INTERVAL 6 HOUR THEN 1 END) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e)
    SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts) + INTERVAL 6 HOUR) AS session_end,
        count(*) AS n_events, CAST(sum(cents) AS BIGINT) AS cents
    FROM s GROUP BY user_id, k HAVING max(ts) + INTERVAL 6 HOUR <= any_value(latest) - INTERVAL 1 HOUR""",
)
def stream_sessions(spark, d):
    """Each user's sessions, ended by six hours without an event, an hour behind the latest event."""
    found = finished(sessions(event_stream(spark, d), "user_id", "6 hours", "1 hour", measures()), "stream-sessions")
    return found.withColumns({n: F.unix_micros(n) for n in ("session_start", "session_end")})


@query(
    "stream_windows",
    """WITH e AS (SELECT event_type, ts, CAST(round(value * 100) AS BIGINT) AS cents, max(ts) OVER () AS latest FROM events WHERE ts IS NOT NULL),
    w AS (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * unnest([0, 1]) AS b FROM e)
    SELECT event_type, epoch_us(b) AS window_start, epoch_us(b + INTERVAL 1 HOUR) AS window_end, count(*) AS n_events, CAST(sum(cents) AS BIGINT) AS cents
    FROM w GROUP BY event_type, b HAVING b + INTERVAL 1 HOUR <= any_value(latest) - INTERVAL 1 HOUR""",
)
def stream_windows(spark, d):
    """Events of each type in windows of an hour, one every half hour, an hour behind the latest event."""
    found = finished(windows(event_stream(spark, d), ["event_type"], "1 hour", "1 hour", measures(), step="30 minutes"), "stream-windows")
    return found.withColumns({n: F.unix_micros(n) for n in ("window_start", "window_end")})


@query(
    "stream_manifest",
    """SELECT 'conv_' || conv_id AS source, CASE WHEN conv_id % 2 = 0 THEN 'even' ELSE 'odd' END AS provider,
        CAST(max(turn) + 1 AS INTEGER) AS total_pages, count(*) AS done_pages,
        CASE WHEN count(*) = max(turn) + 1 THEN 'complete' ELSE 'partial' END AS status
    FROM conversations WHERE turn % 7 <> 5 GROUP BY conv_id""",
)
def stream_manifest(spark, d):
    """What two runs with a provider each have written of the conversations, whose sixth turns are missing."""
    turns, found = stream_table(spark, d, "conversations").where("turn % 7 <> 5"), None
    for part, provider in enumerate(("even", "odd")):
        pages = as_pages(turns.where(c("conv_id") % 2 == part))
        folder = f"{checkpoint_dir(spark).rstrip('/')}/stream-manifest-{uuid.uuid4().hex}"
        write_page_batches(pages, folder, f"{folder}/progress", provider).awaitTermination()
        seen = manifest(written_pages(spark, folder, pages.schema))
        found = seen if found is None else found.unionByName(seen)
    return found
