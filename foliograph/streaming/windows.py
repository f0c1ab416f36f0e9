"""Event-time windows of a stream: duplicates, sessions and fixed windows behind a watermark.

The watermark runs ``delay`` behind the latest event seen. Results are final: a
window or session is given out once, when the watermark has passed its end; until
then it is state. An event that comes when the watermark has passed it is late and
left out, as its window may be out already; an event that repeats an id within
the delay is left out too. An event without a time or key takes no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_events(events: DataFrame, ts: str, event_id: str, delay: str) -> DataFrame:
    """Events with a time and an id, each id once within the delay."""
    known = events.where(F.col(ts).isNotNull() & F.col(event_id).isNotNull())
    return known.withWatermark(ts, delay).dropDuplicatesWithinWatermark([event_id])


def sessions(events: DataFrame, key: str, gap: str, delay: str, measures: list[Column], ts: str = "ts", event_id: str = "event_id") -> DataFrame:
    """(key, session_start, session_end, measures): events of a key that follow each other within ``gap``."""
    kept = unique_events(events, ts, event_id, delay).where(F.col(key).isNotNull())
    found = kept.groupBy(key, F.session_window(ts, gap).alias("session")).agg(*measures)
    return found.select(key, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), *found.columns[2:])


def windows(events: DataFrame, keys: list[str], width: str, delay: str, measures: list[Column], ts: str = "ts", event_id: str = "event_id", step: str | None = None) -> DataFrame:
    """(keys, window_start, window_end, measures) of windows of ``width``, one every ``step``."""
    kept = unique_events(events, ts, event_id, delay)
    found = kept.groupBy(*keys, F.window(ts, width, step).alias("span")).agg(*measures)
    return found.select(*keys, F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), *found.columns[len(keys) + 1 :])
