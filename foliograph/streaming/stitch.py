"""Stitching pages of a stream, in whatever order they arrive.

Each source has its own state: the page that comes next, the text that the page
before it hands on, and pages that came early. A page that comes in its turn is
given out at once, with all waiting pages that follow it without a gap. A gap
is waited for until pages arrive, of any source, that are ``wait`` younger than
the first page that waits; then the source goes on behind it, and the page behind
it receives no text, as in a table that lacks the missing pages.

The heavy rules (prefixes, sentence ends, overflow) are column functions on the
stream before the state; the state joins two texts. Its size is that of the
pages that wait, and one text a source.

Defined cases: a page that comes again is left out; a page of a gap that was
given up is given out without stitching when it comes after all; pages before
``first_page`` and rows with a null source, page or time are left out. ``arrived``
is the time of arrival, so it grows from batch to batch; a page that is ``delay``
older than the latest page of earlier batches is late for the stream and left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from foliograph.functions.text import ends_sentence, looks_like_overflow, rstrip, strip_prefix_head
from foliograph.schema import CHUNK

FACTS = "body string, own boolean, tail string, soft boolean, payload string, at long"
OUT = "source string, page int, head string, stitched boolean, payload string"
_SENTENCE, _MARK = re.compile(r"[.!?…]\Z"), re.compile(r"[,.;:!?)\]}]")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def joined(before: str, text: str) -> str:
    """Two texts, with a space unless a sentence ends or punctuation follows; either may be empty."""
    gap = "" if not before or not text or _SENTENCE.search(before) or _MARK.match(text) else " "
    return before + gap + text


class Stitcher(StatefulProcessor):
    """The state of one source and what it does with a page."""

    def __init__(self, first_page: int, wait_ms: int):
        self.first_page, self.wait_ms = first_page, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "next int, follows boolean, on boolean, text string")
        self.waiting = handle.getMapState("waiting", "page int", FACTS)
        self.given_up = handle.getMapState("given_up", "first int", "last int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        spot = self._spot()
        for row in rows:
            if row.page < spot[0]:
                if self._was_given_up(row.page):
                    yield Row(source=key[0], page=row.page, head=None, stitched=False, payload=row.payload)
            elif not self.waiting.containsKey((row.page,)):
                self.waiting.updateValue((row.page,), (row.body, row.own, row.tail, row.soft, row.payload, row.at))
        yield from self._go_on(key[0], spot)
        self._set_timer()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        spot = self._spot()
        early = min((p[0] for p in self.waiting.keys()), default=None)
        if early is not None:
            self.given_up.updateValue((spot[0],), (early - 1,))
            yield from self._go_on(key[0], (early, False, False, None))
        self._set_timer()

    def close(self) -> None:
        pass

    def _spot(self) -> tuple:
        return tuple(self.place.get()) if self.place.exists() else (self.first_page, False, False, None)

    def _go_on(self, source: str, spot: tuple) -> Iterator[Row]:
        """Give out waiting pages as long as the next one is there."""
        page, follows, on, text = spot
        while self.waiting.containsKey((page,)):
            body, own, tail, soft, payload, _ = self.waiting.getValue((page,))
            self.waiting.removeKey((page,))
            receives = follows and on and body is not None
            head = joined(text, body) if receives else None
            yield Row(source=source, page=page, head=head, stitched=receives, payload=payload)
            if soft and follows:  # a page that only passes text on keeps the state of the page before it
                on, text = (True, head) if receives else (own, tail)
            else:
                on, text = own, tail
            page, follows = page + 1, True
        self.place.update((page, follows, on, text if on else None))

    def _set_timer(self) -> None:
        """One timer, for the page that has waited longest."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        first = min((v[5] for v in self.waiting.values()), default=None)
        if first is not None:
            self.handle.registerTimer(first + self.wait_ms)

    def _was_given_up(self, page: int) -> bool:
        """Whether the page lies in a gap that was given up; it is taken out of it."""
        for (first,), (last,) in list(self.given_up.iterator()):
            if first <= page <= last:
                self.given_up.removeKey((first,))
                for a, b in ((first, page - 1), (page + 1, last)):
                    if a <= b:
                        self.given_up.updateValue((a,), (b,))
                return True
        return False


def stitch_stream(pages: DataFrame, first_page: int = 1, wait_ms: int = 600_000, delay: str = "1 minute") -> DataFrame:
    """Pages (source, page, chunks, arrived) of a stream with ``stitched``, the first chunk stitched where text runs on.

    The rows are those of ``operators.stitch.stitch_pages`` over the pages that
    have been given out. The session must keep state in RocksDB
    (``keep_state_in_rocksdb``).
    """
    head, tail = F.get("chunks", F.lit(0)), F.try_element_at("chunks", F.lit(-1))
    body = F.when(head["type"] == "text", strip_prefix_head(head["text"]))
    known = pages.where(F.col("source").isNotNull() & F.col("page").isNotNull() & F.col("arrived").isNotNull())
    facts = known.withWatermark("arrived", delay).select(
        "arrived",
        F.unix_millis("arrived").alias("at"),
        F.col("source").cast("string").alias("source"),
        F.col("page").cast("int").alias("page"),
        rstrip(body).alias("body"),
        F.coalesce((tail["type"] == "text") & looks_like_overflow(tail["text"]), F.lit(False)).alias("own"),
        rstrip(tail["text"]).alias("tail"),
        F.coalesce((F.size("chunks") == 1) & (head["type"] == "text") & ~ends_sentence(body), F.lit(False)).alias("soft"),
        F.to_json("chunks").alias("payload"),
    )
    done = facts.groupBy("source").transformWithState(
        statefulProcessor=Stitcher(first_page, wait_ms), outputStructType=OUT, outputMode="Append", timeMode="EventTime"
    )
    read = done.withColumn("chunks", F.from_json("payload", f"array<{CHUNK}>"))
    first = F.get("chunks", F.lit(0)).withField("text", F.col("head")).withField("overflow_count", F.lit(None).cast("int"))
    rest = F.slice("chunks", F.lit(2), F.greatest(F.size("chunks") - 1, F.lit(0)))
    return read.select("source", "page", F.when(F.col("stitched"), F.concat(F.array(first), rest)).otherwise(F.col("chunks")).alias("chunks"), "stitched")


def keep_state_in_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
