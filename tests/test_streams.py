"""Stateful streams: stitching in any order of arrival, windows behind a watermark."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from foliograph.operators.stitch import stitch_pages
from foliograph.schema import CHUNK
from foliograph.sources.sinks import manifest, write_page_batches, written_pages
from foliograph.streaming.ingest import write_stream
from foliograph.streaming.stitch import keep_state_in_rocksdb, stitch_stream
from foliograph.streaming.windows import sessions, windows

START = datetime(2024, 1, 1)
PAGES = f"source string, page int, chunks array<{CHUNK}>, arrived timestamp"


def chunk(text, kind="text"):
    return (kind, text)


def book(pick, source, pages):
    """Pages of one to three chunks, many of which end no sentence or pass text on."""
    words = lambda n, end: "head\n\n" + " ".join(pick.choice(["red", "blue", "green"]) for _ in range(n)) + end
    out = []
    for page in pages:
        texts = [chunk(words(pick.choice([5, 125]), pick.choice(["", "", ".", " -"])), pick.choice(["text", "text", "text", "table"])) for _ in range(pick.choice([1, 1, 1, 2, 3]))]
        out.append((source, page, texts))
    return out


def as_frame(spark, rows):
    flat = [(s, p, [t for _, t in c], [k for k, _ in c], a) for s, p, c, a in rows]
    df = spark.createDataFrame(flat, "source string, page int, texts array<string>, kinds array<string>, arrived timestamp")
    full = F.from_json(F.to_json(F.transform("texts", lambda t, i: F.struct(F.get("kinds", i).alias("type"), t.alias("text")))), f"array<{CHUNK}>")
    return df.select("source", "page", full.alias("chunks"), "arrived")


def run_batches(spark, folder, batches, out, make):
    """Write each batch and let the stream take it; everything given out so far, after the last."""
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = make(spark.readStream.schema(batch.schema).parquet(f"{folder}/in"))
        write_stream(stream, f"{folder}/{out}", f"{folder}/progress").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/{out}")


def facts(df):
    return sorted((r.source, r.page, r.stitched, [(x.type, x.text) for x in r.chunks]) for r in df.collect())


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    keep_state_in_rocksdb(spark)
    yield
    spark.conf.set(key, before)


def test_pages_in_any_order(spark, rocksdb, tmp_path):
    pick = random.Random(6)
    rows = [(*r, START) for s in ("a", "b", "c") for r in book(pick, s, range(1, 31))]
    whole = facts(stitch_pages(as_frame(spark, rows).drop("arrived").cache()))
    assert any(r[2] for r in whole)
    pick.shuffle(rows)
    rows += rows[:7]  # pages that come again
    batches = [as_frame(spark, [(*r[:3], START + timedelta(seconds=i)) for r in rows[i::3]]) for i in range(3)]
    done = run_batches(spark, str(tmp_path), batches, "out", stitch_stream)
    assert facts(done) == whole


def test_gaps_are_given_up_and_late_pages_stand_alone(spark, rocksdb, tmp_path):
    long = "head\n\n" + "word " * 130
    page = lambda s, p, minute: (s, p, [chunk(long)], START + timedelta(minutes=minute))
    first = [page("a", 1, 0), page("a", 3, 0), page("b", 1, 0)]
    soon = [page("b", 2, 5)]  # not ten minutes later: a3 waits on
    later = [page("b", 3, 20)]
    straggler = [page("a", 2, 21), page("a", 4, 21), page("a", 0, 21)]
    frames = [as_frame(spark, r) for r in (first, soon, later, straggler)]
    step = lambda n: run_batches(spark, str(tmp_path), frames[n : n + 1], "out", stitch_stream)
    step(0)
    assert sorted((r.source, r.page) for r in step(1).collect()) == [("a", 1), ("b", 1), ("b", 2)]
    done = {(r.source, r.page): r for r in step(2).collect()}
    assert ("a", 3) in done and not done["a", 3].stitched
    done = {(r.source, r.page): r for r in step(3).collect()}
    assert sorted(done) == [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 1), ("b", 2), ("b", 3)]
    assert not done["a", 2].stitched and done["a", 4].stitched and done["b", 3].stitched


EVENTS = "event_id long, ts timestamp, user_id long, cents long"


def event(i, minute, user=1, cents=1):
    return (i, None if minute is None else START + timedelta(minutes=minute), user, cents)


def test_sessions_leave_out_repeats_and_late_events(spark, tmp_path):
    first = [event(1, 0), event(2, 5), event(2, 5), event(3, 40), event(4, 3, user=None), event(5, None), event(6, 300, user=2)]
    second = [event(7, 10), event(8, 301, user=2), event(9, 600, user=3)]  # 7 is late: the watermark stands at 240 minutes
    frames = [spark.createDataFrame(r, EVENTS) for r in (first, second)]
    measures = [F.count("*").alias("n"), F.sum("cents").alias("cents")]
    done = run_batches(spark, str(tmp_path), frames, "out", lambda s: sessions(s, "user_id", "10 minutes", "60 minutes", measures))
    minutes = lambda t: int((t - START).total_seconds() // 60)
    got = sorted((r.user_id, minutes(r.session_start), minutes(r.session_end), r.n, r.cents) for r in done.collect())
    assert got == [(1, 0, 15, 2, 2), (1, 40, 50, 1, 1), (2, 300, 311, 2, 2)]


def test_windows_overlap_and_close_behind_the_watermark(spark, tmp_path):
    rows = [event(i, m) for i, m in enumerate([0, 10, 20, 35, 200])]
    done = run_batches(spark, str(tmp_path), [spark.createDataFrame(rows, EVENTS)], "out", lambda s: windows(s, ["user_id"], "30 minutes", "30 minutes", [F.count("*").alias("n")], step="15 minutes"))
    minutes = lambda t: int((t - START).total_seconds() // 60)
    assert sorted((minutes(r.window_start), r.n) for r in done.collect()) == [(-15, 2), (0, 3), (15, 2), (30, 1)]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    """The record of a finished batch is taken away, as if the stream had been stopped before it was written."""
    schema = "source string, page int, text string"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        write_page_batches(stream, f"{tmp_path}/out", f"{tmp_path}/progress", "one").awaitTermination()
        return written_pages(spark, f"{tmp_path}/out", stream.schema)

    write([("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), (None, 1, "z"), ("a", None, "z")])
    run()
    write([("a", 2, "again"), ("a", 4, "w"), ("b", 1, "v")])
    whole = [("a", 1, "x", 0), ("a", 2, "y", 0), ("a", 4, "w", 1), ("b", 1, "v", 1)]
    facts = lambda df: sorted((r.source, r.page, r.text, r.batch) for r in df.collect())
    assert facts(run()) == whole
    for name in ("1", ".1.crc"):
        (tmp_path / "progress" / "commits" / name).unlink(missing_ok=True)
    assert facts(run()) == whole
    assert sorted(map(tuple, manifest(run()).collect())) == [("a", "one", 4, 3, "partial"), ("b", "one", 1, 1, "complete")]
