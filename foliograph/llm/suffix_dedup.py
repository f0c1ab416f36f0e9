"""Removal of repeated byte strings, by a sparse suffix order over all documents.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts elsewhere
(``keep="none"``), or earlier (``keep="first"``: the first copy stays).

1. Every string of ``LENGTH`` bytes has an anchor: of the ``GRAM``-byte grams in it
   the one with the smallest hash, leftmost first. Equal strings have equal
   anchors at equal offsets, so only suffixes with a common anchor need to be
   ordered. Neighbouring strings mostly share their anchor and form a run.
2. Anchors that occur once are done. Where all runs of an anchor are equal, all
   their strings repeat, and no string is looked at on its own.
3. For the other anchors one run of each kind goes into a suffix order: ranks of
   blocks are doubled up to ``LENGTH`` bytes, and positions with the same rank are
   neighbours in it. The longest previous factor of a position reaches
   ``LENGTH`` if the previous smaller position in this order has the same rank; the
   next smaller position of the reversed order tells the same for later copies.
   Anchors with more than ``CROWD`` kinds of runs do not go into one task: their
   strings are counted by fingerprint and joined back.

Counts, minima and joins carry numbers only; texts move once for the documents
with open runs and once for those that lose bytes. No group is gathered beyond
``CROWD`` runs.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes stay whole;
repeated rows are copies of each other; a row with a null id stays whole and is
no copy of others. Ids are expected to be unique, or their rows equal. Strings
never cross documents. Fingerprints have 64 bits within an anchor's 64.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliograph.llm.common import BATCH_BYTES, pick, slices, staged

LENGTH, GRAM = 200, 40
GRAMS = LENGTH - GRAM + 1
#: Bytes that are hashed together; longer texts go in overlapping pieces.
PIECE_BITS = 21
PIECE = 1 << PIECE_BITS
#: Kinds of runs of one anchor that are ordered in one task at most.
CROWD = 20_000
_TABLE = np.random.default_rng(5).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


@functools.lru_cache(maxsize=2)
def powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for data of up to 2**bits bytes."""
    both = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full((1 << bits) + 1, base, np.uint64)
        p[0] = 1
        both.append(np.multiply.accumulate(p))
    return both[0], both[1]


def powers_for(size: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(max(PIECE_BITS, size.bit_length()))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers_for(len(data))[0][: len(data)], out=sums[1:])
    return sums


def hashes(sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    """Hashes of the strings at ``start``, from the prefix sums of their piece."""
    return mixed((sums[start + length] - sums[start]) * powers_for(len(sums) - 1)[1][start])


def runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Runs of strings with one anchor in a piece with texts at ``starts``: anchor hash, run hash, first string, strings."""
    n = len(data)
    none = np.empty(0, np.int64)
    if n < LENGTH:
        return none, none, none, none
    sums = prefix_sums(data)
    gram = hashes(sums, np.arange(n - GRAM + 1), GRAM)
    low = (gram >> np.uint64(PIECE_BITS) << np.uint64(PIECE_BITS)) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while 2 * span <= GRAMS:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    low = np.minimum(low[: len(low) - (GRAMS - span)], low[GRAMS - span :])
    anchor = (low & np.uint64(PIECE - 1)).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, np.int64)
    fits = ends - starts >= LENGTH
    np.add.at(inside, starts[fits], 1)
    np.add.at(inside, ends[fits] - LENGTH + 1, -1)
    anchor[np.cumsum(inside[:-1]) == 0] = -1
    first = np.flatnonzero(np.diff(anchor, prepend=-2))
    count = np.diff(np.append(first, len(anchor)))
    used = anchor[first] >= 0
    first, count = first[used], count[used]
    at = anchor[first]
    # equal runs are equal bytes around anchors at equal offsets
    whole = hashes(sums, first, count + LENGTH - 1) + mixed((at - first).astype(np.uint64) * np.uint64(_BASE) + count.astype(np.uint64))
    return gram[at].view(np.int64), mixed(whole).view(np.int64), first, count


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[int], list[int]]]:
    """Texts joined up to a piece, with where each starts, ends, its number and its offset; long texts overlap."""
    parts: list[bytes] = []
    number: list[int] = []
    offset: list[int] = []
    size = 0

    def full():
        ends = np.cumsum([len(p) for p in parts])
        return np.frombuffer(b"".join(parts), np.uint8), ends - [len(p) for p in parts], ends, list(number), list(offset)

    for i, text in enumerate(texts):
        step = PIECE - LENGTH
        for at in range(0, max(1, len(text) - LENGTH + 1), step):
            part = text[at : at + step + LENGTH - 1]
            if size + len(part) > PIECE and parts:
                yield full()
                parts, number, offset, size = [], [], [], 0
            parts.append(part)
            number.append(i)
            offset.append(at)
            size += len(part)
    if parts:
        yield full()


RUNS = "doc_id long, gram long, run long, first int, count int"


def anchored_runs(docs: DataFrame) -> DataFrame:
    """Every run of every text: (doc_id, gram, run, first, count)."""
    schema = to_arrow_schema(T.StructType.fromDDL(RUNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text"), PIECE):
                ids = batch.column("doc_id").slice(a, b - a).to_numpy(zero_copy_only=False)
                texts = [(t or "").encode() for t in batch.column("text").slice(a, b - a).to_pylist()]
                for data, starts, ends, number, offset in pieces(texts):
                    gram, whole, first, count = runs(data, starts, ends)
                    part = np.searchsorted(ends, first, side="right")
                    doc = ids[np.array(number, np.int64)[part]]
                    place = first - starts[part] + np.array(offset, np.int64)[part]
                    cols = [doc.astype(np.int64), gram, whole, place.astype(np.int32), count.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=schema)

    return docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(run, RUNS)


def chosen_texts(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """``docs`` of the ids in ``lists``, with its columns; only their texts are shuffled where the ids can be sent out."""
    return pick(docs, lists, "left_semi").join(lists, "doc_id")


CONTEXTS = "gram long, doc_id long, first int, many boolean, bytes binary"


def contexts(docs: DataFrame, open_runs: DataFrame) -> DataFrame:
    """The bytes of the strings of each open run: (gram, doc_id, first, many, bytes)."""
    schema = to_arrow_schema(T.StructType.fromDDL(CONTEXTS))
    lists = open_runs.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "first", "count", "many")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, wanted in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "runs")], strict=True):
                data = (text or "").encode()
                rows += [
                    (r["gram"], doc, r["first"], r["many"], data[r["first"] : r["first"] + r["count"] - 1 + LENGTH]) for r in wanted
                ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return chosen_texts(docs.select("doc_id", "text"), lists).select("doc_id", "text", "runs").mapInArrow(cut, CONTEXTS)


def suffix_ranks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ranks of the strings of ``LENGTH`` bytes at ``starts`` in a suffix order, by doubling.

    The order of the first blocks, of an eighth of the length, is that of their
    fingerprints; that of longer ones follows from their halves.
    """
    block = LENGTH // 8
    places = np.unique((starts[:, None] + block * np.arange(8)).ravel())
    _, rank = np.unique(hashes(prefix_sums(data), places, block), return_inverse=True)
    at = np.zeros(int(places[-1]) + 1, np.int64)
    at[places] = rank
    for width in (block, 2 * block, 4 * block):
        halves = starts if width == 4 * block else np.unique((starts[:, None] + 2 * width * np.arange(LENGTH // (2 * width))).ravel())
        _, rank = np.unique(at[halves] * len(at) + at[halves + width], return_inverse=True)
        at = np.zeros(int(places[-1]) + 1, np.int64)
        at[halves] = rank
    return at[starts]


def reached_by_others(ranks: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the longest previous, and the longest next, factor of each suffix reaches the full length.

    In suffix order, with equal ranks by position, the previous smaller position
    of a suffix has its rank exactly if the neighbour before it does.
    """
    order = np.lexsort((position, ranks))
    same = np.diff(ranks[order]) == 0
    earlier, later = np.zeros(len(ranks), bool), np.zeros(len(ranks), bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def ordered_spans(rows: list[tuple[int, int, bool, bytes]], first_stays: bool) -> Iterator[tuple[int, int, int]]:
    """Spans (doc_id, start, end) of repeated strings among the contexts of whole anchors."""
    sizes = np.array([len(r[3]) for r in rows])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    strings = sizes - LENGTH + 1
    starts = np.repeat(ends - sizes - np.append(0, np.cumsum(strings)[:-1]), strings) + np.arange(strings.sum())
    owner = np.repeat(np.arange(len(rows)), strings)
    # ties of rank go by document and place, as in the whole corpus
    by_place = np.lexsort(([r[1] for r in rows], [r[0] for r in rows]))
    turn = np.empty(len(rows), np.int64)
    turn[by_place] = np.arange(len(rows))
    earlier, later = reached_by_others(suffix_ranks(data, starts), turn[owner] * PIECE + starts - (ends - sizes)[owner])
    hit = earlier if first_stays else (earlier | later) & ~np.array([r[2] for r in rows])[owner]
    marked = np.flatnonzero(hit)
    if not len(marked):
        return
    breaks = np.flatnonzero((np.diff(marked) != 1) | (np.diff(owner[marked]) != 0)) + 1
    for group in np.split(marked, breaks):
        doc, first, _, _ = rows[owner[group[0]]]
        at = first + int(starts[group[0]] - (ends - sizes)[owner[group[0]]])
        yield doc, at, at + len(group) - 1 + LENGTH


SPANS = "doc_id long, start int, end int"


def spans_by_order(ctx: DataFrame, first_stays: bool) -> DataFrame:
    """Repeated strings by suffix order; contexts of one anchor meet in one task, sorted, some megabytes at a time."""
    schema = to_arrow_schema(T.StructType.fromDDL(SPANS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bool, bytes]] = []
        size, last = 0, None

        def done() -> pa.RecordBatch:
            found = list(ordered_spans(held, first_stays))
            cols = [[x[i] for x in found] for i in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for batch in batches:
            for gram, *row in zip(*[batch.column(c).to_pylist() for c in ("gram", "doc_id", "first", "many", "bytes")], strict=True):
                if gram != last and size > PIECE // 2:
                    yield done()
                    held, size = [], 0
                held.append(tuple(row))
                size += len(row[3])
                last = gram
        if held:
            yield done()

    return ctx.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, SPANS)


def spans_by_count(ctx: DataFrame, first_stays: bool) -> DataFrame:
    """The same for anchors with very many kinds of runs: strings by fingerprint, counted and joined back."""
    kind = "gram long, print long, doc_id long, at int, many boolean"
    schema = to_arrow_schema(T.StructType.fromDDL(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, doc, first, many, data in zip(*[batch.column(c).to_pylist() for c in ("gram", "doc_id", "first", "many", "bytes")], strict=True):
                n = len(data) - LENGTH + 1
                prints = hashes(prefix_sums(np.frombuffer(data, np.uint8)), np.arange(n), LENGTH).view(np.int64)
                cols = [np.full(n, gram), prints, np.full(n, doc), first + np.arange(n), np.full(n, many)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    strings = staged(ctx.mapInArrow(run, kind), "suffix-strings")
    place = F.struct("doc_id", "at")
    counted = strings.groupBy("gram", "print").agg(F.count("*").alias("n"), F.min(place).alias("least")).where("n > 1")
    hit = strings.join(counted, ["gram", "print"]).where(place > F.col("least") if first_stays else ~F.col("many"))
    return hit.select("doc_id", F.col("at").alias("start"), (F.col("at") + LENGTH).alias("end"))


def repeated_spans(docs: DataFrame, keep: str = "none", crowd: int = CROWD) -> DataFrame:
    """Spans (doc_id, start, end) in bytes that are to go; they may touch and overlap."""
    first_stays = keep == "first"
    every = anchored_runs(docs)
    place = F.struct("doc_id", "first")
    counted = every.groupBy("gram").agg(F.count("*").alias("n"), F.min("run").alias("lo"), F.max("run").alias("hi"), F.min(place).alias("least"))
    counted = counted.where("n > 1").select("gram", (F.col("lo") == F.col("hi")).alias("alike"), "least")
    live = staged(every.join(counted, "gram"), "suffix-live")
    span = ["doc_id", F.col("first").alias("start"), (F.col("first") + F.col("count") - 1 + LENGTH).alias("end")]
    alike = live.where("alike")
    found = (alike.where(place > F.col("least")) if first_stays else alike).select(span)
    unlike = live.where("NOT alike").drop("alike", "least")
    kinds = unlike.groupBy("gram", "run").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "first", "count")).alias("one"))
    kinds = staged(kinds, "suffix-kinds")
    again = unlike.join(kinds.where("n > 1").select("gram", "run", "one"), ["gram", "run"])
    if first_stays:
        again = again.where(place > F.struct("one.doc_id", "one.first"))
    found = found.unionByName(again.select(span))
    # an anchor is open if one of its kinds may hold strings that are not known to repeat
    open_grams = kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("n").alias("fewest"))
    open_grams = open_grams.where(F.lit(True) if first_stays else F.col("fewest") == 1)
    open_runs = kinds.join(open_grams, "gram").select("gram", "one.*", (F.col("n") > 1).alias("many"), (F.col("kinds") > crowd).alias("crowded"))
    open_runs = staged(open_runs, "suffix-open")
    found = found.unionByName(spans_by_order(contexts(docs, open_runs.where("NOT crowded")), first_stays))
    if open_runs.where("crowded").limit(1).count():
        found = found.unionByName(spans_by_count(contexts(docs, open_runs.where("crowded")), first_stays))
    return found


def without_spans(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of ``data``, and the number of maximal removed runs."""
    kept, at, n = [], 0, 0
    for start, end in sorted(spans):
        if start > at or not n:
            kept.append(data[at:start])
            n += 1
        at = max(at, end)
    return b"".join([*kept, data[at:]]), n


def deduplicate(docs: DataFrame, keep: str = "none", crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, n_spans, kept) of each document, ``kept`` as bytes."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spans = repeated_spans(docs, keep, crowd)
    lists = staged(spans.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")), "suffix-spans")
    kind = "doc_id long, n_bytes long, n_spans long, kept binary"
    schema = to_arrow_schema(T.StructType.fromDDL(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text"), BATCH_BYTES):
                part = batch.slice(a, b - a)
                texts = [t.encode() for t in part.column("text").to_pylist()]
                left = [without_spans(t, [(s["start"], s["end"]) for s in x]) for t, x in zip(texts, part.column("spans").to_pylist(), strict=True)]
                cols = [part.column("doc_id"), [len(t) for t in texts], [n for _, n in left], [k for k, _ in left]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    changed = chosen_texts(rows, lists).select("doc_id", "text", "spans").mapInArrow(run, kind)
    same = pick(rows, lists, "left_anti").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept")
    )
    return changed.unionByName(same)
