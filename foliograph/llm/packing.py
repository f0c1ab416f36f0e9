"""Token ids packed into rows of one length, best fit decreasing.

Documents are encoded with an end mark each. One that is longer than a row is
split into full rows and a rest, losslessly. Rests are packed in the order of
their lengths, each into the row with the least space that still holds it; a
segment tree over the amounts of free space finds it. Every input partition packs
on its own, ``BUFFER`` tokens at a time, so nothing is shuffled, memory is
bounded, and a lost partition is packed again from its own input alone.

A packed row holds an id matrix row (little-endian unsigned 16-bit ids, padded
with the end mark), the cumulative lengths of its segments, where positions go
back to zero, and for each segment its document and its offset in it.

Defined cases: a null or empty text is its end mark alone; a null id stays null
in ``doc_ids``; repeated rows are packed each; extra columns are ignored; empty
partitions give no rows.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Tokens that are held until they are packed.
BUFFER = 2_000_000
PACKED = (
    "pack_id long, n_tokens int, token_ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, doc_offsets array<long>"
)


class RankEncoder:
    """Encoder for a rank file, with the first free id as end mark."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.end = len(table)
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 16-bit integers."""
        return self.library.encode_to_numpy(text, disallowed_special=()).astype("<u2").tobytes()


@functools.lru_cache(maxsize=2)
def rank_encoder(ranks: bytes, pattern: str) -> RankEncoder:
    return RankEncoder(ranks, pattern)


class FreeSpace:
    """Bins by free space, with a segment tree that says which amounts occur."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [False] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, space: int, which: int) -> None:
        self.bins[space].append(which)
        i = space + self.leaves
        while i and not self.tree[i]:
            self.tree[i] = True
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """The least free space of at least ``size``, and a bin that has it, which is removed."""
        i = size + self.leaves
        while not self.tree[i]:
            while i & 1:  # a right child: what is larger lies above
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if self.tree[2 * i] else 2 * i + 1
        space = i - self.leaves
        which = self.bins[space].pop()
        if not self.bins[space]:
            self.tree[i] = False
            while i > 1:
                i >>= 1
                self.tree[i] = self.tree[2 * i] or self.tree[2 * i + 1]
        return space, which


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Numbers of the pieces in each bin of ``length``, packed best fit decreasing."""
    free, bins = FreeSpace(length), []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = free.take(sizes[piece])
        if found is None:
            space, which = length, len(bins)
            bins.append([])
        else:
            space, which = found
        bins[which].append(piece)
        if space > sizes[piece]:
            free.put(space - sizes[piece], which)
    return bins


def pack(docs: DataFrame, ranks: bytes, pattern: str, length: int = 2048) -> DataFrame:
    """``docs`` (doc_id, text) as packed rows of ``length`` token ids."""
    schema = to_arrow_schema(T.StructType.fromDDL(PACKED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks, pattern)
        end = np.array([encoder.end], "<u2").tobytes()
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        pieces: list[tuple[int | None, int, bytes]] = []
        held = 0

        def rows(bins: list[list[tuple[int | None, int, bytes]]]) -> pa.RecordBatch:
            nonlocal number
            columns: list[list] = [[] for _ in schema]
            for parts in bins:
                sums = np.cumsum([0, *[len(p[2]) // 2 for p in parts]]).tolist()
                data = b"".join(p[2] for p in parts)
                values = [number, sums[-1], data + end * (length - sums[-1]), sums, sums[:-1], [p[0] for p in parts], [p[1] for p in parts]]
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
                number += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        def packed() -> Iterator[pa.RecordBatch]:
            bins = best_fit([len(p[2]) // 2 for p in pieces], length)
            for a in range(0, len(bins), 1000):
                yield rows([[pieces[i] for i in b] for b in bins[a : a + 1000]])

        for batch in batches:
            whole = []
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                doc, ids = doc.as_py(), encoder.encode(text.as_py() or "") + end
                for at in range(0, len(ids), 2 * length):
                    part = ids[at : at + 2 * length]
                    if len(part) == 2 * length:
                        whole.append([(doc, at // 2, part)])
                    else:
                        pieces.append((doc, at // 2, part))
                        held += len(part) // 2
                if len(whole) >= 1000:
                    yield rows(whole)
                    whole = []
                if held >= BUFFER:
                    yield from packed()
                    pieces, held = [], 0
            if whole:
                yield rows(whole)
        if pieces:
            yield from packed()

    return docs.select("doc_id", "text").mapInArrow(run, PACKED)


def write_packed(packed: DataFrame, path: str) -> None:
    """Packed rows as Parquet: one row of the id matrix for each."""
    packed.write.parquet(path)


def matrix(rows: list, length: int = 2048) -> np.ndarray:
    """The id matrix of collected packed rows."""
    return np.stack([np.frombuffer(r["token_ids"], "<u2") for r in rows]) if rows else np.empty((0, length), "<u2")
