"""Runs of repeated words by grammar compression: Re-Pair, seams, derivations, maximal intervals.

1. The words of a batch of texts get ids that no two texts share, and Re-Pair
   compresses them: in each round every pair that is more frequent than the pairs
   that overlap it gets a nonterminal, until no pair is found twice. Such rounds
   take all locally most frequent pairs at once, where the plain form takes one.
2. A run lies across the seam of the smallest derivation that holds it. So each
   nonterminal's seam is looked at once, in its first expansion, and the seams of
   the start rule within their text. A run of ``times`` periods has two of them on
   one side of the seam, so the words next to the seam come again one period away:
   grams of 2**k words give the periods from 2**k to 2**(k+1) - 1, and ranks of
   such grams tell how far a period goes on to both sides.
3. Finds of a nonterminal are carried to all its derivations. Those cut off by the
   ends of an expansion lie inside the same run found further up, so of the
   intervals of one period only those inside no other stay.

Work is in Arrow batches cut by bytes; one text is never cut, and memory grows
with the longest text, by 4 bytes a word for each power of two up to its longest
repeat. Nothing is shuffled.

Defined cases: null, empty and blank texts have no words, no runs and an empty
collapsed text; a null id is kept; repeated rows are handled one by one; an
empty table gives an empty result; other columns are ignored, whatever they are
called. Words are told apart byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import let, slices

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Texts are compressed together up to about so many bytes.
TOGETHER = 2 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Grammar:
    """Re-Pair rules of a sequence of ids; symbols below ``first`` are the ids themselves."""

    def __init__(self, ids: np.ndarray):
        self.first = symbols = int(ids.max(initial=-1)) + 1
        seq, at, live = ids.astype(np.int64), np.arange(len(ids)), np.ones(len(ids), bool)
        left, right, where, split = [], [], [], []  # where: start of a first expansion; split: its seam
        self.size = np.ones(symbols, np.int64)
        while len(seq) > 1:
            live[-1] = False
            i = np.flatnonzero(live)
            a, b = seq[i], seq[i + 1]
            # in a stretch of one symbol every other pair counts
            equal = a == b
            begins = ~equal | np.r_[True, (np.diff(i) > 1) | ~equal[:-1]]
            step = np.arange(len(i))
            usable = (step - np.maximum.accumulate(np.where(begins, step, 0))) % 2 == 0
            code = a * symbols + b
            kinds, kind, count = np.unique(code[usable], return_inverse=True, return_counts=True)
            live[i[usable][count[kind] < 2]] = False
            rank = np.full(len(seq) + 1, -1)
            rank[i[usable]] = np.where(count[kind] > 1, count[kind] * len(kinds) + kind, -1)
            now = i[usable]
            now = now[(rank[now] > rank[now - 1]) & (rank[now] > rank[now + 1])]
            kinds, first, kind, count = np.unique(
                seq[now] * symbols + seq[now + 1], return_index=True, return_inverse=True, return_counts=True
            )
            again = count > 1
            if not again.any():
                break
            name = np.cumsum(again) - 1 + symbols
            left.append(kinds[again] // symbols)
            right.append(kinds[again] % symbols)
            where.append(at[now[first[again]]])
            split.append(at[now[first[again]] + 1])
            self.size = np.concatenate([self.size, self.size[left[-1]] + self.size[right[-1]]])
            now, name = now[again[kind]], name[kind[again[kind]]]
            seq[now] = name
            live[now] = True
            live[np.maximum(now - 1, 0)] = True
            stay = np.ones(len(seq), bool)
            stay[now + 1] = False
            seq, at, live = seq[stay], at[stay], live[stay]
            symbols += int(again.sum())
        self.rounds = [len(x) for x in left]
        none = [np.empty(0, np.int64)]
        self.left, self.right, self.where, self.split = (np.concatenate(x or none) for x in (left, right, where, split))
        self.start, self.at = seq, at

    def derivations(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rule, position) of every expansion of the ``wanted`` rules (a flag for each)."""
        holds = np.zeros(len(self.size), bool)
        holds[self.first :] = wanted
        for n, b in zip(self.rounds, np.cumsum(self.rounds), strict=True):  # a rule is made of earlier rounds' symbols
            holds[self.first + b - n : self.first + b] |= holds[self.left[b - n : b]] | holds[self.right[b - n : b]]
        rules, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        seq, at = self.start[holds[self.start]], self.at[holds[self.start]]
        while len(seq):
            rule = seq - self.first
            rules.append(rule[wanted[rule]])
            places.append(at[wanted[rule]])
            a, b = self.left[rule], self.right[rule]
            seq, at = np.concatenate([a, b]), np.concatenate([at, at + self.size[a]])
            seq, at = seq[holds[seq]], at[holds[seq]]
        return np.concatenate(rules), np.concatenate(places)


class Grams:
    """Ranks of the grams of 1, 2, 4, … ids, as long as some gram is found twice."""

    def __init__(self, ids: np.ndarray):
        self.n, self.rank = len(ids), []
        i, code = np.arange(self.n), ids.astype(np.int64)
        while len(i):
            _, kind, count = np.unique(code, return_inverse=True, return_counts=True)
            again = count[kind] > 1
            rank = -1 - np.arange(self.n)  # a gram found once equals no other
            rank[i[again]] = kind[again]
            self.rank.append(rank)
            wide = 1 << (len(self.rank) - 1)
            i = i[again]
            i = i[i + wide < self.n]
            i = i[rank[i + wide] >= 0]
            code = rank[i] * (int(kind.max(initial=0)) + 1) + rank[i + wide]
        self.places = [self.sorted_places(k) for k in range(len(self.rank))]

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many ids from i on equal those from j on."""
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            in_reach = np.maximum(i, j) < self.n
            same = in_reach & (self.rank[k][np.where(in_reach, i, 0)] == self.rank[k][np.where(in_reach, j, 1 % max(self.n, 1))])
            same &= np.maximum(i, j) + (1 << k) <= self.n
            step = np.where(same, 1 << k, 0)
            i, j, total = i + step, j + step, total + step
        return total

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many ids that end before i equal those that end before j."""
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            in_reach = np.minimum(i, j) >= 1 << k
            a, b = np.where(in_reach, i - (1 << k), 0), np.where(in_reach, j - (1 << k), 0)
            step = np.where(in_reach & (self.rank[k][a] == self.rank[k][b]), 1 << k, 0)
            i, j, total = i - step, j - step, total + step
        return total

    def sorted_places(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of repeated grams of 2**k ids by rank and place, and where each place stands there (-1: found once)."""
        rank = self.rank[k]
        order = np.flatnonzero(rank >= 0)
        order = order[np.argsort(rank[order], kind="stable")]
        place = np.full(self.n, -1)
        place[order] = np.arange(len(order))
        return order, place

    def repeats(self, k: int, order: np.ndarray, place: np.ndarray, at: np.ndarray, sign: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index into ``at``, distance): where the gram at each place comes again 2**k to 2**(k+1) - 1 ids further on (or back).

        Where a gram comes again after d <= 2**(k-1) ids, the text has period d
        for a stretch, in which it comes every d ids. No distance inside a gram's
        own stretch is the smallest period of a run. Of another stretch, only a
        distance that makes both stretches end together, or one within d of the
        length of the own stretch, can be, so the others are skipped.
        """
        rank, wide = self.rank[k], 1 << k
        edge = wide if sign < 0 else 0  # stretches are measured from the gram's end when going back

        def next_of(to: np.ndarray) -> np.ndarray:
            """Distance from each place in the order to the next of its gram, or a large one."""
            on = to + sign
            inside = (on >= 0) & (on < len(order))
            on = np.where(inside, on, to)
            same = inside & (rank[order[on]] == rank[order[to]])
            return np.where(same, np.abs(order[on] - order[to]), 4 << k)

        def stretch(i: np.ndarray, d: np.ndarray) -> np.ndarray:
            return d + (self.after(i, i + d) if sign > 0 else self.before(i + edge, i + edge - d))

        index = np.flatnonzero((at >= 0) & (at < self.n))
        index = index[rank[at[index]] >= 0]
        to, own = place[at[index]], True
        while len(index):
            d, here = next_of(to), order[to]
            skip = np.ones(len(to), np.int64)
            dense = np.flatnonzero(d <= wide // 2)
            if len(dense):
                step, length = d[dense], stretch(here[dense], d[dense])
                skip[dense] += (length - wide) // step
                if not own:
                    first = at[index[dense]]
                    away, mine = np.abs(here[dense] - first), stretch(first, step)
                    for turns, ok in (((mine - away) // step, True), ((length - mine) // step, (length - mine) % step == 0)):
                        far = away + turns * step
                        ok = ok & (turns > 0) & (turns < skip[dense]) & (far >= wide) & (far < 2 * wide)
                        yield index[dense[ok]], far[ok]
            before, to, own = to, to + sign * skip, False
            ok = (to >= 0) & (to < len(order))
            index, to, before = index[ok], to[ok], before[ok]
            away = np.abs(order[to] - at[index])
            ok = (rank[order[to]] == rank[order[before]]) & (away < 2 * wide)
            index, to, away = index[ok], to[ok], away[ok]
            far = away >= wide
            yield index[far], away[far]


def seam_runs(grams: Grams, low: np.ndarray, seam: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(index, start, end, period) of the runs across each seam, seen within low to high."""
    found = [(np.empty(0, np.int64),) * 4]
    for k, (order, place) in enumerate(grams.places):
        for forward in (True, False):
            at, sign = (seam, 1) if forward else (seam - (1 << k), -1)
            for index, period in grams.repeats(k, order, place, at, sign):
                if not len(index):
                    continue
                p = seam[index]
                ahead, back = grams.after(p, p + sign * period), grams.before(p, p + sign * period)
                start = p - back - (0 if forward else period)
                end = p + ahead + (period if forward else 0)
                start, end = np.maximum(start, low[index]), np.minimum(end, high[index])
                ok = (start < p) & (end > p) & (end - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * period))
                found.append((index[ok], start[ok], end[ok], period[ok]))
    index, start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, end, start, index))
    keep = order[np.r_[True, (np.diff(np.stack([index, start, end])[:, order]) != 0).any(axis=0)][: len(order)]]  # smallest period
    return index[keep], start[keep], end[keep], period[keep]


def runs_of(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of the runs in texts that lie at bounds[t] to bounds[t + 1], by start and period."""
    if not len(ids):
        return np.empty((0, 3), np.int64)
    rules, grams = Grammar(ids), Grams(ids)
    sizes = rules.size[rules.first :]
    index, start, end, period = seam_runs(grams, rules.where, rules.split, rules.where + sizes)
    text = np.searchsorted(bounds, rules.at, "right") - 1
    _, top_start, top_end, top_period = seam_runs(grams, bounds[text], rules.at, bounds[text + 1])
    if len(index):
        wanted = np.zeros(len(sizes), bool)
        wanted[index] = True
        rule, place = rules.derivations(wanted)
        # the finds of a rule stand together: repeat each derivation for all of them
        many = np.bincount(index, minlength=len(sizes))
        first = np.cumsum(many) - many
        turn = np.repeat(np.arange(len(rule)), many[rule])
        find = first[rule[turn]] + np.arange(len(turn)) - np.repeat(np.cumsum(many[rule]) - many[rule], many[rule])
        move = place[turn] - rules.where[rule[turn]]
        start, end, period = start[find] + move, end[find] + move, period[find]
    start, end, period = np.concatenate([top_start, start]), np.concatenate([top_end, end]), np.concatenate([top_period, period])
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        base = np.cumsum(np.r_[0, np.diff(period) != 0]) * (len(ids) + 1)
        reach = np.r_[-1, np.maximum.accumulate(end + base)[:-1]]
        start, end, period = (x[end + base > reach] for x in (start, end, period))
    order = np.lexsort((period, start))
    return np.stack([start[order], end[order], period[order]], axis=1)


def batch_runs(texts: list[bytes]) -> tuple[list[int], list[list[dict]], list[str]]:
    """Number of words, runs and collapsed text of each text."""
    words, ids, bounds, seen = [t.split() for t in texts], [], [0], 0
    for w in words:
        own: dict[bytes, int] = {}
        ids.append(np.fromiter((own.setdefault(x, len(own)) for x in w), np.int64, len(w)) + seen)
        seen += len(own)
        bounds.append(bounds[-1] + len(w))
    bounds = np.array(bounds)
    found = runs_of(np.concatenate(ids) if ids else np.empty(0, np.int64), bounds)
    text = np.searchsorted(bounds, found[:, 0], "right") - 1
    runs: list[list[dict]] = [[] for _ in texts]
    gone = np.zeros(bounds[-1] + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 1], -1)
    stay = np.cumsum(gone)[:-1] == 0
    for t, (start, end, period) in zip(text.tolist(), found.tolist(), strict=True):
        runs[t].append({"start": start - int(bounds[t]), "length": end - start, "period": period})
    kept = []
    for t, w in enumerate(words):
        if runs[t]:
            w = [x for x, s in zip(w, stay[bounds[t] : bounds[t + 1]].tolist(), strict=True) if s]
        kept.append(b" ".join(w))
    return [len(w) for w in words], runs, kept


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: runs by start and period, and the text without their repeats.

    A run's words after its first period are left out of ``collapsed``; the
    other words are joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts, TOGETHER):
                n, runs, kept = batch_runs([(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts.slice(a, b - a)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a).cast(pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(runs, pa.list_(RUN)),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    out = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, out)


def strongest(runs: Column) -> Column:
    """Of runs by start and period, the first with the greatest length in periods; null if there is none."""
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)), lambda best, x: F.when(more(x, best), x).otherwise(best))


def with_tails(docs: DataFrame) -> DataFrame:
    """``docs`` in which a tenth of the texts, picked by the digest of their ids, goes on with the repeat of some of its words.

    With h = crc32(id) divisible by 10, g = h // 10 and n > 0 words, word i from
    a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8). A
    null id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def tailed(words: Column) -> Column:
        n = F.size(words).cast("long")
        return let(
            F.struct((g % n).alias("a"), (1 + F.floor((n - g % n) / (3 + g % 8))).alias("p")),
            lambda s: F.array_join(
                F.concat(
                    F.slice(words, 1, s["a"].cast("int")),
                    F.transform(F.sequence(F.lit(0).cast("long"), n - s["a"] - 1), lambda i: F.get(words, (s["a"] + i % s["p"]).cast("int"))),
                ),
                " ",
            ),
        )

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    changed = let(words, lambda w: F.when(F.size(w) > 0, tailed(w)))
    return docs.withColumn("text", F.when(h % 10 == 0, F.coalesce(changed, "text")).otherwise(F.col("text")))
