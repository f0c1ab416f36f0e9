"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions that adds to them.

Patterns give the base spans of four kinds. The network reads windows of
characters in both directions and scores a tag for each; windows overlap, and
where they do, their scores are averaged with the weight of each window's middle.
The best tags of a whole stretch are then found at once with the transition
scores, so a span across windows is decided globally. A span of the network
counts if it fits the shape of its kind and overlaps no base span. Every shape
holds a digit, an at sign, or a writing of one ("(at)", "[at]", or " at " before
a host with a dot), so the network reads stretches around those alone. A stretch
reaches past both ends of the address or number that its sign may belong to;
nothing else is cut.

The network is trained in numpy by gradient steps on labelled windows. Labelled
spans come from the caller; ``labelled_windows`` makes them from the base spans of
at most ``SAMPLE`` documents, picked by a hash of their ids, with each span also
in writings that no pattern covers (an at sign as a word, a phone number without
its country code).

Defined cases: a null text is empty and has no spans; repeated rows get the same
spans each; with no labelled span the network is left out. Extra columns pass
through; output columns replace columns of the same name. Positions count code
points, ends are exclusive.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]
# --- fixed values: the base patterns ---
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# ---
NUMBERS = re.compile(r"[0-9](?:[0-9 ().-]*[0-9])?")
AT = re.compile(r"@|\(at\)|\[at\]| at (?= ?[\w-]++\.[\w-])")
LOCAL_PART, HOST = re.compile(r"[\w.%+-]"), re.compile(r" ?[\w-]++(?:\.[\w-]++)*+")
#: Documents that training windows are taken from at most, windows at most, and steps.
SAMPLE, WINDOWS, STEPS, BATCH = 4_000, 4_000, 260, 64
#: Characters of a window, its step, and what is read around numbers and addresses.
WIDTH, STRIDE, AROUND = 64, 32, 24
#: Stretches that are decoded together at most, and their padded characters.
DECODED, PADDED = 128, 500_000
EMBED, HIDDEN = 12, 16
TAGS = ["O", *[f"{p}-{k}" for k in KINDS for p in "BI"]]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns by kind, then start; each search is linear in the text."""
    found: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            d = digits_of(m[0])
            if 13 <= len(d) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def char_ids(text: str) -> np.ndarray:
    """A class for each character: printable ASCII one by one, then others by kind; 0 is padding."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where((code >= 32) & (code < 127), code - 30, np.where(code < 32, 1, np.where(code < 0x250, 97, 98))).astype(np.int64)


VOCABULARY = 99


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Tagger:
    """Parameters of the network by name."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 0) -> Tagger:
        r = np.random.default_rng(seed)
        draw = lambda *shape: (r.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        p = {"embed": draw(VOCABULARY, EMBED) * 3, "out": draw(2 * HIDDEN, len(TAGS)), "bias": np.zeros(len(TAGS), np.float32)}
        p |= {"trans": np.zeros((len(TAGS), len(TAGS)), np.float32), "first": np.zeros(len(TAGS), np.float32)}
        for d in "fb":
            p |= {f"wx_{d}": draw(EMBED, 4 * HIDDEN), f"wh_{d}": draw(HIDDEN, 4 * HIDDEN), f"b_{d}": np.zeros(4 * HIDDEN, np.float32)}
            p[f"b_{d}"][HIDDEN : 2 * HIDDEN] = 1
        return Tagger(p)

    def _walk(self, x: np.ndarray, d: str, keep: bool):
        """States of one direction for (steps, rows, embed) inputs that are given in its order."""
        steps, rows, _ = x.shape
        h = c = np.zeros((rows, HIDDEN), np.float32)
        states, kept = np.empty((steps, rows, HIDDEN), np.float32), []
        inputs = x @ self.p[f"wx_{d}"] + self.p[f"b_{d}"]
        for t in range(steps):
            z = inputs[t] + h @ self.p[f"wh_{d}"]
            s = logistic(z[:, : 3 * HIDDEN])
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if keep:
                kept.append((h, before, i, f, o, g, tc))
            h = o * tc
            states[t] = h
        return states, kept

    def scores(self, ids: np.ndarray, keep: bool = False):
        """Tag scores (rows, steps, tags) of windows of character classes (rows, steps)."""
        x = self.p["embed"][ids.T]
        ahead, k1 = self._walk(x, "f", keep)
        back, k2 = self._walk(x[::-1], "b", keep)
        both = np.concatenate([ahead, back[::-1]], axis=2)
        out = (both @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)
        return (out, (x, both, k1, k2)) if keep else out

    def _walk_back(self, x, kept, d_states, d: str, grad):
        dh = dc = np.zeros_like(d_states[0])
        dx = np.empty_like(x)
        wx, wh = self.p[f"wx_{d}"], self.p[f"wh_{d}"]
        for t in range(len(kept) - 1, -1, -1):
            h0, c0, i, f, o, g, tc = kept[t]
            dh = dh + d_states[t]
            dc = dc + dh * o * (1 - tc**2)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            grad[f"wx_{d}"] += x[t].T @ dz
            grad[f"wh_{d}"] += h0.T @ dz
            grad[f"b_{d}"] += dz.sum(axis=0)
            dx[t] = dz @ wx.T
            dh, dc = dz @ wh.T, dc * f
        return dx

    def loss(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags and its gradient."""
        rows, steps = ids.shape
        out, (x, both, k1, k2) = self.scores(ids, keep=True)
        trans, first, at = self.p["trans"], self.p["first"], np.arange(rows)
        alpha, beta = np.empty_like(out), np.zeros_like(out)
        alpha[:, 0] = first + out[:, 0]
        for t in range(1, steps):
            alpha[:, t] = log_sum(alpha[:, t - 1, :, None] + trans, 1) + out[:, t]
        for t in range(steps - 2, -1, -1):
            beta[:, t] = log_sum(trans + (out[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        whole = log_sum(alpha[:, -1], 1)
        gold = first[tags[:, 0]] + sum(out[at, t, tags[:, t]] for t in range(steps)) + sum(trans[tags[:, t - 1], tags[:, t]] for t in range(1, steps))
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_out = np.exp(alpha + beta - whole[:, None, None])
        grad["first"] += d_out[:, 0].sum(axis=0)
        np.add.at(grad["first"], tags[:, 0], -1)
        for t in range(1, steps):
            pair = alpha[:, t - 1, :, None] + trans + (out[:, t] + beta[:, t])[:, None, :] - whole[:, None, None]
            grad["trans"] += np.exp(pair).sum(axis=0)
            np.add.at(grad["trans"], (tags[:, t - 1], tags[:, t]), -1)
        for t in range(steps):
            d_out[at, t, tags[:, t]] -= 1
        d = d_out.transpose(1, 0, 2)
        grad["out"] += np.einsum("trh,trk->hk", both, d)
        grad["bias"] += d.sum(axis=(0, 1))
        d_both = d @ self.p["out"].T
        dx = self._walk_back(x, k1, d_both[..., :HIDDEN], "f", grad)
        dx = dx + self._walk_back(x[::-1], k2, d_both[::-1][..., HIDDEN:], "b", grad)[::-1]
        np.add.at(grad["embed"], ids.T, dx)
        return float((whole - gold).mean()), {k: g / rows for k, g in grad.items()}

    def best_tags(self, scores: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """The best tags of each of several stretches, given scores padded to (rows, steps, tags)."""
        rows, steps, tags = scores.shape
        trans = self.p["trans"]
        best, back = self.p["first"] + scores[:, 0], np.zeros((steps, rows, tags), np.int8)
        ends = np.where(lengths[:, None] == 1, best, 0.0)
        for t in range(1, steps):
            step = best[:, :, None] + trans
            back[t] = step.argmax(axis=1)
            best = step.max(axis=1) + scores[:, t]
            ends = np.where(lengths[:, None] == t + 1, best, ends)
        found = []
        for r, n in enumerate(lengths):
            path = np.empty(n, np.int64)
            path[-1] = ends[r].argmax()
            for t in range(n - 1, 0, -1):
                path[t - 1] = back[t, r, path[t]]
            found.append(path)
        return found


def train(windows: list[tuple[str, list[Span]]], steps: int = STEPS, seed: int = 0) -> Tagger | None:
    """A tagger fitted by Adam on labelled windows; None where no window has a span."""
    if not any(spans for _, spans in windows):
        return None
    ids, tags = np.zeros((len(windows), WIDTH), np.int64), np.zeros((len(windows), WIDTH), np.int64)
    for r, (text, spans) in enumerate(windows):
        ids[r, : len(text)] = char_ids(text)[:WIDTH]
        for kind, start, end in spans:
            tags[r, max(start, 0) : end] = 2 + 2 * KINDS.index(kind)
            if 0 <= start < WIDTH:
                tags[r, start] -= 1
    tagger, order = Tagger.fresh(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(x) for k, x in tagger.p.items()}
    for t in range(1, steps + 1):
        rows = order.integers(0, len(windows), BATCH)
        _, grad = tagger.loss(ids[rows], tags[rows])
        size = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
        for k, g in grad.items():
            g = g * min(1.0, 5.0 / (size + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g**2
            rate = 0.02 * (1 - t / (steps + 1))
            tagger.p[k] = (tagger.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    return tagger


def address_around(text: str, start: int, end: int) -> tuple[int, int]:
    """The ends of the address whose at sign, in some writing, is ``text[start:end]``."""
    if start > 1 and text[start - 1] == " " and LOCAL_PART.match(text[start - 2]):
        start -= 1
    while start > 0 and LOCAL_PART.match(text[start - 1]):
        start -= 1
    host = HOST.match(text, end)
    return start, host.end() if host else end


def addresses(text: str) -> list[tuple[int, int]]:
    """What surrounds each at sign, in any writing, as far as an address may go."""
    return [address_around(text, *m.span()) for m in AT.finditer(text)]


def stretches(text: str) -> list[tuple[int, int]]:
    """Where the network reads: around numbers and addresses, merged where that overlaps."""
    signs = [m.span() for m in NUMBERS.finditer(text)] + addresses(text)
    found: list[tuple[int, int]] = []
    for start, end in sorted(signs):
        start, end = max(0, start - AROUND), min(len(text), end + AROUND)
        if found and start <= found[-1][1]:
            found[-1] = found[-1][0], max(found[-1][1], end)
        else:
            found.append((start, end))
    return found


def merged_scores(tagger: Tagger, texts: list[str]) -> list[np.ndarray]:
    """Tag scores of each stretch, from overlapping windows weighted towards their middles."""
    ids, where = [], []
    for n, text in enumerate(texts):
        own = char_ids(text)
        last = max(0, -(-(len(own) - WIDTH) // STRIDE)) * STRIDE
        for start in range(0, last + 1, STRIDE):
            row = np.zeros(WIDTH, np.int64)
            part = own[start : start + WIDTH]
            row[: len(part)] = part
            ids.append(row)
            where.append((n, start, len(part)))
    weight = (np.minimum(np.arange(WIDTH), np.arange(WIDTH)[::-1]) + 1.0).astype(np.float32)
    sums = [np.zeros((len(t), len(TAGS)), np.float32) for t in texts]
    total = [np.zeros((len(t), 1), np.float32) for t in texts]
    for a in range(0, len(ids), 4 * DECODED):
        for (n, start, size), row in zip(where[a : a + 4 * DECODED], tagger.scores(np.stack(ids[a : a + 4 * DECODED])), strict=True):
            sums[n][start : start + size] += row[:size] * weight[:size, None]
            total[n][start : start + size] += weight[:size, None]
    return [s / t for s, t in zip(sums, total, strict=True)]


def plausible(kind: str, text: str) -> bool:
    """Whether a span of the network has the shape of its kind."""
    digits = len(digits_of(text))
    if kind == "email":
        return bool(re.fullmatch(r"[\w.%+-]+ ?(?:@|\(at\)|\[at\]| at ) ?[\w-]+(?:\.[\w-]+)+", text))
    if kind == "phone":
        return 9 <= digits <= 15 and bool(re.fullmatch(r"[+(]?[0-9][0-9 ().-]*[0-9]", text)) and bool(re.search(r"[ ().-]", text))
    if kind == "card":
        return 13 <= digits <= 19 and luhn(digits_of(text)) and bool(re.fullmatch(r"[0-9][0-9 .-]*[0-9]", text))
    return bool(re.fullmatch(r"[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}", text)) and all(int(x) <= 255 for x in re.findall("[0-9]+", text))


def widened(text: str, start: int, end: int) -> tuple[int, int]:
    """A span with the letters and digits that go on at its ends."""
    while start > 0 and text[start - 1].isalnum():
        start -= 1
    while end < len(text) and text[end].isalnum():
        end += 1
    return start, end


def whole_address(text: str, around: list[tuple[int, int]], start: int, end: int) -> tuple[int, int]:
    """The first address of ``around`` that a span meets, from end to end, else the span."""
    at = bisect.bisect_right(around, start, key=lambda x: x[1])
    while at < len(around) and around[at][0] < end:
        if plausible("email", text[slice(*around[at])]):
            return around[at]
        at += 1
    return start, end


def tagged_spans(path: np.ndarray) -> Iterator[Span]:
    """Spans of a tag sequence; a span begins at its first tag and ends where the kind changes."""
    start = None
    for i, tag in enumerate([*path.tolist(), 0]):
        if start is not None and (tag == 0 or tag % 2 or (tag - 1) // 2 != (path[start] - 1) // 2):
            yield KINDS[(int(path[start]) - 1) // 2], start, i
            start = None
        if tag and start is None:
            start = i


def grouped(parts: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """Stretches sorted by length in groups that are bounded when padded to their longest."""
    group: list[tuple[int, int, int]] = []
    for part in parts:
        if group and (len(group) == DECODED or (len(group) + 1) * (part[2] - part[1]) > PADDED):
            yield group
            group = []
        group.append(part)
    if group:
        yield group


def all_spans(tagger: Tagger | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    every = [list(b) for b in base]
    if tagger is not None:
        parts = [(n, a, b) for n, t in enumerate(texts) for a, b in stretches(t)]
        parts.sort(key=lambda x: x[2] - x[1])
        around = [addresses(t) for t in texts]
        taken = [{i for _, s, e in b for i in range(s, e)} for b in base]
        for group in grouped(parts):
            scores = merged_scores(tagger, [texts[n][a:b] for n, a, b in group])
            sizes = np.array([len(s) for s in scores])
            padded = np.zeros((len(group), sizes.max(), len(TAGS)), np.float32)
            for r, s in enumerate(scores):
                padded[r, : len(s)] = s
            for (n, a, _), path in zip(group, tagger.best_tags(padded, sizes), strict=True):
                for kind, s, e in tagged_spans(path):
                    s, e = widened(texts[n], a + s, a + e)
                    if kind == "email":
                        s, e = whole_address(texts[n], around[n], s, e)
                    if plausible(kind, texts[n][s:e]) and taken[n].isdisjoint(range(s, e)):
                        every[n].append((kind, s, e))
                        taken[n].update(range(s, e))
    rank = {k: i for i, k in enumerate(KINDS)}
    return [(b, sorted(e, key=lambda x: (rank[x[0]], x[1], x[2]))) for b, e in zip(base, every, strict=True)]


def varied(kind: str, value: str, pick: random.Random) -> str:
    """A span in another writing, or as it is."""
    if kind == "email" and pick.random() < 0.4:
        return value.replace("@", pick.choice([" at ", "(at)", " (at) ", " @ ", "[at]", " [at] "]), 1)
    if kind == "phone" and pick.random() < 0.5:
        shorter = re.sub(r"^\+[0-9]+[ .-]*", "", value)
        return shorter if sum(c.isdigit() for c in shorter) >= 7 else value
    return value


def windows_of(text: str, seed: int = 0) -> Iterator[tuple[str, list[Span]]]:
    """All windows of the stretches of a text, at most ``WIDTH`` long, with base spans in varied writings."""
    spans, i = sorted(base_spans(text), key=lambda x: (x[1], x[2])), 0
    for a, b in stretches(text):
        pick = random.Random(f"{seed}:{a}:{text[a : a + WIDTH]}")
        out, at, new = [], a, []
        size = 0
        while i < len(spans) and spans[i][1] < b:
            k, s, e = spans[i]
            i += 1
            if s < at:
                continue
            value = varied(k, text[s:e], pick)
            out += [text[at:s], value]
            size += s - at + len(value)
            new.append((k, size - len(value), size))
            at = e
        part, first = "".join([*out, text[at:b]]), 0
        for start in range(0, max(1, len(part) - STRIDE), STRIDE):
            while first < len(new) and new[first][2] <= start:
                first += 1
            inside = itertools.takewhile(lambda x, end=start + WIDTH: x[1] < end, itertools.islice(new, first, None))
            yield part[start : start + WIDTH], [(k, s - start, e - start) for k, s, e in inside]


def labelled_windows(docs: DataFrame, sample: int = SAMPLE, seed: int = 0) -> list[tuple[str, list[Span]]]:
    """``WINDOWS`` training windows at most of a bounded sample, with their labelled spans.

    Windows come from whole texts. A hash orders those of a document, and every
    document gives its first before any gives its second, so that no long text
    takes the place of others.
    """
    signed = docs.where(F.col("text").rlike("[0-9@]"))
    chosen = signed.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL")  # bounded by the sample

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                hashed = ((xxhash.xxh3_64_intdigest(part.encode()) >> 1, part, spans) for part, spans in windows_of(text, seed))
                found = [
                    {"turn": i, "hash": h, "part": part, "kind": [k for k, _, _ in spans], "start": [s for _, s, _ in spans], "end": [e for _, _, e in spans]}
                    for i, (h, part, spans) in enumerate(heapq.nsmallest(WINDOWS, hashed))
                ]
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    kind = "turn int, hash long, part string, kind array<string>, start array<int>, end array<int>"
    schema = to_arrow_schema(T.StructType.fromDDL(kind))
    cuts = rows.mapInArrow(cut, kind).orderBy("turn", "hash", "part", "kind", "start", "end").limit(WINDOWS).collect()
    return [(r.part, list(zip(r.kind, r.start, r.end, strict=True))) for r in cuts]


def detect(docs: DataFrame, tagger: Tagger | None, text: str = "text", masked: str | None = None) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``; ``masked`` names a column for the text with spans blanked."""
    span = T.ArrayType(T.StructType.fromDDL("kind string, start int, end int"))
    added = [T.StructField("base_spans", span), T.StructField("spans", span)]
    added += [T.StructField(masked, T.StringType())] if masked else []
    names = {f.name for f in added}
    schema = T.StructType([f for f in docs.schema if f.name not in names] + added)
    arrow = to_arrow_schema(schema)
    as_dicts = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            found = all_spans(tagger, texts)
            new = {"base_spans": [as_dicts(b) for b, _ in found], "spans": [as_dicts(e) for _, e in found]}
            if masked:
                plain = batch.column(text).to_pylist()
                new[masked] = [mask(p, e) if e else p for p, (_, e) in zip(plain, found, strict=True)]
            columns = [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name).cast(f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind; of spans that overlap, all of it by the first kind."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Tagger | None:
    return train(labelled_windows(docs, sample))
