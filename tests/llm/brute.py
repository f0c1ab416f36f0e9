"""Plain versions of the operators, for small inputs, and documents with awkward cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

SPACE = re.compile(r"[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def edge_docs(seed=0):
    """Null, empty, blank, repeated, very long, Unicode and near-equal texts; null ids, languages and sources."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    base, passage = text(120), text(60)
    near = base.split(" ")
    near[60] = "other"
    texts = [
        None, "", " \n\t ", base, base, base.upper(), " ".join(near), base + " tail of it", passage, text(40) + " " + passage + " " + text(50),
        passage + "\n" + text(90), "one two three", "one two three", "one", "x" * 30_000, text(6000), "a b c a b c a b c " * 40,
        "é ß 世界 🙂 ▁ \x00   <s> <0x41>", "line one\nline one\n\nline two\nline one", passage,
    ]
    rows = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[4])  # a row that comes twice
    return rows


def shingles(text, size=5):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def near_duplicates(rows, num=3, den=4):
    """doc_id -> (shingles, component) by all pairs that share a shingle."""
    sets, holders, parent = {}, {}, {}
    for doc, text in rows:
        sets[doc] = shingles(text)
        parent[doc] = doc

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(doc)
    for doc, s in sets.items():
        for other, both in Counter(e for g in s for e in holders[g] if e < doc).items():
            if den * both >= num * (len(s) + len(sets[other]) - both):
                a, b = sorted((root(doc), root(other)))
                parent[b] = a
    return {doc: (len(s), root(doc)) for doc, s in sets.items()}


def without_repeats(rows, keep="none", length=200):
    """Each row's (id, bytes left, spans removed); strings are compared at every position."""
    data = [(doc, (text or "").encode()) for doc, text in rows]
    count, least = Counter(), {}
    for r, (doc, b) in enumerate(data):
        for i in range(len(b) - length + 1) if doc is not None else ():
            k = b[i : i + length]
            count[k] += 1
            least[k] = min(least.get(k, (doc, i, r)), (doc, i, r))
    out = []
    for doc, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1) if doc is not None else ():
            k = b[i : i + length]
            if count[k] > 1 and (keep == "none" or least[k][:2] != (doc, i)):
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, bytes(c for c, g in zip(b, gone) if not g), spans))
    return out


def quality_counts(text):
    text = text or ""
    w, lines = words(text), [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def poisson_count(key, mean, seed=7, part=16.0):
    parts = max(1, math.ceil(mean / part))
    total = 0
    for i in range(1, parts + 1):
        u = (int(hashlib.md5(f"{seed}:{'~' if key is None else key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        p = c = math.exp(-mean / parts)
        k = 0
        while c < u and k < 96:
            k += 1
            p *= mean / parts / k
            c += p
            total += 1
    return total


def top_k(rows, queries, k):
    """query_id -> [(score, vec_id)] by all inner products of distinct rows."""
    whole = {
        (i, tuple(math.floor(64 * x) for x in v))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    out = {}
    for q, a in whole:
        if q in queries:
            found = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b)]
            out.setdefault(q, []).extend(found)
    return {q: [(-s, i) for s, i in sorted(f)[:k]] for q, f in out.items()}


def word_runs(w):
    """(start, period, length) of the runs of four periods and six words, by every period and start."""
    n, least = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                least.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in least.items())


def tailed(doc, w):
    """The words of a document after its tail is made periodic, as the id's digest says."""
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(w)
    if doc is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def run_row(doc, w):
    """n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 of a document's words."""
    runs = word_runs(w)
    top = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    best = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    text = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
    return len(runs), *best, sha(text), sha(" ".join(x for i, x in enumerate(w) if i not in gone))
