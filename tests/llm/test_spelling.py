"""Spelling variants against every pair of words."""

import random
import re
import zlib
from collections import Counter

from brute import edge_docs

from foliograph.llm import spelling


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows, change=None):
    out = Counter()
    for doc, text, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if change and h % change == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += bool(w)
    return +out


def plain_variants(counts, least=5, length=6, times=5):
    vocabulary = {w: n for w, n in counts.items() if len(w) >= length and n >= least}
    form, near = {}, {}
    for w, n in vocabulary.items():
        near[w] = [x for x in vocabulary if x != w and is_near(w, x)]
        best = min(near[w], key=lambda x: (-vocabulary[x], x), default=None)
        form[w] = best if best and vocabulary[best] >= times * n else None
    rows = []
    for w, n in vocabulary.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), vocabulary[form[w]] if form[w] else None))
    return sorted(rows)


def words_of(pick):
    words = {"".join(pick.choice("abé") for _ in range(pick.randint(6, 9))) for _ in range(150)}
    for size in (16, 32):  # about the length at which tries give way to digests
        base = "".join(pick.choice("ab") for _ in range(size))
        words |= {base, base[:10] + base[11:], base + "a", base[:5] + "c" + base[6:], base[:-1] + "z", "a" + base, base + "zz"}
    return sorted(words | {"x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499})


def test_variants_equal_all_pairs(spark):
    pick = random.Random(4)
    counts = {w: pick.choice([4, 5, 6, 30, 30, 150, 151, 1000]) for w in words_of(pick)}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == plain_variants(counts)


def test_counts(awkward, nothing):
    for change in (None, 3):
        got = {r.word: r.n for r in spelling.count_words(awkward, change).collect()}
        assert got == plain_counts(edge_docs(), change)
    assert spelling.variants(spelling.count_words(nothing)).count() == 0


def test_clashing_columns_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "Straße straße ×÷ ÀÉ", 1, "x"), (None, None, 2, "y")], "doc_id long, text string, n int, word string")
    assert {r.word: r.n for r in spelling.count_words(docs, 199).collect()} == plain_counts([(None, "Straße straße ×÷ ÀÉ")], 199)


def test_full_tables_are_handed_on(awkward, monkeypatch):
    monkeypatch.setattr(spelling, "TABLE", 3)
    assert {r.word: r.n for r in spelling.count_words(awkward).collect()} == plain_counts(edge_docs())
