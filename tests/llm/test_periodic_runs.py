"""Runs by grammar compression against every period and start."""

import os
import random

import numpy as np
import pytest
from brute import edge_docs, run_row, tailed, word_runs, words

from foliograph.llm import periodic_runs
from foliograph.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def made(pick):
    """Words with runs inside runs, cut runs, repeats that are no runs, and noise."""
    few = "abcdefgh"[: pick.randint(1, 5)]
    w = [pick.choice(few) for _ in range(pick.randint(0, 50))]
    if pick.random() < 0.6:
        unit = [pick.choice(few) for _ in range(pick.randint(1, 9))]
        if pick.random() < 0.5:
            unit = unit * pick.randint(1, 12) + [pick.choice("xyz")]
        w[pick.randint(0, len(w)) : 0] = unit * pick.randint(2, 9) + unit[: pick.randint(0, len(unit))]
    return w * pick.randint(1, 6) if pick.random() < 0.3 else w


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    pick = random.Random(seed)
    for _ in range(25):
        docs = [made(pick) for _ in range(pick.randint(1, 25))]
        n, runs, kept = periodic_runs.batch_runs([" ".join(w).encode() for w in docs])
        assert n == [len(w) for w in docs]
        for w, found, text in zip(docs, runs, kept, strict=True):
            assert [(r["start"], r["period"], r["length"]) for r in found] == word_runs(w)
            gone = {i for s, q, size in word_runs(w) for i in range(s + q, s + size)}
            assert text.decode() == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_grammar_gives_back_its_text():
    ids = np.array([0, 1, 0, 1, 0, 1, 2, 2, 2, 2, 2, 0, 1, 2, 2, 3])
    g = periodic_runs.Grammar(ids)

    def expand(x):
        return [x] if x < g.first else expand(g.left[x - g.first]) + expand(g.right[x - g.first])

    assert [y for x in g.start for y in expand(x)] == ids.tolist()
    pairs = list(zip(g.start, g.start[1:]))
    assert len(g.left) and len(pairs) == len(set(pairs))
    rule, place = g.derivations(np.ones(len(g.left), bool))
    for r, p in zip(rule, place):
        assert expand(g.first + r) == ids[p : p + g.size[g.first + r]].tolist()


def test_long_texts_take_little_work():
    for text, runs in (("x " * 100_000, 1), ("a b c " * 50_000, 1), ("x " * 99 + "y ", 1), (" ".join(f"a b c {i}" for i in range(20_000)), 0)):
        assert len(periodic_runs.batch_runs([text.encode()])[1][0]) == runs
    inner = "x x x x x x y " * 3000
    assert len(periodic_runs.batch_runs([inner.encode()])[1][0]) == 3001


def test_awkward_documents(awkward, nothing):
    rows = periodic_runs.find_runs(awkward).collect()
    assert sorted((r.doc_id, r.n_words, r.collapsed) for r in rows) == sorted(
        (d, len(words(t)), collapsed(words(t))) for d, t, *_ in edge_docs()
    )
    assert periodic_runs.find_runs(nothing).count() == 0
    assert periodic_runs.find_runs(awkward.selectExpr("doc_id", "text", "1 AS runs", "2 AS collapsed")).count() == len(rows)


def collapsed(w):
    gone = {i for s, q, size in word_runs(w) for i in range(s + q, s + size)} if len(w) < 5000 else set()
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_null_id_keeps_its_text(spark):
    docs = spark.createDataFrame([(None, "a b c"), (5, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text) for r in periodic_runs.with_tails(docs).collect()) == [("5", None), ("None", "a b c")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")
def test_query_equals_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    checked = [r for r in docs if len(r.text or "") < 8_000]
    assert any(got[r.doc_id][0] for r in checked)
    for r in checked:
        assert got[r.doc_id] == run_row(r.doc_id, tailed(r.doc_id, words(r.text)))
