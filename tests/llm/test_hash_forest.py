"""Nearest neighbours by the hash forest against all pairs."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliograph.llm import hash_forest
from foliograph.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string"


def usable(rows):
    least = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = tuple(float(np.float32(x)) + 0.0 for x in v)
            least[i] = min(least.get(i, v), v)
    return least


def all_pairs(rows, queries, k):
    whole, out = usable(rows), {}
    for q in queries:
        a = np.array(whole[q])
        found = []
        for i, b in whole.items():
            if i != q and len(b) == len(a):
                b = np.array(b)
                found.append((-(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), i))
        out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def found_by(frame, k=5, step=50):
    out = {}
    for r in hash_forest.search(frame, F.col("vec_id") % step == 0, k).orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hit / max(1, sum(len(w) for w in want.values()))


def test_few_rows_are_all_found(spark):
    v = lambda *x: list(map(float, x))
    rows = [(0, v(1, 0, 2)), (1, v(1, 0, 2)), (2, v(2, 0, 4)), (3, v(-1, 5, 0)), (4, None), (5, []), (6, v(0, 0, 0)), (7, v(1, float("nan"), 1)),
            (8, [1.0, None, 2.0]), (9, v(1, float("inf"), 1)), (None, v(1, 1, 1)), (3, v(-1, 5, 0)), (10, v(3, 4)), (50, v(1, -1, 1)), (100, v(1, 2)), (150, v(1,)),
            (200, v(1e38, 1e38, -1e38)), (250, v(1, 0, 2))]
    got = found_by(spark.createDataFrame([(i, e, 1, 2, "x") for i, e in rows], SCHEMA))
    want = all_pairs(rows, [0, 50, 100, 200, 250], 5)
    assert {q: [i for i, _ in w] for q, w in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))


def test_no_queries_no_rows(spark):
    assert found_by(spark.createDataFrame([], SCHEMA)) == {}
    assert found_by(spark.createDataFrame([(1, [1.0], 1, 1, "x")], SCHEMA)) == {}


def test_many_copies_and_split_cells(spark, monkeypatch):
    """A third of the rows is one vector, others lie close together; cells are dealt to several blocks."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 16))
    x = np.concatenate([np.tile(centres[0], (400, 1)), centres[rng.integers(0, 40, 800)] + rng.standard_normal((800, 16)) * 0.1]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    monkeypatch.setattr(hash_forest, "BLOCK", 64)
    got = found_by(spark.createDataFrame([(i, e, 1, 2, "x") for i, e in rows], SCHEMA), step=10)
    want = all_pairs(rows, range(0, 1200, 10), 5)
    assert recall(got, want) >= 0.9 and all(len(w) == 5 for w in got.values())
    assert got[0] == want[0] and got[10] == want[10]  # copies: ties by id


def test_common_bits():
    a = np.array([0, 1, 2**63, 5, 2**40], np.uint64)
    b = np.array([0, 0, 0, 4, 2**40 + 1], np.uint64)
    assert hash_forest.common_bits(a, b).tolist() == [64, 63, 0, 63, 63]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")
def test_recall_on_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {}
    for r in QUERIES["op13_nearest_forest"](spark, SF).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = all_pairs(rows, [i for i in usable(rows) if i % 50 == 0], 5)
    assert recall(got, want) >= 0.9
