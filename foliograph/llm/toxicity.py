"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity grades are ordered: 0 clean, 1 mild, 2 severe. All thresholds share one
weight vector: P(grade <= k) = sigmoid(threshold_k - w.x), and the output is the
expected grade, the sum over k of P(grade > k). A document is toxic if
P(grade > 0) >= 0.5.

Features are whole words and beginnings of words (``PREFIXES`` bytes), in lower
case. Those are kept whose share among toxic rows exceeds that among clean ones
by ``LEAST_Z`` standard errors. A kept feature has the value 1 + ln(count); two
more say whether there is any and how dense they are. Labels say toxic or not;
toxic rows above the median density of kept features are the severe ones.

The model is fitted on at most ``SAMPLE`` labelled documents, picked by a hash of
their ids; every document is scored over its whole text.

Defined cases: labels with a null id or null ``toxic`` are left out; a document
with several labels is toxic if one says so; without toxic or without clean
labels nothing is learnt and the severity is that of the only kind seen (0 where
there is no label). A null text is an empty one. Repeated rows are scored each.
Extra columns pass through; output columns replace columns of the same name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliograph.llm.common import staged

#: Labelled documents that the model is fitted on at most.
SAMPLE = 8_000
#: Features that the model has at most; fewest documents of one; least difference in standard errors.
FEATURES, LEAST_DOCS, LEAST_Z = 384, 4, 5.0
#: Lengths of the beginnings of words, in bytes.
PREFIXES = (4, 5, 6, 7)
#: Words whose features a process keeps at hand; a full table starts anew.
KEPT = 300_000
#: Weight of the squared weights in the loss.
PENALTY = 2.0
#: Bytes that part words: all of ASCII but letters. Capitals become small.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


@dataclass(frozen=True)
class OrdinalModel:
    """Features with their weights, the weights for any and for density, and rising thresholds."""

    weights: dict[bytes, float]
    whole: tuple[float, float]
    thresholds: tuple[float, ...]

    def chances(self, text: str | None, memo: dict[bytes, tuple[bytes, ...]]) -> np.ndarray:
        """P(grade > k) for each threshold; ``memo`` keeps the features of words between calls."""
        parts = words(text)
        hits = Counter(f for found in map(memo.__getitem__, parts) if found for f in found)
        score = sum(self.weights[f] * (1 + np.log(n)) for f, n in hits.items())
        score += self.whole[0] * bool(hits) + self.whole[1] * density(sum(hits.values()), len(parts))
        return sigmoid(score - np.array(self.thresholds))


class Hits(dict):
    """The kept features of each word."""

    def __init__(self, kept: dict[bytes, float]):
        self.kept = kept

    def __missing__(self, word: bytes) -> tuple[bytes, ...]:
        if len(self) >= KEPT:
            self.clear()
        found = self[word] = tuple(f for f in features(word) if f in self.kept)
        return found


def features(word: bytes) -> list[bytes]:
    return [b"=" + word] + [b"^" + word[:k] for k in PREFIXES if len(word) > k]


def density(hits: float, n_words: int) -> float:
    return float(np.log1p(300 * hits / (n_words + 30)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LETTERS).split()


def labelled_features(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic, n_words, feature, n) of the labelled sample; without words one row without a feature."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # so small that it can be sent to all
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    columns = "doc_id long, toxic int, n_words int, feature binary, n int"
    schema = to_arrow_schema(T.StructType.fromDDL(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = words(row["text"])
                counts: Counter = Counter()
                for word, n in Counter(parts).items():
                    for f in features(word):
                        counts[f] += n
                counts = counts or {None: 0}
                n = len(counts)
                data = [[row["doc_id"]] * n, [row["toxic"]] * n, [len(parts)] * n, list(counts), list(counts.values())]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(data, schema, strict=True)], schema=schema)

    return texts.mapInArrow(run, columns)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> OrdinalModel:
    rows = staged(labelled_features(docs, labels, sample), "toxicity-sample")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count_distinct("doc_id").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return OrdinalModel({}, (0.0, 0.0), (-60.0 if bad else 60.0, 60.0))
    share = (F.col("a") + F.col("b")) / (bad + good)
    z = (F.col("a") / bad - F.col("b") / good) / F.sqrt(share * (1 - share) * (1 / bad + 1 / good))
    chosen = (
        rows.where(F.col("feature").isNotNull())
        .groupBy("feature")
        .agg(F.count_if(F.col("toxic") > 0).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
        .where((F.col("a") + F.col("b") >= LEAST_DOCS) & (share < 1))
        .withColumn("z", z)
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "feature")
        .limit(FEATURES)
    )
    names = [bytes(r.feature) for r in chosen.select("feature").collect()]
    at = {f: i for i, f in enumerate(names)}
    # only rows of kept features come to the driver; documents with none of them are known by their number
    used = rows.join(F.broadcast(chosen.select("feature")), "feature").select("doc_id", "toxic", "n_words", "feature", "n")
    found: dict[int, dict[int, int]] = {}
    facts: dict[int, tuple[int, int]] = {}
    for doc, toxic, n_words, feature, n in used.collect():
        found.setdefault(doc, {})[at[bytes(feature)]] = n
        facts[doc] = toxic, n_words
    docs_at, d = sorted(found), len(names)
    x, y = np.zeros((len(found) + 2, d + 2)), np.zeros(len(found) + 2, int)
    for i, doc in enumerate(docs_at):
        x[i, list(found[doc])] = 1 + np.log(list(found[doc].values()))
        x[i, d:] = 1, density(sum(found[doc].values()), facts[doc][1])
        y[i] = facts[doc][0]
    weight = np.ones(len(x))
    for toxic in (0, 1):
        y[len(found) + toxic] = toxic
        weight[len(found) + toxic] = sizes[toxic] - sum(t == toxic for t, _ in facts.values())
    hits = x[:-2][y[:-2] == 1, d + 1]
    y[:-2][(y[:-2] == 1) & (x[:-2, d + 1] > (np.median(hits) if len(hits) else 0))] = 2
    weights, thresholds = cumulative_link(x, y, weight)
    kept = dict(zip(names, weights[:d].tolist(), strict=True))
    return OrdinalModel(kept, (float(weights[d]), float(weights[d + 1])), tuple(thresholds.tolist()))


def cumulative_link(x: np.ndarray, y: np.ndarray, weight: np.ndarray, levels: int = 3, steps: int = 800) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the penalised likelihood; thresholds rise by exp of their gaps."""
    total = max(weight.sum(), 1)
    above = [max(weight[y > k].sum(), 0.5) / total for k in range(levels - 1)]
    first = -np.log(above[0] / max(1 - above[0], 1e-9))
    gaps = np.diff([-np.log(a / max(1 - a, 1e-9)) for a in above])
    p = np.concatenate([np.zeros(x.shape[1]), [first], np.log(np.maximum(gaps, 0.1))])
    m, v, d = np.zeros_like(p), np.zeros_like(p), x.shape[1]
    for t in range(1, steps + 1):
        w, gap = p[:d], np.exp(p[d + 1 :])
        theta = p[d] + np.concatenate([[0.0], np.cumsum(gap)])
        cut = np.concatenate([[-60.0], theta, [60.0]])
        eta = x @ w
        hi, lo = sigmoid(cut[y + 1] - eta), sigmoid(cut[y] - eta)
        chance = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / chance, lo * (1 - lo) / chance
        by_eta = weight * (d_hi - d_lo)
        by_theta = np.array([(weight * d_lo)[y == k + 1].sum() - (weight * d_hi)[y == k].sum() for k in range(levels - 1)])
        grad = np.concatenate([x.T @ by_eta + PENALTY * w, [by_theta.sum()], [by_theta[k + 1 :].sum() * gap[k] for k in range(levels - 2)]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        rate = 0.1 * (1 - t / (steps + 1))
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return p[:d], p[d] + np.concatenate([[0.0], np.cumsum(np.exp(p[d + 1 :]))])


def score(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (expected grade) and ``toxic``."""
    added = [T.StructField("severity", T.DoubleType()), T.StructField("toxic", T.BooleanType())]
    schema = T.StructType([f for f in docs.schema if f.name not in ("severity", "toxic")] + added)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Hits(model.weights)
        for batch in batches:
            chances = [model.chances(t.as_py(), memo) for t in batch.column(text)]
            new = {"severity": [float(c.sum()) for c in chances], "toxic": [bool(c[0] >= 0.5) for c in chances]}
            columns = [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name).cast(f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)
