"""Mixing sources to target weights by Poisson replication, in built-in functions only.

Each source has a mean repetition rate: its target share of all rows over its
own rows. A document's number of copies inverts the Poisson distribution of
that mean at a number in (0, 1) hashed from (seed, document), so any executor
that works on a document again draws the same count. Means above ``PART`` are
split: a Poisson number is the sum of independent ones with a share of the mean
each. Copies are exploded and ordered by a hash over the whole output, which
shuffles them globally and gives one order whatever the partitioning.

Defined cases: a null source is a source of its own, a null ``doc_id`` hashes as
its own value, repeated rows of one ``doc_id`` get the same count each, a source
without a weight (or with weight 0) gets no copies, empty input gives no rows.
Extra columns pass through; ``copy`` is replaced if there is one already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import join_small, uniform

#: Largest mean drawn at once, and the largest count that such a mean can give in double precision.
PART, MOST = 16.0, 96


def poisson_steps(mean: Column) -> Column:
    """The distribution function at 0, 1, ... MOST, as an array; ``mean`` is at most PART."""
    none = F.exp(-mean)

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    start = F.struct(none.alias("p"), F.array(none).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST)), start, step)["cdf"]


def draws(seed: int, key: Column, parts: Column, steps: Column) -> Column:
    """The Poisson number of ``key``: over all parts, the steps that lie below its hashed number."""

    def one(total: Column, part: Column) -> Column:
        below = F.transform(F.array(uniform(F.lit(seed), key, part)), lambda u: F.size(F.filter(steps, lambda s: s < u)))
        return total + F.element_at(below, 1)

    return F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), one)


def source_rates(docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5) -> tuple[DataFrame, int]:
    """(source, rate) and the number of sources.

    ``weights`` has (source, weight); without it a source weighs its number of
    rows to the ``power``: 1 keeps the mix, 0 makes all sources equal. Weights of
    a source that is given more than once are added up; null, negative, infinite
    and NaN weights count as nothing.
    """
    rows = docs.groupBy("source").agg(F.count("*").alias("_n"))
    if weights is None:
        rows = rows.withColumn("_w", F.pow(F.col("_n").cast("double"), F.lit(power)))
    else:
        given = F.col("weight").cast("double")
        usable = F.when((given > 0) & (given < float("inf")), given)
        w = weights.groupBy(F.col("source").alias("_s")).agg(F.sum(usable).alias("_w"))
        rows = rows.join(w, rows["source"].eqNullSafe(w["_s"]), "left").drop("_s")
        rows = rows.withColumn("_w", F.coalesce("_w", F.lit(0.0)))
    whole = rows.agg(F.sum("_n").alias("n"), F.sum("_w").alias("w"), F.count("*").alias("sources")).first()
    scale = (whole.n or 0) / whole.w if whole.w else 0.0
    rate = F.col("_w") / F.col("_n") * F.lit(float(scale))
    return rows.select("source", rate.alias("rate")), whole.sources


def mix(docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5, seed: int = 7) -> DataFrame:
    """``docs`` replicated to the target weights and shuffled globally, with ``copy`` counted from 1.

    All columns of ``docs`` stay but one of the name ``copy``.
    """
    rates, sources = source_rates(docs, weights, power)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    docs = docs.drop("copy")
    end = "_" * (1 + max((len(c) for c in docs.columns), default=0))  # longer than any column's name, so no clash
    own_source, own_parts, own_steps, own_count = (name + end for name in ("source", "parts", "steps", "count"))
    plan = rates.select(
        F.col("source").alias(own_source), parts.alias(own_parts), poisson_steps(F.col("rate") / parts).alias(own_steps)
    )
    count = draws(seed, docs["doc_id"], F.col(own_parts), F.col(own_steps))
    drawn = join_small(docs, plan, docs["source"].eqNullSafe(plan[own_source]), sources).withColumn(own_count, count)
    copies = drawn.where(F.col(own_count) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(own_count))))
    order = F.xxhash64(F.lit(seed), "doc_id", "copy")
    return copies.orderBy(order, "doc_id", "copy").drop(own_source, own_parts, own_steps, own_count)
