"""Quality rules with adaptive thresholds, in built-in functions only.

Each document gets counts (words, symbols, repeated lines, words in repeated
3-word windows) and shares made of them. The shares of all documents go into a
quantile sketch for each language and source: counts of bins with six
significant bits, so two sketches merge by adding counts, in any order, with
the same result. Thresholds are read from the sketches, and each document is
held against those of its language and source by a join. A group with fewer
than ``LEAST_ROWS`` rows takes the merged sketch of its language, or else of all.

Defined cases: a null text has no words; null languages and sources are groups
of their own; repeated rows count as often as they come; an empty table gives
no rows. Columns ``doc_id``, ``text``, ``lang`` and ``source`` are read, others
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import join_small, let, staged

SPACES = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Positions are packed behind hashes up to this many words; longer texts sort pairs.
PACKED_BITS = 21
#: Fewest rows that a group's own sketch needs.
LEAST_ROWS = 200
#: Spread beyond the upper decile, as a multiple of its distance to the median.
SPREAD = 4
#: Shares per 10,000 (mean word length: per 100 characters) and the least distance kept to the decile.
SHARES = {
    "symbols": ("(10000 * n_symbols) div greatest(word_chars, 1)", 1500),
    "dup_lines": ("(10000 * n_dup_lines) div greatest(n_lines, 1)", 2500),
    "repeats": ("(10000 * n_repeat_words) div greatest(n_words, 1)", 1500),
    "word_length": ("(100 * word_chars) div greatest(n_words, 1)", 400),
}


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACES}+"), "")


def repeated_words(words: Column) -> Column:
    """Number of words in 3-word windows that occur twice or more.

    Windows are sorted by a hash with their position behind it; equal neighbours
    in that order repeat, and the union of their words is summed up in the order
    of positions.
    """
    three = lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    starts = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    mask = (1 << PACKED_BITS) - 1

    def packed(w: Column, i: Column) -> Column:
        return F.shiftleft(three(w, i), PACKED_BITS).bitwiseOR(i.cast("long"))

    def same(a: Column, b: Column) -> Column:
        """Whether two packed windows have equal words; hashes alone are too short here."""
        i, j = a.bitwiseAND(F.lit(mask)).cast("int"), b.bitwiseAND(F.lit(mask)).cast("int")
        alike = [F.get(words, i + k) == F.get(words, j + k) for k in range(3)]
        return F.coalesce((F.shiftright(a, PACKED_BITS) == F.shiftright(b, PACKED_BITS)) & alike[0] & alike[1] & alike[2], F.lit(False))

    short = let(
        F.sort_array(F.transform(starts, packed)),
        lambda s: F.transform(
            F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1))), lambda x: x.bitwiseAND(F.lit(mask)).cast("int")
        ),
    )
    pair = lambda w, i: F.struct(three(w, i).alias("h"), i.alias("i"))
    equal = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    long = let(
        F.array_sort(F.transform(starts, pair)),
        lambda s: F.transform(F.filter(s, lambda x, j: equal(x, F.get(s, j - 1)) | equal(x, F.get(s, j + 1))), lambda x: x["i"]),
    )
    at = F.sort_array(F.when(F.size(words) <= mask, short).otherwise(long))
    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    more = lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["end"])).alias("n"), (i + 3).alias("end"))
    return F.aggregate(at, none, more)["n"]


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source) with the counts that the rules use."""
    text = F.coalesce("text", F.lit(""))
    counts = let(
        words_of(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    lines = let(
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")),
    )
    rows = docs.select(
        "doc_id", "lang", "source", counts.alias("w"), lines.alias("l"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols")
    )
    rows = rows.select("doc_id", "lang", "source", "w.*", "l.*", "n_symbols")
    return rows.withColumns({k: F.expr(e) for k, (e, _) in SHARES.items()})


def bin_of(value: Column) -> Column:
    """``value`` with its six leading bits kept."""
    bits = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)


def sketches(rows: DataFrame, by: list[str]) -> DataFrame:
    """Quantile sketches: (*by, share, bin, n)."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("share"), bin_of(F.col(k)).alias("bin")) for k in SHARES]))
    binned = rows.select(*by, each.alias("x")).select(*by, "x.*")
    return binned.groupBy(*by, "share", "bin").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of larger groups: counts added up."""
    return sketch.groupBy(*by, "share", "bin").agg(F.sum("n").alias("n"))


def thresholds(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(*by, rows, highest share allowed for each share) from the sketches."""
    bins = F.array_sort(F.collect_list(F.struct("bin", "n")))  # as many as there are bins, whatever the rows
    grouped = sketch.groupBy(*by, "share").agg(bins.alias("bins"), F.sum("n").alias("rows"))

    def quantile(per_100: int) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("at"))

        def step(a: Column, b: Column) -> Column:
            return F.struct(
                (a["seen"] + b["n"]).alias("seen"),
                F.when(a["seen"] * 100 < F.col("rows") * per_100, b["bin"]).otherwise(a["at"]).alias("at"),
            )

        return F.aggregate("bins", start, step)["at"]

    least = F.element_at(F.create_map(*[F.lit(x) for k, (_, m) in SHARES.items() for x in (k, m)]), F.col("share"))
    upper = quantile(90) + F.greatest(SPREAD * (quantile(90) - quantile(50)), least.cast("long"))
    wide = grouped.withColumn("upper", upper).groupBy(*by)
    return wide.agg(
        F.max("rows").alias("rows"), *[F.max(F.when(F.col("share") == k, F.col("upper"))).alias(f"most_{k}") for k in SHARES]
    )


def adaptive_thresholds(rows: DataFrame) -> DataFrame:
    """Thresholds for each (lang, source), from the smallest group around it that has enough rows."""
    most = [f"most_{k}" for k in SHARES]
    own = sketches(rows, ["lang", "source"])
    by_lang, overall = merged(own, ["lang"]), merged(own, [])
    own = thresholds(own, ["lang", "source"])
    lang = thresholds(by_lang, ["lang"]).select(F.col("lang").alias("_lang"), F.col("rows").alias("_rows"), *[F.col(m).alias(f"_{m}") for m in most])
    both = own.join(lang, own["lang"].eqNullSafe(lang["_lang"]), "left")
    every = thresholds(overall.withColumn("_all", F.lit(0)), ["_all"]).select(*[F.col(m).alias(f"all_{m}") for m in most], F.col("_all"))
    both = both.withColumn("_key", F.lit(0)).join(every, F.col("_key") == F.col("_all"), "left")  # one row
    pick = lambda m: F.when(F.col("rows") >= LEAST_ROWS, F.col(m)).when(F.col("_rows") >= LEAST_ROWS, F.col(f"_{m}")).otherwise(F.col(f"all_{m}"))
    return both.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *[pick(m).alias(m) for m in most])


def judge(docs: DataFrame) -> DataFrame:
    """Counts, thresholds and verdict of each document."""
    rows = staged(measures(docs), "quality-measures")
    limits = staged(adaptive_thresholds(rows), "quality-thresholds")
    on = rows["lang"].eqNullSafe(limits["t_lang"]) & rows["source"].eqNullSafe(limits["t_source"])
    joined = join_small(rows, limits, on, limits.count())
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    inside = F.lit(True)
    for k in SHARES:
        inside = inside & (F.col(k) <= F.col(f"most_{k}"))
    return joined.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & inside).drop("t_lang", "t_source")
