"""Spelling variants: words one edit apart, found by walking a trie kept as a distributed table.

1. Words are counted in tasks, in tables of bounded size, and the counts are
   added up per word.
2. The vocabulary becomes two tries, of the words and of the words read backwards.
   A node is the digest of a prefix; the edge table has a row per node with its
   children, each with the characters that go on from it.
3. A neighbour has the edit in the second half of the word, read forwards, or in
   the first, and then in the second half read backwards. So the first half of
   each word is its first state, where the tries are already thin, and states
   (word, node, edits, text looked for) are joined with the edge table level by
   level. A state without an edit goes on along its word, and on each other child
   starts states with a replaced or an inserted character; a state with its edit
   goes on only along what is left. Replaced characters are looked for upwards
   and no state deletes: the other word of the pair finds those.
4. States that end at a word are pairs, and the vocabulary confirms them.
5. Words beyond ``LONGEST`` code points would need as many levels; they are paired
   by digests of themselves and of themselves without each code point instead, and
   the edit distance confirms each pair. The result is the same.

Defined cases: a null or empty text has no words; a null id counts as an empty
one where words are changed by id; repeated rows count again; an empty table has
no words; other columns are ignored. Ties between forms go to the smaller word
in code-point order.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import slices, staged

#: Distinct words that a task counts before it hands its counts on.
TABLE = 100_000
#: Words up to this length are looked up in the tries.
LONGEST = 32
_KEPT = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def count_words(docs: DataFrame, change: int | None = None) -> DataFrame:
    """(word, n) over all texts: runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z as a-z.

    With ``change``, a word loses a code point in those documents where
    ``change`` divides h = crc32("<id>:<word>"), namely the one at h % length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if not text:
                        continue
                    found = Counter(text.encode("latin-1", "replace").translate(_KEPT).split())
                    begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for raw, n in found.items():
                        word = raw.decode("latin-1")
                        if change is not None:
                            h = zlib.crc32(raw if raw.isascii() else word.encode(), begun)
                            if h % change == 0:
                                i = h % len(word)
                                word = word[:i] + word[i + 1 :]
                        total[word] += n
                    if len(total) >= TABLE:
                        yield handed_on()
        if total:
            yield handed_on()

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def _char(text: Column | str, at: Column) -> Column:
    return F.substring(text, at, F.lit(1))


def _node(text: Column | str, length: Column) -> Column:
    return F.xxhash64("dir", F.substring(text, F.lit(1), length))


def edge_table(read: DataFrame) -> DataFrame:
    """(depth, node, children) of the tries of the words in ``read`` (dir, text, size).

    A child has its character, node, the characters that go on from it, and
    whether a word ends there. Only depths that a walk can reach are kept: words
    have ``size`` code points and walks begin in their middle.
    """
    d = F.col("d")
    steps = read.select("dir", "text", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("d"))
    edges = steps.select(
        d.alias("depth"),
        _node("text", d).alias("node"),
        _char("text", d + 1).alias("c"),
        _node("text", d + 1).alias("child"),
        F.when(d + 1 < F.col("size"), _char("text", d + 2)).alias("next"),
    )
    children = edges.groupBy("depth", "node", "c", "child").agg(F.concat_ws("", F.collect_set("next")).alias("next"), F.max(F.col("next").isNull()).alias("ends"))
    return children.groupBy("depth", "node").agg(F.collect_list(F.struct("c", "child", "next", "ends")).alias("children"))


def _moves(depth: Column) -> Column:
    """The states that one state becomes at the children of its node."""
    text, goal, edits = F.col("text"), F.col("goal"), F.col("edits")
    own = _char(goal, depth + 1)  # what the state looks for next
    later = _char(goal, depth + 2)

    def fits(child: Column, follow: Column) -> Column:
        """Whether the walk can go on from the child with ``follow``; at the end of the goal the child must end a word."""
        return F.when(follow == "", child["ends"]).otherwise(F.contains(child["next"], follow))

    def state(child: Column, edited: int, to: Column) -> Column:
        return F.struct(child["child"].alias("node"), F.lit(edited).alias("edits"), to.alias("goal"))

    head, ahead, rest = F.substring(text, F.lit(1), depth), F.substring(text, depth + 1, F.length(text)), F.substring(text, depth + 2, F.length(text))
    along = F.transform(F.filter("children", lambda x: (x["c"] == own) & ((edits == 0) | fits(x, later))), lambda x: F.struct(x["child"].alias("node"), edits.alias("edits"), goal.alias("goal")))
    replaced = F.transform(F.filter("children", lambda x: (own != "") & (x["c"] > own) & fits(x, later)), lambda x: state(x, 1, F.concat(head, x["c"], rest)))
    inserted = F.transform(F.filter("children", lambda x: (x["c"] != own) & fits(x, own)), lambda x: state(x, 1, F.concat(head, x["c"], ahead)))
    return F.when(edits == 0, F.concat(along, replaced, inserted)).otherwise(along)


def trie_pairs(words: DataFrame) -> DataFrame:
    """(a, b): words of ``words`` (word) with one edit between them, each pair once or twice."""
    read = words.select(F.explode(F.array(F.struct(F.lit(0).alias("dir"), F.col("word").alias("text")), F.struct(F.lit(1).alias("dir"), F.reverse("word").alias("text")))).alias("x"))
    read = read.select("x.dir", "x.text", F.length("x.text").alias("size"))
    # forwards the edit lies at or after half of the word, backwards before it
    half = F.floor(F.col("size") / 2).cast("int")
    begin = F.when(F.col("dir") == 0, half).otherwise(F.col("size") - half)
    read = read.withColumn("begin", begin).withColumn("node", _node("text", F.col("begin")))
    read = staged(read, "spelling-words")
    ends = read.agg(F.min("begin").alias("low"), F.max("size").alias("high")).first()
    if ends.low is None:
        return words.select(F.col("word").alias("a"), F.col("word").alias("b")).limit(0)
    edges = staged(edge_table(read).where(F.col("depth") >= ends.low), "spelling-edges")
    state = ["dir", "text", "node", "edits", "goal"]
    over = F.length("goal") == F.col("at")  # nothing is left to look for
    walk, done = None, []
    for depth in range(ends.low, ends.high):
        here = read.where(F.col("begin") == depth).select("dir", "text", "node", F.lit(0).alias("edits"), F.col("text").alias("goal"))
        if walk is not None:
            here = walk.where((F.col("edits") == 0) | ~over).select(state).unionByName(here)
        # one row a node: where many words pass a node, adaptive execution deals their states to several tasks
        level = edges.where(F.col("depth") == depth)
        moved = here.join(level, "node").select("dir", "text", (F.col("depth") + 1).alias("at"), F.explode(_moves(F.col("depth"))).alias("to"))
        walk = staged(moved.select("dir", "text", "to.node", "to.edits", "to.goal", "at"), "spelling-states")
        done.append(walk.where((F.col("edits") == 1) & over).select("dir", "text", "goal"))
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    turned = lambda c: F.when(F.col("dir") == 0, F.col(c)).otherwise(F.reverse(c))
    found = found.select(turned("text").alias("a"), turned("goal").alias("b")).distinct()
    return found.join(words.select(F.col("word").alias("b")), "b", "left_semi").select("a", "b")


def digest_pairs(words: DataFrame) -> DataFrame:
    """(a, b): words one edit apart, by digests of each word and of it without each code point."""
    without = F.transform(
        F.sequence(F.lit(1), F.length("word")),
        lambda i: F.xxhash64(F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.length("word")))),
    )
    keyed = words.select(F.xxhash64("word", F.lit(1)).alias("id"), F.explode(F.array_distinct(F.concat(F.array(F.xxhash64("word")), without))).alias("key"))
    keyed = staged(keyed, "spelling-digests")
    a, b = keyed.select("key", F.col("id").alias("x")), keyed.select("key", F.col("id").alias("y"))
    pairs = a.join(b, "key").where("x < y").select("x", "y").distinct()
    named = lambda i, w: words.select(F.xxhash64("word", F.lit(1)).alias(i), F.col("word").alias(w))
    return pairs.join(named("x", "a"), "x").join(named("y", "b"), "y").where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near): every two words of ``words`` (word) that one inserted, deleted or replaced code point makes equal."""
    size = F.length("word")
    found = trie_pairs(words.where(size <= LONGEST)).unionByName(digest_pairs(words.where(size >= LONGEST)))
    both = found.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("x"))
    return both.select("x.*").distinct()


def variants(counts: DataFrame, least: int = 5, length: int = 6, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words in ``counts`` (word, n) with ``length`` code points and ``least`` occurrences.

    ``form`` is the most frequent near word if it is at least ``times`` as
    frequent, else null; ``root`` is the last word on the way from form to form.
    """
    words = staged(counts.where((F.length("word") >= length) & (F.col("n") >= least)), "spelling-vocabulary")
    near = near_pairs(words.select("word")).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.max("near_n").alias("near_n"), F.min(F.struct((-F.col("near_n")).alias("k"), F.col("near").alias("near")))["near"].alias("near"))
    joined = words.join(best, "word", "left")
    is_form = F.col("near_n") >= times * F.col("n")
    rows = staged(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")),
        "spelling-forms",
    )
    # each step doubles the way that is known; counts grow from form to form, so every way ends
    ways = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = staged(ways.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if ways.where("moved").isEmpty():
            break
        ways = ways.drop("moved")
    return rows.join(ways.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
