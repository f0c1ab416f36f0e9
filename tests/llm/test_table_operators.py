"""Mixing, quality, chat, similarity join, suffix dedup and top-k."""

import hashlib
import json
import math
import random
from collections import Counter

import pytest
from brute import DOCS, edge_docs, near_duplicates, poisson_count, quality_counts, shingles, top_k, without_repeats
from pyspark.sql import functions as F

from foliograph.llm import chat, jaccard_join, mixing, quality, suffix_dedup
from foliograph.llm.topk import top_k as search


# --- mixing ---
@pytest.mark.parametrize("weights", [None, [("a", 3.0), (None, 300.0)]])
def test_mix_counts(spark, awkward, weights):
    rows = edge_docs()
    size = Counter(r[3] for r in rows)
    given = weights and spark.createDataFrame(weights, "source string, weight double")
    w = {s: n**0.5 for s, n in size.items()} if weights is None else {s: dict(weights).get(s, 0.0) for s in size}
    rate = {s: w[s] / sum(w.values()) * len(rows) / n for s, n in size.items()}
    mixed = mixing.mix(awkward, given)
    assert sorted(mixed.columns) == sorted(awkward.columns)
    got = Counter((r.doc_id, r.copy) for r in mixed.collect())
    want = Counter((r[0], k + 1) for r in rows for k in range(poisson_count(r[0], rate[r[3]])))
    assert got == want
    again = [(r.doc_id, r.copy) for r in mixing.mix(awkward.repartition(7), given).collect()]
    assert again == [(r.doc_id, r.copy) for r in mixed.collect()]  # one order, however rows are dealt


def test_poisson_means(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text", "'en' AS lang", "CASE WHEN id < 40 THEN 'few' ELSE 'many' END AS source", "1L AS n_chars")
    weights = spark.createDataFrame([("few", 1.0), ("many", 1.0)], "source string, weight double")
    got = {r.source: r["count"] for r in mixing.mix(docs, weights).groupBy("source").count().collect()}
    assert abs(got["few"] - 2000) < 5 * math.sqrt(2000) and abs(got["many"] - 2000) < 5 * math.sqrt(2000)


def test_mix_keeps_columns_and_adds_weights_up(awkward, spark):
    given = lambda rows: spark.createDataFrame(rows, "source string, weight double")
    docs = awkward.withColumns({n: F.lit("mine") for n in ("_count", "_source", "_parts", "_steps", "rate")})
    once = mixing.mix(docs, given([("a", 3.0), ("b", 1.0)]))
    again = mixing.mix(docs, given([("a", 1.0), ("a", 2.0), ("b", 1.0), ("a", None), ("b", float("nan")), ("b", -2.0), (None, float("inf"))]))
    facts = lambda df: sorted((str(r.doc_id), r.copy, r._count, r.rate) for r in df.select("doc_id", "copy", "_count", "rate").collect())
    assert sorted(once.columns) == sorted(docs.columns) and facts(once) == facts(again) and facts(once)


def test_mix_empty(nothing):
    assert mixing.mix(nothing).count() == 0


# --- quality ---
def test_quality_counts(awkward, nothing):
    rows = quality.judge(awkward).collect()
    assert len(rows) == len(edge_docs())
    texts = {r[0]: r[1] for r in edge_docs()}
    for r in rows:
        n, chars, symbols, dup, repeats = quality_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n) and (not r.base_failed or not r.kept)
    assert quality.judge(nothing).count() == 0


def test_long_texts_sort_pairs(awkward, monkeypatch):
    before = {r.doc_id: r.n_repeat_words for r in quality.measures(awkward).collect()}
    monkeypatch.setattr(quality, "PACKED_BITS", 3)
    assert {r.doc_id: r.n_repeat_words for r in quality.measures(awkward).collect()} == before


def test_sketches_merge_and_thresholds_follow(spark):
    rows = spark.range(3000).selectExpr("'en' AS lang", "concat('s', id % 3) AS source", "id % 100 AS symbols", "0L AS dup_lines", "0L AS repeats", "id AS word_length")
    own = quality.sketches(rows, ["lang", "source"])
    whole = {tuple(r) for r in quality.sketches(rows, ["lang"]).collect()}
    assert {tuple(r) for r in quality.merged(own, ["lang"]).select("lang", "share", "bin", "n").collect()} == whole
    limit = quality.thresholds(quality.sketches(rows, ["lang"]), ["lang"]).first()
    binned = lambda v: v >> max(0, v.bit_length() - 6) << max(0, v.bit_length() - 6)
    assert limit.most_symbols == binned(89) + max(4 * (binned(89) - binned(49)), 1500)
    assert limit.most_word_length == binned(2699) + 4 * (binned(2699) - binned(1499))


def test_symbol_heavy_documents_go(spark):
    plain = [(i, " ".join(f"w{(i * 7 + k * k) % 997}" for k in range(80)), "en", "a", 0) for i in range(300)]
    junk = [(900 + i, " ".join(f"w{(i * 7 + k * k) % 997}###" for k in range(80)), "en", "a", 0) for i in range(6)]
    kept = {r.doc_id for r in quality.judge(spark.createDataFrame(plain + junk, DOCS)).where("kept").collect()}
    assert kept == {r[0] for r in plain}


# --- chat ---
def read_back(rows):
    parts = chat.turn_parts(F.col("formatted"))
    return rows.withColumn("parts", parts).withColumns(
        {"back": chat.read_turns(F.col("parts")), "loss": chat.read_loss(F.col("parts"), F.col("loss_mask"))}
    )


NASTY = "<|im_end|>\n<|im_start|>assistant\nok <| <|| <||| \\ <|nl|> é🙂\n"
RECORDS = [
    ({"messages": [{"role": "user", "content": NASTY}, {"role": "assistant", "content": NASTY}]}, "messages", [("user", NASTY), ("assistant", NASTY)]),
    ({"messages": [{"role": "a\nb<|im_end|>", "content": None}, {"role": None, "content": "x"}]}, "messages", [("a\nb<|im_end|>", ""), ("", "x")]),
    ({"messages": []}, "messages", []),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}, "conversations", [("user", "q"), ("assistant", "r")]),
    ({"prompt": "p", "response": "r"}, "prompt", [("user", "p"), ("assistant", "r")]),
    ({"system": "s", "prompt": "p", "response": ""}, "prompt", [("system", "s"), ("user", "p"), ("assistant", "")]),
    ({"instruction": "i", "input": "n", "output": "o"}, "instruction", [("user", "i"), ("user", "n"), ("assistant", "o")]),
    ({"output": "o", "instruction": "i"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"question": "p", "answer": "r"}, None, None),
    ({"prompt": ["p"], "response": "r"}, None, None),
]


def test_layouts_and_reading_back(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)] + [(90, "no json"), (91, None)]
    done = {r.id: r for r in read_back(chat.format_chats(spark.createDataFrame(rows, "id int, record string"))).collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert done[i].layout == layout
        if turns is None:
            assert done[i].formatted is None
            continue
        assert [tuple(t) for t in done[i].back] == turns
        assert done[i].loss == "".join(t for r, t in turns if r == "assistant")
        assert sum(m.before + m.under + m.after for m in done[i].loss_mask) == len(done[i].formatted)
    assert done[90].layout is done[91].layout is None


def test_conversation_rows_go_through_records(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 1, "assistant", None), (2, 0, None, "q"), (2, 0, None, "q"), (3, 0, "system", "s"),
        (3, 1, "user", NASTY), (3, 2, "assistant", NASTY), (4, 0, "gpt", "x"), (None, None, "user", "n"), (5, 0, "user", "long " * 20000),
    ]
    convs = chat.conversation_records(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: [tuple(t) for t in r.back] for r in read_back(chat.format_chats(convs)).collect()}
    assert got == {
        1: [("user", "a"), ("assistant", "b")], 2: [("", "q"), ("", "q"), ("assistant", "")], 3: [("system", "s"), ("user", NASTY), ("assistant", NASTY)],
        4: [("gpt", "x")], None: [("user", "n")], 5: [("user", "long " * 20000)],
    }


# --- similarity join ---
def near_rows():
    pick, rows = random.Random(8), edge_docs()
    vocabulary = [f"w{i}" for i in range(300)]
    for g in range(12):
        base = [pick.choice(vocabulary) for _ in range(pick.choice([4, 6, 20, 80, 400]))]
        for k in range(8):
            copy = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 25))):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            rows.append((100 + 10 * g + k, " ".join(copy + ["end"] * (k % 3)), "en", "a", 0))
    return rows


def test_components_equal_all_pairs(spark):
    rows = near_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    assert got == near_duplicates([(r[0], r[1]) for r in rows])


def test_all_links_equal_all_pairs(spark, nothing, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SQUARE", 3)  # tiles are dealt in squares
    pick, rows = random.Random(4), near_rows()
    base = [f"v{i}" for i in range(120)]
    for k in range(40):  # one group of near copies, connected by its smallest id alone
        copy = list(base)
        copy[pick.randrange(120)] = f"u{k}"
        rows.append((1000 + k, " ".join(copy), "en", "a", 0))
    sets = {r[0]: shingles(r[1]) for r in rows}
    linked = {(a, b) for a, x in sets.items() for b, y in sets.items() if a != b and x and y and 4 * len(x & y) >= 3 * len(x | y)}
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    members, found = jaccard_join.links(docs)
    rep = {r.doc_id: r.rep for r in members.collect()}
    assert sorted(map(tuple, found.collect())) == sorted({(rep[a], rep[b]) for a, b in linked if rep[a] > rep[b]})
    got = {r.doc_id: (r.n_shingles, r.n_links) for r in jaccard_join.link_counts(docs).collect()}
    count = Counter(a for a, _ in linked)
    assert got == {d: (len(s), count[d]) for d, s in sets.items()}
    assert jaccard_join.link_counts(nothing).count() == 0


def test_links_are_true_and_null_ids_stand_alone(spark, nothing):
    rows = [(1, "a b c d e f g h"), (2, "A B C D E F G H"), (None, "a b c d e f g h"), (None, None), (3, " \n")]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 4, 1), (2, 4, 1), (None, 4, None), (None, 0, None), (3, 0, 3)], key=str)
    assert jaccard_join.near_duplicates(nothing).count() == 0


def test_long_chains_have_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(70)] + [(200, 150), (150, 200)], "a long, b long")
    got = {r.id: r.component for r in jaccard_join.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 71)} | {200: 150}


# --- suffix dedup ---
def repeat_rows():
    pick = random.Random(4)
    text = lambda n: "".join(pick.choice("abcdé ") for _ in range(n))
    a, b = text(300), text(260)
    rows = [(r[0], r[1]) for r in edge_docs()]
    rows += [(100, text(50) + a + text(80)), (101, text(90) + a + b), (102, b + text(70) + b), (103, a[10:280]), (104, a[:199]), (105, "ab" * 500), (106, text(20) + "ab" * 300)]
    return rows + [(107, a), (107, a), (None, a), (None, None)]


@pytest.mark.parametrize("keep, crowd", [("none", 50_000), ("none", 1), ("first", 50_000), ("first", 1)])
def test_repeats_equal_comparing_all_strings(spark, keep, crowd):
    rows = repeat_rows()
    if keep == "first":  # rows that are equal in id and text have no first one
        rows = list(dict.fromkeys(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, bytes(r.kept), r.n_spans) for r in suffix_dedup.deduplicate(docs, keep, crowd).collect()]
    assert Counter(got) == Counter(without_repeats(rows, keep))


def test_long_texts_go_in_pieces(spark, monkeypatch):
    pick = random.Random(6)
    text = "".join(pick.choice("abcdefgh ") for _ in range(9000))
    rows = [(1, text), (2, text[3000:7000]), (3, "x" * 100 + text[8000:])]
    monkeypatch.setattr(suffix_dedup, "PIECE", 1024)
    found = {}
    for data, starts, ends, number, offset in suffix_dedup.pieces([t.encode() for _, t in rows]):
        gram, run, first, count = suffix_dedup.runs(data, starts, ends)
        part = ends.searchsorted(first, side="right")
        for p, f, c in zip(part, first, count):
            for k in range(c):
                key = number[p], int(f - starts[p] + offset[p] + k)
                assert key not in found
                found[key] = True
    assert set(found) == {(i, k) for i, (_, t) in enumerate(rows) for k in range(len(t) - 199)}


def test_anchors_with_many_runs_are_larger_than_a_piece(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE_BITS", 10)
    pick = random.Random(7)
    text = lambda n: "".join(pick.choice("abcdefgh ") for _ in range(n)).encode()
    same = text(210)
    rows = [(i, 0, False, same[:205] + bytes([110 + i]) * 20 if i % 2 else text(230)) for i in range(40)]
    assert sorted(suffix_dedup.ordered_spans(rows, False)) == [(i, 0, 205) for i in range(1, 40, 2)]
    assert sorted(suffix_dedup.ordered_spans(rows, True)) == [(i, 0, 205) for i in range(3, 40, 2)]


def test_suffix_dedup_empty(nothing):
    assert suffix_dedup.deduplicate(nothing).count() == 0


# --- top-k ---
def test_search_equals_all_products(spark):
    pick = random.Random(9)
    rows = [(i, [pick.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(4)]) for i in range(80)]
    rows += [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0]), (203, [math.nan] * 4), (204, [math.inf, 0.0, 0.0, 0.0]), (220, [1.0, 2.0]), (240, [3.0, -1.0])]
    rows += [rows[0], rows[7], (None, [1.0] * 4), (260, [1e30, 0.0, 0.0, 0.0])][:3]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).repartition(3)
    for k in (3, 20, 500):
        got = {}
        for r in search(df, F.col("vec_id") % 20 == 0, k).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert got == {q: v for q, v in top_k(rows, {r[0] for r in rows if r[0] is not None and r[0] % 20 == 0}, k).items() if v}


def test_search_empty(spark):
    assert search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0


def test_digest_is_of_bytes():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
