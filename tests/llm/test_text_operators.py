"""Toxicity, SentencePiece, packing and personal data."""

import random
import re

import numpy as np
import pytest
from brute import DOCS, edge_docs

from foliograph.llm import packing, pii, sentencepiece_bpe, toxicity

tokenizers = pytest.importorskip("public_tokenizers")
LABELS = "doc_id long, quality int, toxic int"


# --- toxicity ---
def toxic_corpus(n=400):
    pick = random.Random(3)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        w = [pick.choice(plain) for _ in range(60)] + (pick.choices(["scum", "idiot", "moronic", "moronically"], k=3) if bad else [])
        pick.shuffle(w)
        rows.append((i, " ".join(w), "en", "a", 0))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.fit(docs, spark.createDataFrame(labels[:200], LABELS))
    got = {r.doc_id: (r.severity, r.toxic) for r in toxicity.score(docs, model).collect()}
    held_out = [i for i in range(200, 400)]
    assert sum(got[i][1] == (i % 5 == 0) for i in held_out) >= 198
    assert min(got[i][0] for i in held_out if i % 5 == 0) > max(got[i][0] for i in held_out if i % 5)


def test_toxicity_thresholds_rise_and_gradient_fits():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 3))
    score = x @ [1.5, -1.0, 0.0] + r.logistic(size=3000)
    weights, cuts = toxicity.cumulative_link(x, (score > -0.5).astype(int) + (score > 1.5), np.ones(3000))
    assert np.allclose(weights, [1.5, -1.0, 0.0], atol=0.15) and np.allclose(cuts, [-0.5, 1.5], atol=0.15)


@pytest.mark.parametrize("labels", [[], [(3, 1, 0)], [(None, 1, 1), (4, 1, None)], [(3, 1, 1)], [(3, 1, 0), (3, 1, 1), (4, 1, 0), (99, 0, 1)]])
def test_toxicity_few_labels(spark, awkward, labels):
    model = toxicity.fit(awkward, spark.createDataFrame(labels, LABELS))
    scored = toxicity.score(awkward.withColumnRenamed("copy", "toxic"), model)
    assert scored.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "severity", "toxic"]
    assert scored.count() == len(edge_docs()) and scored.where("severity IS NULL OR toxic IS NULL").count() == 0


def test_toxicity_empty(spark, nothing):
    model = toxicity.fit(nothing, spark.createDataFrame([(1, 1, 1), (2, 1, 0)], LABELS))
    assert toxicity.score(nothing, model).count() == 0


# --- SentencePiece ---
@pytest.fixture(scope="module")
def model():
    return sentencepiece_bpe.read_model(tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))


def test_pieces_equal_library(model, library):
    own, pick = sentencepiece_bpe.piece_model(model), random.Random(1)
    parts = ["a", "e", " ", "  ", "▁", "\n", "é", "世", "\x00", ".", "ing", "the", "1", "🙂", "\t", "<s>", "<0x41>", "ß"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 14))) for _ in range(4000)]
    texts += ["".join(pick.choice("ab") for _ in range(400)), " " * 100, "x" * 5000, *["".join(pick.choices(own.pieces[300:], k=8)) for _ in range(500)]]
    for t in texts:
        ids = np.frombuffer(own.encode(t), "<u4")
        assert ids.tolist() == library.encode(t), t
        assert own.decode(ids) == library.decode(ids.tolist()), t
    for _ in range(500):  # ids that no text gives
        ids = [pick.choice([pick.randint(0, 300), pick.randint(0, 31999)]) for _ in range(8)]
        assert own.decode(np.array(ids)) == library.decode(ids), ids


def test_pieces_in_spark(awkward, nothing, model, library):
    done = sentencepiece_bpe.decode(sentencepiece_bpe.encode(awkward.withColumnRenamed("copy", "token_ids"), model), model).collect()
    assert len(done) == len(edge_docs())
    for r in done:
        want = [1, *library.encode(r.text or ""), 2]
        assert np.frombuffer(r.token_ids, "<u4").tolist() == want and r.decoded == library.decode(want)
    once = sentencepiece_bpe.encode_and_decode(awkward.withColumnRenamed("copy", "decoded"), model).collect()
    facts = lambda rows: sorted((r.doc_id, bytes(r.token_ids), r.decoded) for r in rows)
    assert facts(once) == facts(done)
    assert sentencepiece_bpe.encode(nothing, model).count() == 0


# --- packing ---
def test_best_fit_equals_plain_search():
    pick = random.Random(2)
    for length in (1, 2, 7, 16, 2048):
        for _ in range(60):
            sizes = [pick.randint(1, length) for _ in range(pick.randint(0, 40))]
            bins = packing.best_fit(sizes, length)
            assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
            assert all(sum(sizes[i] for i in b) <= length for b in bins)
            free = []
            for s in sorted(sizes, reverse=True):
                fits = [j for j in range(len(free)) if free[j] >= s]
                if fits:
                    free[min(fits, key=lambda j: free[j])] -= s
                else:
                    free.append(length - s)
            assert len(bins) == len(free)


@pytest.mark.parametrize("length", [16, 2048])
def test_packing_is_lossless(awkward, nothing, length, tmp_path, spark):
    with open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    docs = awkward.selectExpr("CASE WHEN doc_id = 7 THEN NULL ELSE doc_id END AS doc_id", "text")
    packing.write_packed(packing.pack(docs, ranks, tokenizers.PATTERN, length), str(tmp_path / "packed"))
    rows = spark.read.parquet(str(tmp_path / "packed")).collect()
    assert packing.matrix(rows, length).shape == (len(rows), length) and len({r.pack_id for r in rows}) == len(rows)
    encoder, parts = packing.rank_encoder(ranks, tokenizers.PATTERN), {}
    for r in rows:
        ids = np.frombuffer(r.token_ids, "<u2")
        assert r.position_resets == r.cu_seqlens[:-1] and r.cu_seqlens[-1] == r.n_tokens and set(ids[r.n_tokens :]) <= {encoder.end}
        for k, (doc, offset) in enumerate(zip(r.doc_ids, r.doc_offsets)):
            parts.setdefault(doc, []).append((offset, ids[r.cu_seqlens[k] : r.cu_seqlens[k + 1]].tolist()))
    twice = edge_docs()[-1][0]
    for doc, text, *_ in edge_docs()[:-1]:
        want = [*encoder.library.encode_ordinary(text or ""), encoder.end]
        got = sorted(parts[None if doc == 7 else doc])
        if doc == twice:
            got = got[::2]
        assert [x for _, p in got for x in p] == want
    assert packing.pack(nothing, ranks, tokenizers.PATTERN).count() == 0


# --- personal data ---
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain_spans(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    cards = [m for m in pii.CARD.finditer(text) if 13 <= len(pii.digits_of(m[0])) <= 19 and pii.luhn(pii.digits_of(m[0]))]
    found += [("card", *m.span()) for m in cards]
    return found + [("phone", *m.span()) for m in pii.PHONE.finditer(text) if 9 <= len(pii.digits_of(m[0])) <= 15]


def test_base_spans_equal_plain_patterns():
    pick = random.Random(0)
    parts = ["a", "@", ".", "1", "25", "-", "_", " ", "+", "(", "é", "b@c.d", "4111 1111 1111 1111", "+1 (499) 555-6503"]
    for _ in range(20_000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text
    for long in ("1" * 200_000 + "a" * 200_000 + "@", "1." * 100_000, "+1((((" * 50_000):
        pii.base_spans(long)  # linear


def test_gradient_of_the_tagger():
    r = np.random.default_rng(1)
    tagger = pii.Tagger({k: v.astype(float) for k, v in pii.Tagger.fresh(3).p.items()})
    ids, tags = r.integers(0, 99, (3, 7)), r.integers(0, 9, (3, 7))
    _, grad = tagger.loss(ids, tags)
    for name, value in tagger.p.items():
        at = (ids[0, 0], 2) if name == "embed" else tuple(r.integers(0, s) for s in value.shape)
        old, sides = value[at], []
        for step in (1e-3, -1e-3):
            value[at] = old + step
            sides.append(tagger.loss(ids, tags)[0])
        value[at] = old
        assert abs((sides[0] - sides[1]) / 2e-3 - grad[name][at]) < 1e-3


def pii_rows(n=300):
    pick, rows = random.Random(5), []
    for i in range(n):
        value = pick.choice([f"jo.{i}@mail{i % 9}.example.com", f"+1 ({pick.randint(200, 999)}) 555-{pick.randint(1000, 9999)}", f"10.{i % 256}.3.{i % 200}"])
        rows.append((i, f"some plain words and {value} then more of the plain words", "en", "a", 0))
    return rows


def test_network_adds_spans_and_base_ones_stay(spark):
    docs = spark.createDataFrame(pii_rows(), DOCS)
    tagger = pii.fit(docs)
    texts = ["mail jo.77 at mail5.example.com today", "call (499) 555-6503 now please", "nothing here to find", "version 2 of 3 is out", pii_rows(1)[0][1]]
    found = pii.all_spans(tagger, texts)
    assert [t[s:e] for t, (_, spans) in zip(texts[:2], found) for _, s, e in spans] == ["jo.77 at mail5.example.com", "(499) 555-6503"]
    assert found[2] == found[3] == ([], []) and found[4][0] == found[4][1] != []


def test_network_reads_addresses_without_digits_and_whole_hosts(spark):
    pick, rows = random.Random(6), []
    names, hosts = ["jane.doe", "sam_lee", "kim", "ann.b", "lou-ray", "max.moe"], ["example.org", "mail.test.net", "some-school.edu.example", "a-b.example.com"]
    for i in range(300):
        rows.append((i, f"write to {pick.choice(names)}@{pick.choice(hosts)} {pick.choice(['please', 'or call', 'today', 'at noon'])} and more of the plain words", "en", "a", 0))
    tagger = pii.fit(spark.createDataFrame(rows, DOCS))
    long = "kim at long-department.of-some-old.very-large.some-university.research-network.example.org"
    values = ["jane.doe (at) example.org", "kim(at)mail.test.net", "sam_lee[at]example.org", "ann.b at a-b.example.com", long]
    texts = [f"write to {v} please and more of the plain words" for v in values] + ["meet me at noon or at the end. then more"]
    found = [[t[s:e] for _, s, e in spans] for t, (_, spans) in zip(texts, pii.all_spans(tagger, texts))]
    assert found == [[v] for v in values] + [[]]


def test_stretches_hold_every_plausible_span():
    pick = random.Random(2)
    parts = ["a", "jo.b", " at ", "(at)", "[at]", "@", " ", "x-y.z", ".", "h" * 60, "1", "22", " " * 60, "(", "-", "+1"]
    for _ in range(5_000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(1, 9)))
        read = pii.stretches(text)
        for m in re.finditer(r"[\w.%+-]+ ?(?:@|\(at\)|\[at\]| at ) ?[\w-]+(?:\.[\w-]+)+|[+(]?[0-9][0-9 ().-]*[0-9]", text):
            assert any(a <= m.start() and m.end() <= b for a, b in read), (text, m[0])
    for long in ("a" * 200_000 + "(at)", "a at " * 50_000, "@" * 200_000, "1" + " " * 200_000 + "x"):
        pii.stretches(long)  # linear


def test_training_windows_come_from_whole_texts_and_are_bounded(spark, monkeypatch):
    late = " ".join(["item 7 of the long list of plain words that goes on and on without any end"] * 20) + " mail kim@example.org"
    assert any(k == "email" for _, spans in pii.windows_of(late) for k, _, _ in spans)
    monkeypatch.setattr(pii, "WINDOWS", 40)
    rows = [(0, "12 345 " * 4_000, "en", "a", 0)] + pii_rows(30)[1:]
    windows = pii.labelled_windows(spark.createDataFrame(rows, DOCS))
    assert len(windows) == 40 and max(len(part) for part, _ in windows) <= pii.WIDTH
    assert sum(not part.strip("12345 ") for part, _ in windows) < 20


def test_detect_awkward_rows(spark, awkward, nothing):
    tagger = pii.fit(spark.createDataFrame(pii_rows(), DOCS))
    rows = pii.detect(awkward.withColumnRenamed("copy", "spans"), tagger, masked="masked").collect()
    assert len(rows) == len(edge_docs())
    for r in rows:
        assert [tuple(s) for s in r.base_spans] == plain_spans(r.text or "") and (r.spans or r.masked == r.text)
    assert pii.detect(nothing, pii.fit(nothing)).count() == 0 and pii.fit(nothing) is None
    assert pii.mask("a b@c.de f 10.0.0.1", [("email", 2, 8), ("ip", 11, 19)]) == "a <EMAIL> f <IP>"
    assert pii.mask("12345", [("phone", 0, 3), ("card", 2, 5)]) == "<PHONE>"
    long = "word " * 50_000 + "jo@mail.example.com" + " word" * 50_000
    assert [k for k, _, _ in pii.all_spans(tagger, [long])[0][1]] == ["email"]


# --- pipeline ---
def test_pipeline_decodes_its_ids(spark):
    import hashlib

    import corpus_pipeline

    texts = ["mail <EMAIL> or <PHONE> today", "é ß 世界 🙂", "", None]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.encode_texts(spark, docs, "").collect()}
    assert got == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}
