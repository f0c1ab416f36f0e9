"""Registered queries against SQL or plain versions over the smallest tables."""

import hashlib
import os

import pytest
from brute import near_duplicates, poisson_count, without_repeats
from oracle import compare, connect

from foliograph.llm import pii, sentencepiece_bpe, toxicity
from foliograph.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == ""


def test_pieces(spark, rows):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in QUERIES["op3_sentencepiece"](spark, SF).collect()}
    for r in rows:
        ids = [1, *library.encode(r.text or ""), 2]
        want = hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256) == (len(ids), want)
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_suffix_dedup(spark, rows):
    got = {r.doc_id: (r.n_bytes - r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op4_suffix_dedup"](spark, SF).collect()}
    assert got == {d: (len(k), n, hashlib.sha256(k).hexdigest()) for d, k, n in without_repeats([(r.doc_id, r.text) for r in rows])}


def test_jaccard_join(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_jaccard_join"](spark, SF).collect()}
    assert got == near_duplicates([(r.doc_id, r.text) for r in rows])


def test_pii_base(spark, rows):
    got = {r.doc_id: r for r in QUERIES["op9_pii"](spark, SF).collect()}
    for r in rows:
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in pii.base_spans(r.text or ""))
        assert got[r.doc_id].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(got[r.doc_id].spans.split(","))


@pytest.mark.parametrize("name", ["op1_toxicity", "op6_token_packing"])
def test_whole_table(spark, rows, name):
    found = QUERIES[name](spark, SF)
    ids = [d for r in found.collect() for d in (r.doc_ids if name == "op6_token_packing" else [r.doc_id])]
    assert set(ids) == {r.doc_id for r in rows}


def test_pipeline_equals_plain_version(spark, rows):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    import public_tokenizers

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = [r for r in rows if model.chances(r.text, toxicity.Hits(model.weights))[0] < 0.5]
    groups = near_duplicates([(r.doc_id, r.text) for r in kept])
    kept = [r for r in kept if groups[r.doc_id][1] == r.doc_id]
    tagger = pii.fit(spark.createDataFrame(kept, docs.schema))
    spans = pii.all_spans(tagger, [r.text or "" for r in kept])
    masked = {r.doc_id: pii.mask(r.text or "", s) if s else r.text for r, (_, s) in zip(kept, spans)}
    size = {}
    for r in kept:
        size[r.source] = size.get(r.source, 0) + 1
    whole = sum(n**0.5 for n in size.values())
    own = sentencepiece_bpe.piece_model(sentencepiece_bpe.read_model(public_tokenizers.path("piece_bpe_32k.model")))
    want = []
    for r in kept:
        ids = b"\1\0\0\0" + own.encode(masked[r.doc_id] or "") + b"\2\0\0\0"
        want += [(r.doc_id, ids)] * poisson_count(r.doc_id, size[r.source] ** 0.5 / whole * len(kept) / size[r.source])
    got = [(r.doc_id, bytes(r.token_ids)) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want)
