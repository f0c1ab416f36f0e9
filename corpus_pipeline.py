"""The corpus pipeline: toxicity, near duplicates, personal data, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes to the shared folder and reads back as the next stage's documents. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm import jaccard_join, mixing, pii, sentencepiece_bpe, toxicity
from foliograph.llm.common import DOCUMENT_COLUMNS, pick, staged, table
from foliograph.session import reach_package


def prepared(spark: SparkSession) -> None:
    reach_package(spark)
    # texts may be long: small Arrow batches keep Python workers small
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not call toxic; it learns from the labelled ones among them."""
    prepared(spark)
    docs = docs.select(DOCUMENT_COLUMNS)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("NOT toxic").select(DOCUMENT_COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by three quarters of their shingles, the one with the smallest id.

    Documents without words are connected with nothing and all stay; of rows
    that share the smallest id, one stays if they are equal.
    """
    prepared(spark)
    docs = docs.select(DOCUMENT_COLUMNS)
    groups = staged(jaccard_join.near_duplicates(docs), "pipeline-groups")
    other = groups.where("component_id <> doc_id").select("doc_id").distinct()
    again = groups.where("component_id = doc_id").groupBy("doc_id").count().where("count > 1")
    copies = staged(again.select("doc_id"), "pipeline-repeated")
    alone = pick(docs, staged(other.unionByName(copies), "pipeline-copies"), "left_anti")
    return alone.unionByName(pick(pick(docs, copies, "left_semi"), other, "left_anti").distinct()).select(DOCUMENT_COLUMNS)


def blank_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and ``n_chars`` counted anew."""
    prepared(spark)
    docs = docs.select(DOCUMENT_COLUMNS)
    found = pii.detect(docs, pii.fit(docs), masked="masked")
    return found.withColumns({"text": F.col("masked"), "n_chars": F.length("masked").cast("long")}).select(DOCUMENT_COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated towards shares by the square root of each source's size, shuffled."""
    prepared(spark)
    return mixing.mix(docs.select(DOCUMENT_COLUMNS)).select(DOCUMENT_COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as little-endian unsigned 32-bit integers, and the digest of the text they decode to."""
    import public_tokenizers

    prepared(spark)
    model = sentencepiece_bpe.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    decoded = sentencepiece_bpe.encode_and_decode(docs.select("doc_id", "source", "lang", "text"), model).drop("text")
    digest = F.sha2(F.col("decoded").cast("binary"), 256)
    return decoded.withColumns({"n_tokens": (F.length("token_ids") / 4).cast("long"), "decoded_sha256": digest}).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("pii", blank_personal_data),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_texts),
]
#: Trained models decide in two stages; a brute-force version in tests/llm stands in for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
