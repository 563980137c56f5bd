"""A cleaning and packing pipeline over ``documents``.

Five stages, each on everything its predecessor kept: toxic documents go, of equal texts one
stays, of near-duplicates one stays, sources are mixed to their target weights (a document
appears as often as the mix draws it), and the mix is encoded.  All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import bpe, exact_dedup, minhash, mixing, toxicity
from ledgerline.session import settled, ship_package

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, learned from ``labels``, does not reject."""
    ship_package(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model).where("not toxic").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    ship_package(spark)
    return minhash.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in the shares of their weights."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the check that they decode to its text."""
    ship_package(spark)
    ranks = bpe.read_ranks(VOCABULARY)
    plain = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", "lang", "source", "text", F.sha2(plain, 256).alias("sha"))
    done = bpe.encoded_and_decoded(rows, ranks, public_tokenizers.PATTERN)
    return done.select(
        "doc_id",
        "lang",
        "source",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        (F.sha2("decoded", 256) == F.col("sha")).alias("decodes"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("minhash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level bpe", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
