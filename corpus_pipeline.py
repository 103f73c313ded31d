"""A training-data pipeline over ``documents``.

Every stage takes what its predecessor kept, written as Parquet and read again,
and all but the last return the columns of ``documents``:

quality    documents that the rule ensemble scores below 0.7 go
near_dups  one document of each group of exact and near copies stays
pii        validated numbers, dates and addresses get pseudonyms
mixing     sources are resampled towards 150 % of the words, weights 3, 1, 2;
           a document comes as often as the mix takes it
tokens     byte-level BPE ids of each text, and the text decoded from them
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import bpe, mixing, pii, quality, simhash
from quillstone.llm.common import materialize
from quillstone.session import ship

#: A run on real data names its key in this session setting; the other one is of
#: the synthetic tables only and keeps nothing secret.
KEY_SETTING = "spark.quillstone.pii.key"
CONTRACT_KEY = "quillstone contract pipeline"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.unique_documents(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    key = spark.conf.get(KEY_SETTING, None) or CONTRACT_KEY
    out = pii.pseudonymize(docs, key=key.encode(), spans=None)
    if "n_chars" in docs.columns:  # an address may get longer or shorter
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    out = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text")))
    return out.select("doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("quality", quality_stage),
    ("near_dups", near_duplicate_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: Models, fingerprints and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's result, each stage a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
