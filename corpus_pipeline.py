"""A corpus pipeline: raw documents become packed training sequences in five stages.

1. quality: documents that the quality rules reject go.
2. exact: of equal texts the row with the largest id stays.
3. near: of each group of near-duplicates one document stays.
4. secrets: secrets inside the texts are replaced by a sign; no document goes.
5. packing: every document is placed, in pieces with their token ids, in sequences of 1024
   tokens; `packing.sequences` puts the ids of a sequence together.

Each stage gets what its predecessor kept, written and read again, so a lost executor
costs a stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.llm.batches import share_code
from finmart.llm import packing, quality, recipes, secrets, simhash
from finmart.sources.scratch import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return recipes.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    return simhash.one_of_each(docs, shingle=4, radius=4)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    masked = secrets.mask_secrets(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, tokenizer, end_id=2, capacity=1024, with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("exact", drop_copies),
    ("near", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Fingerprints and token ids are beyond SQL; tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
