"""From raw documents to packed training windows, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and
read again as the next stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm import minhash, mixing, packing, quality, surrogates
from ratelake.llm.queries import SURROGATE_KEY, packing_tokenizer
from ratelake.session import materialize

# The stage links from 0.8; the 0.85 of the query op10 is its own. A pair at 0.8 is found
# with probability 0.9996 in 12 bands (0.9935 in 8).
NEAR_PERCENT = 80
NEAR_BANDS = 12


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; shingle sets that overlap in 80 % are linked."""
    return minhash.keep_one(docs, NEAR_PERCENT, NEAR_BANDS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to surrogates; the number of characters follows."""
    made = surrogates.pseudonymized(docs, SURROGATE_KEY)
    if "n_chars" in made.columns:
        made = made.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return made.select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share of the words asks for."""
    return mixing.mixed(docs)


def window_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids and their place in the windows."""
    return packing.pack(docs, packing_tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("pii", pii),
    ("mixing", mixing_sources),
    ("packing", window_packing),
]

# Surrogates and tokens are not expressible in SQL; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
