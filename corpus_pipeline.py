"""The corpus pipeline: documents to packed sequences, in five stages.

Each stage is (name, function of (spark, docs, sf_dir)) and works on all rows that the one
before it kept; its rows are written as Parquet and read again for the next. All stages
but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladewerk.llm import near_documents as near
from ladewerk.llm import packing, pii, quality, suffix_dedup
from ladewerk.llm.common import released, shared_folder, table
from ladewerk.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_chars(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the likelihood ratio reject."""
    return quality.quality(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near-duplicates."""
    return near.drop_near_duplicates(docs.select(*COLUMNS), 5, 0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that a string of 100 bytes starting earlier covers; a
    character of which a part goes, goes whole. Texts that end up empty stay as rows."""
    found = suffix_dedup.suffix_repeats(docs, 100, ("lang", "source"))
    return _with_chars(found.withColumn("text", suffix_dedup.kept_text("kept")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind in brackets."""
    found = pii.find_pii(docs.select(*COLUMNS))
    return _with_chars(found.withColumn("text", pii.redacted()))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), 1024)


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("pii", personal_data),
    ("packing", packed_sequences),
]

#: Trained models, hashes of n-grams and component search are beyond SQL: the stages are
#: tested against brute force on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        with released(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
