"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, folder) and returns a frame; the driver of the
stages writes it as Parquet and reads it back as the next one's documents. All
stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import decontamination, line_dedup, packing, simhash, toxicity
from landfall.llm.common import prepare, table
from landfall.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    prepare(spark)
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without the lines that much of their source shares."""
    prepare(spark)
    cleaned = line_dedup.drop_boilerplate(docs, counts=False)
    cleaned = cleaned.withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies."""
    prepare(spark)
    return simhash.keep_one(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that do not hold passages of the benchmark."""
    prepare(spark)
    benchmark = table(spark, folder, "benchmark", "item_id", "text")
    return decontamination.decontaminate(docs, benchmark).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where each piece of each document goes."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

# Hashes, fitted models and token ids are beyond SQL; the tests hold the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
