"""The corpus pipeline: from raw documents to token records, one operator after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import decontamination, mixing, records, simhash
from feedloom.llm.queries import table, tokenizer_path, toxicity_model
from feedloom.llm.toxicity import reject_toxic
from feedloom.session import scratch_folder

#: Toxicity and tokenization run in Python, so SQL cannot say it; tests compare with brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring 0.3 or more go. The model learns from the labelled documents."""
    model = toxicity_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return reject_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target of its source takes it."""
    return mixing.mixed_rows(docs)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Binary token records, written and read back: one row per record."""
    folder = scratch_folder(spark, "corpus")
    records.write_records(docs, folder, tokenizer_path())
    return records.digest(records.read_records(spark, folder))


STAGES = [
    ("toxicity", toxicity),
    ("simhash", near_duplicates),
    ("decontamination", benchmark_free),
    ("mixing", mixed),
    ("token_records", token_records),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = f"{scratch_folder(spark, f'stage-{name}')}/rows"
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(folder)
        docs = spark.read.schema(kept.schema).parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
