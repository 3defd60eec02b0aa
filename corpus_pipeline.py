"""The corpus pipeline: documents in, packed training windows out.

Each stage works on all that the one before has kept; its result is written as Parquet in the shared
folder and read again, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmill.llm import langid
from salesmill.llm.decontaminate import remove_contaminated
from salesmill.llm.jaccard import keep_one
from salesmill.llm.packing import pack_evenly
from salesmill.llm.pii import redact
from salesmill.session import written


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language: those without a letter, or undecided between languages, go."""
    return langid.keep_identified(docs, langid.fit(docs.select("doc_id", "text", "lang")))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingles are alike, the one of smallest doc_id."""
    return keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with e-mail and IP addresses, card and phone numbers replaced by their kind."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the windows that hold them."""
    return pack_evenly(docs)


STAGES = [
    ("language_id", identified),
    ("jaccard_join", deduplicated),
    ("decontamination", decontaminated),
    ("personal_data", redacted),
    ("packing", packed),
]
#: Tokens and language models are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
