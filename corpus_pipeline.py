"""The corpus pipeline: documents to packed sequences in five written stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next stage's
``docs``.  All but the last return the columns of ``documents``.

1. quality rules: documents that the repetition rules reject go;
2. n-gram join: of every group of near copies the smallest ``doc_id`` stays;
3. decontamination: documents that contain a benchmark item go;
4. personal data: every span is replaced by its kind;
5. packing: what is left is tokenised and packed into sequences.

Packing runs a tokenizer, which SQL cannot express, so there is no SQL for
the whole (``ORACLE_SQL`` is None); the tests hold ``run`` against a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelscope.llm.decontaminate import without_contaminated
from reelscope.llm.ngram_join import one_of_each_group
from reelscope.llm.packing import pack_documents
from reelscope.llm.pii_bootstrap import redact
from reelscope.llm.queries import tokenizer_path
from reelscope.llm.repetition import keep_good
from reelscope.llm.staging import Staging

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("n-gram join", deduplicate),
    ("decontamination", decontaminate),
    ("personal data", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's result written and read again."""
    stage = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, step) in enumerate(STAGES):
        docs = stage.write(step(spark, docs, sf_dir), f"stage{number}")
    return docs
