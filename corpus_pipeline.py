"""A training corpus from raw documents: five operators, each stage written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.chunks import checkpoint_ready
from parley.llm.decontamination import decontaminated
from parley.llm.jaccard_join import first_of_each
from parley.llm.packing import best_fit_packing
from parley.llm.quality_rules import quality_rules
from parley.llm.queries import table, tokenizer_file
from parley.llm.substring_dedup import substring_dedup


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules(docs, table(spark, sf_dir, "labels"), with_columns=True)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; n_chars follows the text."""
    kept = substring_dedup(docs, with_columns=True)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", accept),
    ("jaccard_join", one_of_each),
    ("substring_dedup", without_repeats),
    ("decontamination", without_leaks),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Stages are written below the checkpoint folder, which the cluster shares."""
    docs = table(spark, sf_dir, "documents")
    checkpoint_ready(docs)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The forest, the tokenizer and the plan are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None
