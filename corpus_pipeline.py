"""A corpus from raw documents to token ids, stage by stage.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; `run` writes it as Parquet
to the shared folder and reads it again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from crawlflow.llm.bpe import round_trip
from crawlflow.llm.exact_dedup import exact_dedup
from crawlflow.llm.mixing import mix
from crawlflow.llm.near_dedup import near_dedup
from crawlflow.llm.quality_rules import keep_quality
from crawlflow.llm.shared import scratch_root, table
from crawlflow.sources.shared_files import SharedFiles

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, their host's verdict included."""
    return keep_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the rates that bring the domains to their target weights; none is repeated."""
    return mix(docs, table(spark, sf_dir, "labels"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids and digests of ids and decoded text of each document."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: The classifier, the rates and BPE are not expressible in SQL; tests hold `run` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage wrote is removed once the next one's output is there."""
    folder = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        place = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
        if before:
            SharedFiles(spark, folder).delete(before)
        before = place
    return docs
