"""Helpers that several operators of this package use."""

from __future__ import annotations

import ctypes
import json
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, as the contracts name it.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a folder of its own only in local mode without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="llm-checkpoints-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def pinned(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the shared checkpoint folder: its lineage ends there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)


def give_back() -> None:
    """Return freed memory to the system; a worker that waits for its next task would keep it."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def at_rest(
    run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], forget: Callable[[], None]
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for tasks, after each of which the worker forgets and gives back what it no longer needs.

    Workers outlive their tasks, and those of one executor serve every operator: what all have left lies side by side.
    """

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            forget()
            give_back()

    return whole


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def text_of(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text that is not null."""
    inner = F.trim(text, F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_CLASS, -1))


def rows_of(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table of driver values, as rows of one literal."""
    literal = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(literal).alias("r")).select("r.*")
