"""Judged rows: what a plan makes of each record, and why it rejects one.

A plan that has no cells of its own gives one row per record with two more columns: the reason of a reject
(null: good) and the record it was read from. Good rows and rejects come from one scan and can be written in one job.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.operators.records import held, text_map

REASON, RECORD = "reject_reason", "reject_record"
DEAD_LETTERS = "_dead_letter"


def judged_columns(reason: Column, record: Column) -> list[Column]:
    """The two columns of judged rows; the record is kept for rejects only."""
    return [reason.alias(REASON), F.when(reason.isNotNull(), F.coalesce(record, F.lit(""))).alias(RECORD)]


def good_rows(judged: DataFrame) -> DataFrame:
    return held(judged).where(F.col(REASON).isNull()).drop(REASON, RECORD)


def rejected_rows(judged: DataFrame) -> DataFrame:
    """reason and record of the rejects."""
    rejects = judged.where(F.col(REASON).isNotNull())
    return rejects.select(F.col(REASON).alias("reason"), F.col(RECORD).alias("record"))


def judged_cells(judged: DataFrame, table: str | Column, fields: Column, family: Column, source: str, time: datetime) -> DataFrame:
    """Cells of judged rows with a `rowkey`; a reject becomes the cells of a dead letter.

    `fields` is the map of a good row, `family` may use its `qualifier`. A dead letter's key is its
    position in the source, or without one a digest of its record; equal records of a batch share that.
    """
    good = F.col(REASON).isNull()
    if time.tzinfo is None:
        time = time.replace(tzinfo=timezone.utc)
    dead = text_map(
        {
            "time": F.lit(time.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")),
            "topic": F.lit(source),
            "record": F.col(RECORD),
            "errmsg": F.col(REASON),
        }
    )
    position = [c for c in ("src_partition", "src_offset", "src_topic") if c in judged.columns]
    if "src_offset" in position:
        place = F.concat_ws("_", *[F.col(c).cast("string") for c in ("src_topic", "src_partition", "src_offset")])
    else:
        place = F.concat(F.lit(f"{source}_"), F.md5(RECORD))
    rows = judged.select(
        good.alias("_good"),
        F.when(good, table if isinstance(table, Column) else F.lit(table)).otherwise(DEAD_LETTERS).alias("table"),
        F.when(good, F.col("rowkey")).otherwise(place).alias("rowkey"),
        F.when(good, fields).otherwise(dead).alias("fields"),
        *position,
    )
    others = ["_good", "table", "rowkey", *position]
    cells = held(rows).select(*others, F.explode_outer("fields").alias("qualifier", "value"))
    return cells.select(
        "table", "rowkey", F.when(F.col("_good"), family).otherwise("c1").alias("family"), "qualifier", "value", *position
    )
