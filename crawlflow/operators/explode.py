"""One row to many: reply threads and code lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.functions.texts import split_parts, without_trailing_empty


def explode_replies(df: DataFrame, content: str = "replycontent", keep_empty: bool = False) -> DataFrame:
    """One row per reply: `floorid` (the first reply is floor 2) and the reply text.

    Empty parts are numbered but left out, unless `keep_empty`; then only the
    empty parts at the end of the thread are left out. Rows whose content is
    null come out once, with both columns null. Floors differ, so the replies
    of one message are distinct without a shuffle.
    """
    others = [c for c in df.columns if c != content]
    parts = split_parts(F.col(content))
    if keep_empty:
        parts = without_trailing_empty(parts, F.col(content))
    floors = df.select(*others, F.posexplode_outer(parts).alias("floor_pos", content))
    if not keep_empty:
        floors = floors.where(F.col(content).isNull() | (F.col(content) != ""))
    return floors.withColumn("floorid", (F.col("floor_pos") + 2).cast("int")).drop("floor_pos")


def explode_codes(df: DataFrame, codes: str, into: str, separator: str = "|") -> DataFrame:
    """One row per code of a separated list, empty codes left out."""
    code = F.explode(split_parts(F.col(codes), separator))
    return df.withColumn(into, code).where(F.col(into) != "")


def floor_url(url: Column, floor: Column) -> Column:
    """URL of one reply; a missing URL reads 'null', as stored before."""
    return F.concat(F.coalesce(url, F.lit("null")), F.lit("#"), floor.cast("string"))
