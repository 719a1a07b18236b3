"""Cell level: records to cells, value cleaning, column families, latest cell, rows.

A cell is (table, rowkey, family, qualifier, value) plus the columns that order
repeated writes of the same cell.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.fixed_values import SNAPSHOT
from crawlflow.functions.texts import blank_to_empty

CELL_COLUMNS = ("table", "rowkey", "family", "qualifier", "value")
CELL_KEY = ("table", "rowkey", "family", "qualifier")
ROW_KEY = ("table", "rowkey")
ORDER_COLUMNS = ("put_ms", "batch_id", "src_partition", "src_offset", "src_topic", "writer", "run")


def explode_fields(df: DataFrame, fields: str = "fields", drop: Iterable[str] = ()) -> DataFrame:
    """One row per field: `qualifier` and `value`, without the names in `drop`.

    The outer form keeps the optimizer from testing the map size in a filter
    below, which would parse each message a second time.
    """
    others = [c for c in df.columns if c != fields]
    cells = df.select(*others, F.explode_outer(fields).alias("qualifier", "value"))
    dropped = list(drop)
    return cells.where(~F.col("qualifier").isin(dropped)) if dropped else cells


def null_to_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def clean_value(
    qualifier: Column, value: Column, blanks: bool = False, keep_blank: Iterable[str] = ()
) -> Column:
    """Stored value: never null; white space becomes '' where `blanks` is set."""
    if not blanks:
        return null_to_empty(value)
    kept = list(keep_blank)
    cleaned = blank_to_empty(value)
    return F.when(qualifier.isin(kept), null_to_empty(value)).otherwise(cleaned) if kept else cleaned


def family_of(qualifier: Column, split: bool = True) -> Column:
    """Column family: the page snapshot lies apart from the other fields when `split`."""
    return F.when(qualifier == SNAPSHOT, "c2").otherwise("c1") if split else F.lit("c1")


def order_of(df: DataFrame) -> Column:
    """Write order of cells: by time of the write, position and topic in the source, then writer and run."""
    return F.struct(*[F.col(c) for c in ORDER_COLUMNS if c in df.columns])


def latest_cells(cells: DataFrame, order: Column | None = None) -> DataFrame:
    """Last written value of every cell.

    One aggregation with map-side combine: a row key written a billion times
    leaves each task as one row per column, so a hot key costs no more than a
    cold one after the shuffle.
    """
    by = order if order is not None else order_of(cells)
    keys = [c for c in CELL_KEY if c in cells.columns]
    return cells.groupBy(*keys).agg(F.max_by("value", by).alias("value"))


def rows_of(latest: DataFrame) -> DataFrame:
    """Rows of latest cells: the maps `c1` and `c2`, and `other_families` with a map per other family.

    The input holds one row per cell, so a row collects as many entries as it
    has columns.
    """
    keys = [c for c in ROW_KEY if c in latest.columns]

    def family(name: str) -> Column:
        entry = F.when(F.col("family") == name, F.struct("qualifier", "value"))
        return F.map_from_entries(F.sort_array(F.collect_list(entry))).alias(name)

    other = F.when(~F.col("family").isin("c1", "c2"), F.struct("family", "qualifier", "value"))
    rows = latest.groupBy(*keys).agg(family("c1"), family("c2"), F.sort_array(F.collect_list(other)).alias("_other"))

    def cells_in(name: Column) -> Column:
        mine = F.filter("_other", lambda cell: cell["family"] == name)
        return F.map_from_entries(F.transform(mine, lambda cell: F.struct(cell["qualifier"], cell["value"])))

    names = F.array_distinct(F.transform("_other", lambda cell: cell["family"]))
    others = F.map_from_entries(F.transform(names, lambda name: F.struct(name, cells_in(name))))
    return rows.withColumn("other_families", others).drop("_other")


def rows_with_columns(
    cells: DataFrame, columns: Iterable[str], order: Column | None = None
) -> DataFrame:
    """Rows with the current value of the named columns side by side; null where not written.

    Takes all writes of the cells and merges them in the same aggregation that
    builds the rows, so there is one shuffle, of at most one row per key and task.
    """
    by = order if order is not None else order_of(cells)
    keys = [c for c in ROW_KEY if c in cells.columns]
    names = list(columns)

    def current(name: str) -> Column:
        mine = F.col("qualifier") == name
        return F.max_by(F.when(mine, F.col("value")), F.when(mine, by)).alias(name)

    wanted = cells.where(F.col("qualifier").isin(names))
    return wanted.groupBy(*keys).agg(*[current(name) for name in names])
