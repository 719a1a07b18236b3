"""Plain text lines to cells: `rowkey,family,qualifier,value` and `id,name,age`."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlflow.operators.cells import explode_fields
from crawlflow.operators.judged import good_rows, judged_cells, judged_columns
from crawlflow.operators.records import held, text_map
from crawlflow.sources.tables import csv_cells, csv_person

PERSON_SCHEMA = "id int, name string, age int"
CELL_SCHEMA = "table string, rowkey string, family string, qualifier string, value string"


def judged_line_cells(lines: DataFrame, table: str, line: str = "value") -> DataFrame:
    """A row per line: its cell, or that it has no four parts."""
    cells = held(lines.select(F.col(line).alias("_line"), *csv_cells(F.col(line), table)))
    reason = F.when(F.col("value").isNull(), "no_value")
    return cells.select("table", "rowkey", "family", "qualifier", "value", *judged_columns(reason, F.col("_line")))


def line_cells(lines: DataFrame, table: str, line: str = "value") -> DataFrame:
    """One cell per line; lines without four parts are left out."""
    return good_rows(judged_line_cells(lines, table, line))


def judged_people(lines: DataFrame, line: str = "value") -> DataFrame:
    """A row per line: its id, name and age, or why it is no person."""
    people = held(lines.select(F.col(line).alias("_line"), *csv_person(F.col(line))))
    reason = (
        F.when(F.col("id").isNull(), "bad_id").when(F.col("name").isNull(), "no_name").when(F.col("age").isNull(), "bad_age")
    )
    return people.select("id", "name", "age", *judged_columns(reason, F.col("_line")))


def _person_fields():
    return text_map({"name": F.col("name"), "age": F.col("age").cast("string")})


def person_cells(lines: DataFrame, table: str = "account", line: str = "value") -> DataFrame:
    """Cells of typed `id,name,age` lines, numbers as decimal text.

    Lines whose id or age is no number are left out.
    """
    rows = good_rows(judged_people(lines, line)).select(
        F.lit(table).alias("table"), F.col("id").cast("string").alias("rowkey"), _person_fields().alias("fields")
    )
    return explode_fields(rows).select("table", "rowkey", F.lit("cf").alias("family"), "qualifier", "value")


def judged_person_cells(lines: DataFrame, time: datetime, table: str = "account", line: str = "value") -> DataFrame:
    """Cells of the lines, dead letters included."""
    people = judged_people(lines, line).withColumn("rowkey", F.col("id").cast("string"))
    return judged_cells(people, table, _person_fields(), F.lit("cf"), "lines", time)
