"""Table sources: field lists, JDBC dimensions, separated text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_FIELD_NAMES = 10_000


def read_field_list(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Declared field names from a text file, one per line.

    The names end up in the plan itself, so the file must be small; a long file
    is refused rather than cut.
    """
    names = (
        spark.read.text(path)
        .select(F.trim("value").alias("name"))
        .where(F.col("name") != "")
        .distinct()
        .limit(MAX_FIELD_NAMES + 1)
        .collect()
    )
    if len(names) > MAX_FIELD_NAMES:
        raise ValueError(f"{path} has more than {MAX_FIELD_NAMES} names; not a field list")
    return tuple(sorted(row["name"] for row in names))


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Reader or writer options; with a split column the read runs as parallel ranges."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    if split_column and bounds:
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Dimension or subscription table of a database. Filters reach the database."""
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, options: dict[str, str], batch_rows: int = 1000) -> None:
    """Append rows to a database table, one connection per partition."""
    df.write.format("jdbc").options(**options).option("batchsize", batch_rows).mode("append").save()


def csv_cells(line: Column, table: str) -> list[Column]:
    """Cell columns of a `rowkey,family,qualifier,value` line."""
    parts = F.split(line, ",")
    return [
        F.lit(table).alias("table"),
        F.get(parts, F.lit(0)).alias("rowkey"),
        F.get(parts, F.lit(1)).alias("family"),
        F.get(parts, F.lit(2)).alias("qualifier"),
        F.get(parts, F.lit(3)).alias("value"),
    ]


def csv_person(line: Column) -> list[Column]:
    """Typed columns of an `id,name,age` line; a bad number gives null."""
    parts = F.split(line, ",")
    return [
        F.get(parts, F.lit(0)).try_cast("int").alias("id"),
        F.get(parts, F.lit(1)).alias("name"),
        F.get(parts, F.lit(2)).try_cast("int").alias("age"),
    ]


def access_log_columns(parts: Column) -> list[Column]:
    """Columns of an access-log line, from the array of its tab-separated parts."""

    def at(i: int) -> Column:
        return F.get(parts, F.lit(i))

    return [
        at(9).try_cast("long").alias("vtime"),
        at(1).alias("muid"),
        at(0).alias("uid"),
        at(3).alias("ucp"),
        at(25).alias("category"),
        at(18).try_cast("int").alias("auto_sid"),
        at(29).alias("dealer_id"),
        at(30).alias("tuan_id"),
        at(28).alias("news_id"),
    ]
