"""Lookups: fixed maps as literals, dimension tables as joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.fixed_values import ENGINE_NAMES, SEARCH_TYPE_GROUPS
from crawlflow.operators.records import text_map


def map_lookup(key: Column, entries: Mapping[str, str], default: str) -> Column:
    """Value of `key` in a fixed map. The map is a literal, so no join is planned."""
    return F.coalesce(F.element_at(text_map(entries), key), F.lit(default))


def engine_name(engine_id: Column) -> Column:
    return map_lookup(engine_id, ENGINE_NAMES, "")


def search_type_group(search_type: Column) -> Column:
    return map_lookup(search_type, SEARCH_TYPE_GROUPS, "0")


def one_row_per_key(dimension: DataFrame, key: str, value: str) -> DataFrame:
    """Dimension with one value per key (the largest), so a join never multiplies rows."""
    return dimension.groupBy(F.col(key).alias("dim_key")).agg(F.max(value).alias("dim_value"))


def dimension_lookup(
    df: DataFrame, key: str, dimension: DataFrame, dim_key: str, dim_value: str, into: str
) -> DataFrame:
    """Left join with a dimension; `into` is null where the key is unknown.

    No broadcast hint: Spark broadcasts the dimension while its measured size is
    below spark.sql.autoBroadcastJoinThreshold, and beyond that sorts and merges
    with adaptive splitting of hot keys.
    """
    values = one_row_per_key(dimension, dim_key, dim_value)
    return (
        df.join(values, df[key] == values["dim_key"], "left")
        .withColumn(into, F.col("dim_value"))
        .drop("dim_key", "dim_value")
    )


def fill_from_dimension(
    df: DataFrame, column: str, key: str, dimension: DataFrame, dim_key: str, dim_value: str
) -> DataFrame:
    """Fill an empty column from a dimension, '' where the key is unknown."""
    joined = dimension_lookup(df, key, dimension, dim_key, dim_value, "_found")
    given = F.when(F.coalesce(F.col(column), F.lit("")) != "", F.col(column))
    return joined.withColumn(column, F.coalesce(given, F.col("_found"), F.lit(""))).drop("_found")
