"""Subscriptions valid now, grouped by city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crawlflow.operators.explode import explode_codes
from crawlflow.operators.routes import is_valid_at


def valid_by_city(subscriptions: DataFrame, now_ms: Column) -> DataFrame:
    """One row per valid subscription and city it covers (`city` int)."""
    valid = subscriptions.where(is_valid_at(F.col("start_time"), F.col("end_time"), now_ms))
    cities = explode_codes(valid, "city_code", "_city")
    return cities.withColumn("city", F.col("_city").try_cast("int")).drop("_city")


def city_entries(by_city: DataFrame, id_column: str = "sub_id", buckets: int = 64) -> DataFrame:
    """A row per subscription of a city, with its list (`list_no`) and its place there (`list_pos`, from 1).

    The list follows from the subscription's id alone, so a hot city is dealt out before the one
    shuffle; a list's places follow its subscriptions in the order of their fields. Nothing is gathered into an array: a
    task sorts the lists it gets, on disk if they are long. All lists of a city together are its entry.
    Codes that are no number make the entry of the null city.
    """
    digest = F.conv(F.substring(F.md5(F.col(id_column).cast("string")), 1, 8), 16, 10).cast("long")
    placed = by_city.withColumn("list_no", (digest % buckets).cast("int"))
    fields = [c for c in by_city.columns if c != "city"]
    within = Window.partitionBy("city", "list_no").orderBy(*fields)
    return placed.withColumn("list_pos", F.row_number().over(within))
