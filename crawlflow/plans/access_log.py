"""Access-log lines to typed records with item and type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlflow.functions.texts import log_item, log_type
from crawlflow.operators.judged import good_rows, judged_columns
from crawlflow.operators.records import held
from crawlflow.sources.tables import access_log_columns

RECORD_SCHEMA = "vtime long, muid string, uid string, item string, types string"


def judged_access_records(lines: DataFrame, line: str = "value") -> DataFrame:
    """A row per line: its record, or why it has none.

    Rejected are lines that name no visitor, whose time or car-series number is no number, or that have no type.
    """
    parts = lines.select(F.col(line).alias("_line"), F.split(line, "\t").alias("parts"))
    columns = held(parts.select("_line", *access_log_columns(F.col("parts"))))
    visitor = F.col("muid").isNotNull() & ~F.col("muid").isin("null", "")
    facts = [F.col(c) for c in ("category", "ucp", "news_id", "auto_sid", "dealer_id", "tuan_id")]
    category, page, news, auto_id, dealer, deal = facts
    records = held(
        columns.select(
            "_line",
            visitor.alias("_visitor"),
            F.col("auto_sid").isNotNull().alias("_series"),
            "vtime",
            "muid",
            "uid",
            log_item(category, page, auto_id, dealer, deal).alias("item"),
            log_type(category, page, news, auto_id, dealer, deal).alias("types"),
        )
    )
    reason = (
        F.when(~F.col("_visitor"), "no_visitor")
        .when(F.col("vtime").isNull(), "bad_time")
        .when(~F.col("_series"), "bad_series")
        .when(F.col("types").isNull(), "no_type")
    )
    return records.select("vtime", "muid", "uid", "item", "types", *judged_columns(reason, F.col("_line")))


def access_records(lines: DataFrame, line: str = "value") -> DataFrame:
    """Records of the lines that have one."""
    return good_rows(judged_access_records(lines, line))
