"""Time texts: lenient parsing to epoch milliseconds, normalising, repair.

The accepted texts are those of a lenient calendar: out-of-range fields roll
over (month 13 is January of the next year) and text after the last field is
ignored. All of it is plain date arithmetic, so it stays in generated code and
never raises on bad input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.fixed_values import EPOCH_TEXT, PUBLISH_TIME_PATTERN

# Usual shape: every field at its place. Anything else takes the slower way.
_PLAIN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?!\d)"
_DASHED = (
    r"^[ \t]*(\d{1,5})-[ \t]*(\d{1,4})-[ \t]*(\d{1,4}) [ \t]*(\d{1,6}):[ \t]*(\d{1,6}):[ \t]*(\d{1,8})"
)
_COMPACT = r"^\d{12}(\d{1,2})"


def _epoch_millis(parts: list[Column], zone: str | None, clock12: bool = False) -> Column:
    """Epoch ms of year to second texts; fields out of range roll over."""
    year, month, day, hour, minute, second = (part.try_cast("int") for part in parts)
    if clock12:
        hour = F.when(hour == 12, 0).otherwise(hour)
    first_of_month = F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1)
    days = F.unix_date(first_of_month).cast("long") + day - 1
    local = days * 86400 + hour.cast("long") * 3600 + minute.cast("long") * 60 + second
    if zone == "UTC":
        return local * 1000
    zone_column = F.lit(zone) if zone else F.current_timezone()
    return F.unix_millis(F.to_utc_timestamp(F.timestamp_seconds(local), zone_column))


def _at(text: Column, *places: tuple[int, int]) -> list[Column]:
    return [F.substring(text, start, size) for start, size in places]


def dashed_millis(text: Column, zone: str | None = None, clock12: bool = False) -> Column:
    """Epoch ms of `yyyy-MM-dd HH:mm:ss` text, null when it cannot be read.

    `zone` defaults to the session time zone. With `clock12`, hour 12 is midnight.
    """
    plain = _at(text, (1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2))
    found = [F.regexp_extract(text, _DASHED, i) for i in range(1, 7)]
    return F.when(text.rlike(_PLAIN), _epoch_millis(plain, zone, clock12)).when(
        text.rlike(_DASHED), _epoch_millis(found, zone, clock12)
    )


def dual_millis(text: Column, zone: str | None = None) -> Column:
    """Epoch ms of dashed text, or of `yyyyMMddHHmmss` text of at most 14 characters."""
    digits = _at(text, (1, 4), (5, 2), (7, 2), (9, 2), (11, 2))
    second = F.regexp_extract(text, _COMPACT, 1)
    compact = F.when(text.rlike(_COMPACT), _epoch_millis([*digits, second], zone))
    return F.when(F.length(text) <= 14, compact).otherwise(dashed_millis(text, zone))


def millis_text(millis: Column, on_error: Column | str | None) -> Column:
    """Epoch-ms column as text with a fallback for unreadable times.

    `on_error` is a text (such as '0'), a column of epoch ms (such as the ingest
    time), None to leave null, or 'raise' to fail the job.
    """
    text = millis.cast("string")
    if on_error is None:
        return text
    if isinstance(on_error, str) and on_error == "raise":
        return F.coalesce(text, F.raise_error(F.lit("unreadable time text")).cast("string"))
    fallback = F.lit(on_error) if isinstance(on_error, str) else on_error.cast("string")
    return F.coalesce(text, fallback)


def _compact_to_dashed(text: Column) -> Column:
    """Dashed text from the digits of a 14, 13, 12 or 8 character text, else null."""
    size = F.length(text)
    date = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    minutes = F.concat_ws(":", F.substring(text, 9, 2), F.substring(text, 11, 2))
    return (
        F.when(size == 14, F.concat(date, F.lit(" "), minutes, F.lit(":"), F.substring(text, 13, 2)))
        .when(size.isin(12, 13), F.concat(date, F.lit(" "), minutes, F.lit(":00")))
        .when(size == 8, F.concat(date, F.lit(" 00:00:00")))
    )


def normalise_time(text: Column) -> Column:
    """Dashed text: kept when readable, built from compact digits, else the epoch text."""
    blank = text.isNull() | text.isin("", "NULL")
    dashed = F.when(dashed_millis(text, "UTC").isNotNull(), text)
    return F.when(blank, EPOCH_TEXT).otherwise(
        F.coalesce(
            F.when(text.contains("-"), dashed).otherwise(_compact_to_dashed(text)),
            F.lit(EPOCH_TEXT),
        )
    )


def with_repaired_publish_time(df: DataFrame, sent: str, gather: str) -> DataFrame:
    """Add `publishtime` and `publishtime_str` (the raw text of a replaced time).

    The publish time must hold a date between 2000 and 2039; otherwise the
    (already normalised) gather time takes its place. Each step is a column of
    its own, so no text is matched twice.
    """
    text, gathered = F.col(sent), F.col(gather)
    candidate = (
        F.when(text.isNull() | text.isin("", "NULL"), gathered)
        .when(
            text.contains("-"),
            F.when((F.length(text) == 16) & text.contains(" "), F.concat(text, F.lit(":00"))).when(
                text.rlike(PUBLISH_TIME_PATTERN), text
            ),
        )
        .otherwise(_compact_to_dashed(text))
    )
    first = F.coalesce(F.col("_candidate"), gathered)
    good = F.col("_first").rlike(PUBLISH_TIME_PATTERN) & ~F.col("_first").contains("&quot;")
    replaced = F.when(F.col("_candidate").isNull(), text).otherwise("")
    return (
        df.withColumn("_candidate", candidate)
        .withColumn("_first", first)
        .withColumn("_good", good)
        .withColumns(
            {
                "publishtime": F.when(F.col("_good"), F.col("_first")).otherwise(gathered),
                "publishtime_str": F.when(F.col("_good"), replaced).otherwise(F.col("_first")),
            }
        )
        .drop("_candidate", "_first", "_good")
    )
