"""Record level: JSON text to a field map, key repair, padding, overrides.

A record is a `map<string,string>` column. These are expressions over that
column; none needs the map to be rebuilt entry by entry.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.session import configure

_JSON_OPTIONS = {"allowUnquotedFieldNames": "true"}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def empty_map() -> Column:
    return F.expr("cast(map() as map<string,string>)")


def text_map(values: Mapping[str, Column | str]) -> Column:
    """Map of literal keys to columns or literal texts."""
    if not values:
        return empty_map()
    if all(isinstance(value, str) for value in values.values()):
        # One expression text instead of two calls into the JVM per entry.
        pairs = ", ".join(f"{_quoted(key)}, {_quoted(value)}" for key, value in values.items())
        return F.expr(f"map({pairs})")
    columns: list[Column] = []
    for key, value in values.items():
        columns += [F.lit(key), value if isinstance(value, Column) else F.lit(value)]
    return F.create_map(*columns)


def parse_fields(value: Column) -> Column:
    """Field map of one JSON object text; null when the text is not one object.

    Numbers, booleans and nested values keep their JSON text. Text after the
    closing brace makes the message unreadable.
    """
    parsed = F.from_json(value, "map<string,string>", _JSON_OPTIONS)
    return F.when(F.rtrim(value).endswith("}"), parsed)


def has_field(fields: Column, name: str) -> Column:
    return F.map_contains_key(fields, F.lit(name))


def field(fields: Column, name: str) -> Column:
    """Value of a field: '' when present but JSON null, null when not there."""
    value = F.element_at(fields, F.lit(name))
    return F.when(has_field(fields, name), F.coalesce(value, F.lit("")))


def repair_names(fields: Column, repairs: Mapping[str, str]) -> Column:
    """Copy each misspelt field to its right name; the copy wins over an existing value.

    The misspelt names stay in the map and are left out when it becomes cells.
    Duplicate keys of the message collapse here, the last one wins.
    """
    if not repairs:
        return F.map_from_entries(F.map_entries(fields))
    copies = [
        F.when(
            has_field(fields, wrong),
            F.create_map(F.lit(right), F.element_at(fields, F.lit(wrong))),
        ).otherwise(empty_map())
        for wrong, right in repairs.items()
    ]
    return F.map_concat(fields, *copies)


def padded(fields: Column, names: Iterable[str]) -> Column:
    """Fields plus an empty value for every declared name that is missing."""
    return F.map_concat(text_map({name: "" for name in names}), fields)


def held(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed below this point.

    A filter on a derived column is normally rewritten in terms of the source
    columns and moved down to the scan, which would parse each message once per
    mention of the column. Passing the row through a one-element explode keeps
    such filters above.
    """
    return df.selectExpr("explode_outer(array(struct(*))) as _held").select("_held.*")


def with_records(
    messages: DataFrame, repairs: Mapping[str, str] | None = None, column: str = "fields"
) -> DataFrame:
    """Add the field map of `value`; unreadable messages get null."""
    configure(messages.sparkSession)
    return messages.withColumn(column, parse_fields(F.col("value"))).withColumn(
        column, repair_names(F.col(column), repairs or {})
    )


def readable_records(
    messages: DataFrame, repairs: Mapping[str, str] | None = None, column: str = "fields"
) -> DataFrame:
    """Messages with their field map, without the unreadable ones."""
    return held(with_records(messages, repairs, column)).where(F.col(column).isNotNull())
