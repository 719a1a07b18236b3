"""Small text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlflow.fixed_values import (
    EMPTY_TITLE,
    LOG_CATEGORY_PATTERN,
    LOG_ITEM_URL_PATTERN,
    LOG_TYPE_URL_PATTERN,
    REPLY_SEPARATOR,
)


def is_blank(text: Column) -> Column:
    """True for null and for text of white space only."""
    return text.isNull() | text.rlike(r"^\p{javaWhitespace}*$")


def blank_to_empty(text: Column) -> Column:
    """'' for null and white space, the text itself otherwise."""
    return F.when(is_blank(text), "").otherwise(text)


def rehash_id(text: Column) -> Column:
    """Second part of an id made of exactly two dash-separated parts, else the id."""
    second = F.regexp_extract(text, r"^[^-]*-([^-]+)-*$", 1)
    return F.when(second != "", second).otherwise(text)


def reverse_text(text: Column) -> Column:
    return F.reverse(text)


def marker_to_empty(text: Column, missing: str = "") -> Column:
    """'' for '' and '(null)'; `missing` for a value that is not there."""
    return F.when(text.isNull(), missing).when(text.isin("", "(null)"), "").otherwise(text)


def marked_title(text: Column) -> Column:
    """Title or content with a marker in place of an empty value."""
    return F.when(text.isNull() | text.isin("", "null", "(null)"), EMPTY_TITLE).otherwise(text)


def split_parts(text: Column, separator: str = REPLY_SEPARATOR) -> Column:
    """Parts of a text split on a literal separator, empty parts kept."""
    literal = "".join("\\" + c if not c.isalnum() else c for c in separator)
    return F.split(text, literal, -1)


def without_trailing_empty(parts: Column, text: Column) -> Column:
    """Drop the empty parts at the end; a text without separator stays one part."""
    last = F.array_max(F.transform(parts, lambda p, i: F.when(p != "", i + 1).otherwise(0)))
    return F.when(text == "", parts).otherwise(F.slice(parts, F.lit(1), last))


def _given(text: Column) -> Column:
    return text.isNotNull() & (text != "null")


def _full_match(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(f"^(?:{pattern})$"), F.lit(False))


def log_item(category: Column, page: Column, auto_id: Column, dealer: Column, deal: Column) -> Column:
    """Item an access-log line is about; null when there is none."""
    return (
        F.when(
            _given(category),
            F.when(_full_match(page, LOG_ITEM_URL_PATTERN), F.substring(page, 34, 9)),
        )
        .when(auto_id != 0, auto_id.cast("string"))
        .when(_given(dealer), dealer)
        .when(_given(deal), deal)
    )


def log_type(
    category: Column, page: Column, news: Column, auto_id: Column, dealer: Column, deal: Column
) -> Column:
    """Type code of an access-log line; null when it has none."""
    article = _full_match(page, LOG_TYPE_URL_PATTERN)
    return (
        F.when(
            _given(category),
            F.when(article & _full_match(category, LOG_CATEGORY_PATTERN), "nv")
            .when(_given(news) & article, "ns")
            .when(article, "ne"),
        )
        .when(auto_id != 0, "as")
        .when(_given(dealer), "di")
        .when(_given(deal), "ti")
    )
