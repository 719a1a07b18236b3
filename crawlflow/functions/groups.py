"""Group of a site, from its id and the page URL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlflow.fixed_values import WECHAT_URL


def whole_number(text: Column) -> Column:
    """Int of a plain decimal text, null for anything else (blanks and '5.0' included)."""
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("int"))


def site_group(site: Column, url: Column, default: str) -> Column:
    """Group id as the jobs assign it; `default` where no rule applies.

    `site` is the site id as an int column (see `whole_number`), computed once
    before, since every rule reads it.
    """
    news = site.between(1, 59999) | site.between(70000, 89999) | site.between(100000, 199999)
    abroad = (
        site.between(-90293, -90000)
        | site.between(-90360, -90334)
        | site.between(-90400, -90370)
        | site.between(-90368, -90361)
    )
    return (
        F.when(site.isNull() | url.isNull(), default)
        .when(url.contains(WECHAT_URL), "11")
        .when(abroad | site.between(90000, 99999), "7")
        .when(site.between(200000, 300065), "1")
        .when(site > 300065, "5")
        .when(site.between(60000, 69999), "2")
        .when(news & url.contains("blog"), "3")
        .when(news, "1")
        .otherwise(default)
    )


def site_group_intended(site: Column, url: Column, language: Column) -> Column:
    """Group id with the single-site rules in force; null when the id is no number.

    `language` is the looked-up language of the site ('' or null: not from abroad).
    """
    client_app = site.between(200623, 200627) | site.between(200629, 200635)
    return (
        F.when(site.isNull(), None)
        .when(site.between(1, 59999), F.when(url.contains("blog"), "3").otherwise("1"))
        .when(url.contains(WECHAT_URL), "11")
        .when(site.between(60000, 69999), "2")
        .when(site.between(70000, 89999) | site.between(100000, 199999), "1")
        .when(site.isin(200611, 200621, 200622, 200628), "3")
        .when(site == 200620, "14")
        .when(client_app, "13")
        .when(site.between(300001, 300065), "1")
        .when(site >= 200000, "5")
        .when(F.coalesce(language, F.lit("")) != "", "7")
        .otherwise("1")
    )
