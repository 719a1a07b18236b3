"""Routing rules: each gives the target table of a record, or null for none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlflow.functions.groups import whole_number


def by_group(group_id: Column) -> Column:
    """Blog, paper or question table; null for every other group."""
    return (
        F.when(group_id == "3", "blog").when(group_id == "5", "paper").when(group_id == "14", "ask-answer")
    )


def home_or_other(group_id: Column) -> Column:
    """Home page table for group 0, the other table for everything else, null included."""
    return F.when(F.coalesce(group_id, F.lit("")) == "0", "homepage_hct").otherwise("yixing")


def is_home_page(group_id: Column, site: Column) -> Column:
    """Home pages: a range of site numbers outside group 7. Never null."""
    in_range = F.coalesce(site.between(300001, 300065), F.lit(False))
    return in_range & (F.coalesce(group_id, F.lit("")) != "7")


def page_table(group_id: Column, site: Column) -> Column:
    """Home pages apart; the rest is the plain negation, so no row is compared with another."""
    return F.when(is_home_page(group_id, site), "homepage").otherwise("webpage")


def index_of(group_id: Column, site: Column) -> Column:
    """Index of a website document; null for groups without one.

    Documents without a site number stay out unless they belong to group 7.
    """
    group = whole_number(group_id)
    return (
        F.when(group.isNull(), None)
        .when(is_home_page(group_id, site), "souye/sy")
        .when(group == 7, "weiwap/test")
        .when((group != 11) & site.isNotNull(), "zong/tests")
    )


def is_valid_at(start: Column, end: Column, now: Column) -> Column:
    return (start < now) & (end > now)
