"""Messages derived from the given tables, so that the jobs can be run on them.

One message per page: the page's URL and HTML plus fields that run through every
case the jobs know (missing, null, empty and blank values, misspelt names, all
site ranges, readable and unreadable times, broken messages). The rules use
page_id only, so `oracles.MESSAGES` can repeat them in SQL.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from crawlflow.session import configure

INGEST_TIME = datetime(2024, 2, 1, 8, 30, 15, tzinfo=timezone.utc)

SITE_IDS = tuple("5 60001 70001 90001 100001 200620 300001 300065 300066 -90100 -5 x".split())
_GATHER_FORMS = """element_at(array({day} || ' 11:' || {minute} || ':02', replace({day}, '-', '') || '115702',
    '2016-13-45 25:61:61', {day} || ' 11:' || {minute} || ':02.9', 'soon', null), cast({p} % 6 + 1 as int))"""


def _gather(p: str) -> str:
    """Time text of page `p`, in one of six forms; null for the last."""
    day = f"concat('2016-11-', lpad(cast({p} % 28 + 1 as string), 2, '0'))"
    minute = f"lpad(cast({p} % 60 as string), 2, '0')"
    return _GATHER_FORMS.format(day=day, minute=minute, p=f"({p})")


_P = "page_id"
_T = "cast(page_id as string)"
# Message fields as expressions over the pages; null where the message has no such field.
FIELDS = {
    "site_id": "element_at(array({}), cast(page_id % 12 + 1 as int))".format(
        ", ".join(f"'{site}'" for site in SITE_IDS)
    ),
    "id": f"element_at(array('crawl-' || {_T}, '-' || {_T}, {_T}, 'a-b-' || {_T}, 'a-'), cast(page_id % 5 + 1 as int))",
    "title": f"'T' || {_T}",
    "content": "html",
    "snapshot": "html",
    "sengine": "cast(page_id % 23 as string)",
    "stype": "cast(page_id % 7 as string)",
    "publishtime": f"coalesce({_gather('(page_id + 2)')}, '')",
    "site_name": "if(page_id % 2 = 0, '', 'site')",
    "site_url": "'http://site.example'",
    "inserttime": "'2016-11-24 11:57:02'",
    "url": f"""case when page_id % 50 = 16 then null
        when page_id % 25 = 7 then 'http://mp.weixin.qq.com/s/' || {_T} else url end""",
    "urlhash": """case when page_id % 50 in (14, 17) then null when page_id % 50 = 15 then ''
        else cast((page_id - if(page_id % 10 = 9, 1, 0)) * 7919 - 100000 as string) end""",
    "group_id": "element_at(array(null, '', '0', '3', '5', '7', '14'), cast(page_id % 7 + 1 as int))",
    "gathertime": _gather(_P),
    "publishdate": _gather(_P),
    "click": "if(page_id % 8 = 4, '12', null)",
    "reply": "if(page_id % 8 = 5, '', null)",
    "author": "case page_id % 8 when 6 then ' ' || char(9) || ' ' when 7 then 'writer' end",
    "insertime": "if(page_id % 4 = 1, '2016-11-25 00:00:00', null)",
    "tendency ": "if(page_id % 4 = 2, '1', null)",
    "tendency": "if(page_id % 3 = 0, '0', null)",
    "x_extra": f"if(page_id % 9 = 0, 'e' || {_T}, null)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def message_fields(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Fields of the page messages, before they become JSON."""
    columns = [f"{FIELDS[name]} as `{name}`" for name in names]
    return table(spark, sf_dir, "pages").selectExpr("page_id", *columns)


def page_messages(spark: SparkSession, sf_dir: str, topic: str = "pages") -> DataFrame:
    """One message per page, with the columns of a topic.

    Pages that share a hash share a partition, as topics keyed by hash do.
    """
    fields = ", ".join(f"'{name}', {sql}" for name, sql in FIELDS.items())
    # Fields without a value are left out of the text; two are sent as JSON null.
    sent = table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        f"to_json(named_struct({fields})) as json",
        """concat('{', if(page_id % 8 = 3, '"click":null,', ''), if(page_id % 50 = 17, '"urlhash":null,', ''),
          if(page_id % 50 = 13, '"urlhash":"first",', '')) as opening""",
    )
    return sent.selectExpr(
        "cast(null as string) as key",
        """case page_id % 50 when 11 then 'not json ' || page_id
          when 12 then concat('[', opening, substring(json, 2), ']')
          else concat(opening, substring(json, 2)) end as value""",
        f"'{topic}' as topic",
        "cast((page_id - if(page_id % 10 = 9, 1, 0)) % 4 as int) as partition",
        "page_id as offset",
        "cast(null as timestamp) as timestamp",
    )


def reply_messages(spark: SparkSession, sf_dir: str, topic: str = "replies") -> DataFrame:
    """One reply thread per document: its lines are the replies."""
    sent = """to_json(named_struct(
      'urlhash', cast(doc_id * 7919 - 100000 as string),
      'url', 'http://bbs.example.com/' || doc_id,
      'replycontent', replace(text, char(10), '|||'),
      'kafkatime', if(doc_id % 40 = 7, null, '2016-11-24 11:57:02'))) as value"""
    return table(spark, sf_dir, "documents").selectExpr(
        "cast(null as string) as key",
        sent,
        f"'{topic}' as topic",
        "cast(doc_id % 4 as int) as partition",
        "doc_id as offset",
        "cast(null as timestamp) as timestamp",
    )
