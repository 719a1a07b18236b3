# -*- coding: utf-8 -*-
"""SQL of the registered queries, written for an engine that is not Spark."""

from __future__ import annotations

from crawlflow import fixed_values as fixed
from crawlflow.catalog.hash_sql import xxh64_ctes
from crawlflow.catalog.messages import FIELDS

INGEST_MS = "1706776215000"
INGEST_TEXT = "2024-02-01 08:30:15"


# Shared expressions -------------------------------------------------------------
def _host(url: str) -> str:
    return f"lower(regexp_extract({url}, '^(?:https?|ftp)://(?:[^/?#@]*@)?([^/?#:]*)', 1))"


def _domain(url: str, labels: int, endings: str = fixed.DOMAIN_ENDINGS) -> str:
    found = f"regexp_extract({_host(url)}, '(\\w*\\.?){{{labels}}}\\.({endings})$', 0)"
    return (
        f"CASE WHEN {url} IS NULL OR NOT regexp_matches({url}, '^(https?|ftp)://') "
        f"THEN '{fixed.DOMAIN_BAD_URL}' WHEN {found} = '' THEN '{fixed.DOMAIN_NOT_FOUND}' "
        f"ELSE {found} END"
    )


def _number(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '^[+-]?[0-9]+$') THEN TRY_CAST({text} AS INTEGER) END"


def _group(site: str, url: str, default: str) -> str:
    s = f"({_number(site)})"
    return f"""CASE
      WHEN {s} IS NULL OR {url} IS NULL THEN '{default}'
      WHEN contains({url}, 'http://mp.weixin.qq.com') THEN '11'
      WHEN {s} BETWEEN -90293 AND -90000 OR {s} BETWEEN -90360 AND -90334
        OR {s} BETWEEN -90400 AND -90370 OR {s} BETWEEN -90368 AND -90361 THEN '7'
      WHEN {s} >= 200000 THEN CASE WHEN {s} <= 300065 THEN '1' ELSE '5' END
      WHEN {s} BETWEEN 90000 AND 99999 THEN '7'
      WHEN {s} BETWEEN 60000 AND 69999 THEN '2'
      WHEN {s} >= 1 THEN CASE WHEN contains({url}, 'blog') THEN '3' ELSE '1' END
      ELSE '{default}' END"""


def _group_intended(site: str, url: str, language: str) -> str:
    s = f"({_number(site)})"
    return f"""CASE
      WHEN {s} IS NULL THEN NULL
      WHEN {s} BETWEEN 1 AND 59999 THEN CASE WHEN contains({url}, 'blog') THEN '3' ELSE '1' END
      WHEN contains({url}, 'http://mp.weixin.qq.com') THEN '11'
      WHEN {s} BETWEEN 60000 AND 69999 THEN '2'
      WHEN {s} BETWEEN 70000 AND 89999 OR {s} BETWEEN 100000 AND 199999 THEN '1'
      WHEN {s} IN (200611, 200621, 200622, 200628) THEN '3'
      WHEN {s} = 200620 THEN '14'
      WHEN {s} BETWEEN 200623 AND 200635 THEN '13'
      WHEN {s} BETWEEN 300001 AND 300065 THEN '1'
      WHEN {s} >= 200000 THEN '5'
      WHEN coalesce({language}, '') <> '' THEN '7'
      ELSE '1' END"""


def _rolled(text: str, pattern: str, hour: str = "{h}") -> str:
    def part(i: int) -> str:
        return f"TRY_CAST(regexp_extract({text}, '{pattern}', {i}) AS BIGINT)"

    hours = hour.replace("{h}", part(4))
    return (
        f"CASE WHEN regexp_matches({text}, '{pattern}') THEN epoch_ms("
        f"make_timestamp(coalesce({part(1)}, 1970), 1, 1, 0, 0, 0) "
        f"+ to_months(CAST({part(2)} - 1 AS INTEGER)) + to_days(CAST({part(3)} - 1 AS INTEGER)) "
        f"+ to_hours({hours}) + to_minutes({part(5)}) + to_seconds({part(6)})) END"
    )


_DASHED = r"^(\d+)-(\d+)-(\d+) (\d+):(\d+):(\d+)"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{1,2})"


def _dashed_ms(text: str) -> str:
    return _rolled(text, _DASHED)


def _dual_ms(text: str) -> str:
    return f"CASE WHEN length({text}) <= 14 THEN {_rolled(text, _COMPACT)} ELSE {_rolled(text, _DASHED)} END"


def _text_or(ms: str, fallback: str) -> str:
    return f"coalesce(CAST({ms} AS VARCHAR), {fallback})"


def _lookup(key: str, entries: dict[str, str], default: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in entries.items())
    return f"CASE {key} {cases} ELSE '{default}' END"


def _blank(text: str) -> str:
    return f"(trim({text}, chr(32) || chr(9) || chr(10) || chr(13)) = '')"


# Messages, one per page: the rules of catalog.messages in SQL. A field that the
# message does not have is null here.
MESSAGES = f"""
base AS (
  SELECT page_id AS p, CAST(page_id AS VARCHAR) AS t, html, page_id % 50 AS c,
    CASE WHEN page_id % 25 = 7 THEN 'http://mp.weixin.qq.com/s/' || page_id ELSE url END AS u
  FROM pages),
times AS (
  SELECT *, '2016-11-' || lpad(CAST(p % 28 + 1 AS VARCHAR), 2, '0') AS day1,
    '2016-11-' || lpad(CAST((p + 2) % 28 + 1 AS VARCHAR), 2, '0') AS day2,
    lpad(CAST(p % 60 AS VARCHAR), 2, '0') AS min1, lpad(CAST((p + 2) % 60 AS VARCHAR), 2, '0') AS min2
  FROM base),
sent AS (
  SELECT p, t, c, c IN (11, 12) AS unreadable, (p % 8 = 3 OR c = 17) AS has_null,
    ['5','60001','70001','90001','100001','200620','300001','300065','300066','-90100','-5','x'][1 + p % 12] AS site_id,
    ['crawl-' || t, '-' || t, t, 'a-b-' || t, 'a-'][1 + p % 5] AS id,
    'T' || t AS title, html AS content, html AS snapshot,
    CAST(p % 23 AS VARCHAR) AS sengine, CAST(p % 7 AS VARCHAR) AS stype,
    CASE WHEN p % 2 = 0 THEN '' ELSE 'site' END AS site_name,
    'http://site.example' AS site_url, '2016-11-24 11:57:02' AS inserttime,
    CASE WHEN c = 16 THEN NULL ELSE u END AS url,
    CASE WHEN c = 14 THEN NULL WHEN c IN (15, 17) THEN ''
      ELSE CAST((CASE WHEN p % 10 = 9 THEN p - 1 ELSE p END) * 7919 - 100000 AS VARCHAR) END AS urlhash,
    [NULL, '', '0', '3', '5', '7', '14'][1 + p % 7] AS group_id,
    [day1 || ' 11:' || min1 || ':02', replace(day1, '-', '') || '115702', '2016-13-45 25:61:61',
     day1 || ' 11:' || min1 || ':02.9', 'soon', NULL][1 + p % 6] AS gathertime,
    [day2 || ' 11:' || min2 || ':02', replace(day2, '-', '') || '115702', '2016-13-45 25:61:61',
     day2 || ' 11:' || min2 || ':02.9', 'soon', NULL][1 + (p + 2) % 6] AS publishtime_or_null,
    CASE WHEN p % 8 = 3 THEN '' WHEN p % 8 = 4 THEN '12' END AS click,
    CASE WHEN p % 8 = 5 THEN '' END AS reply,
    CASE WHEN p % 8 = 6 THEN ' ' || chr(9) || ' ' WHEN p % 8 = 7 THEN 'writer' END AS author,
    CASE WHEN p % 4 = 1 THEN '2016-11-25 00:00:00' END AS insertime,
    CASE WHEN p % 4 = 2 THEN '1' END AS tendency_spaced,
    CASE WHEN p % 3 = 0 THEN '0' END AS tendency,
    CASE WHEN p % 9 = 0 THEN 'e' || t END AS x_extra
  FROM times),
msg AS (SELECT *, coalesce(publishtime_or_null, '') AS publishtime, gathertime AS publishdate FROM sent)
"""

MESSAGE_FIELDS = {
    name: name
    for name in (
        "site_id id title content snapshot sengine stype publishtime site_name site_url inserttime "
        "url urlhash group_id gathertime publishdate click reply author insertime tendency x_extra"
    ).split()
} | {"tendency ": "tendency_spaced"}


URL_HASHES = xxh64_ctes("SELECT url AS s FROM msg")


def cells_sql(
    key: str,
    target: str,
    where: str = "TRUE",
    pad: tuple[str, ...] = (),
    pad_when: str = "TRUE",
    derived: dict[str, str] | None = None,
    apart: bool = False,
    family: str | None = None,
    blanks: tuple[str, ...] = (),
    drop: tuple[str, ...] = (),
    only: tuple[str, ...] | None = None,
    latest: bool = False,
    hashed: bool = False,
) -> str:
    """Cells of the page messages, from the rules of one job given as SQL.

    With `hashed`, the rules may use `hash`, the hash of the URL.
    """
    hashes = f", {URL_HASHES}" if hashed else ""
    source = "(SELECT * FROM msg LEFT JOIN hashed ON s = url)" if hashed else "msg"
    derived = derived or {}
    names = only or [n for n in dict.fromkeys([*MESSAGE_FIELDS, *pad, *derived]) if n not in drop]
    columns = []
    for i, name in enumerate(names):
        sent = MESSAGE_FIELDS.get(name, "CAST(NULL AS VARCHAR)")
        value = derived.get(name, sent)
        if name in blanks:
            value = f"CASE WHEN {_blank(value)} THEN '' ELSE {value} END"
        if name in pad and name not in derived:
            value = f"CASE WHEN {pad_when} THEN coalesce({value}, '') ELSE {value} END"
        columns.append(f'CAST({value} AS VARCHAR) AS "{i}_{name}"')
    families = family or ("CASE WHEN name = 'snapshot' THEN 'c2' ELSE 'c1' END" if apart else "'c1'")
    listed = ", ".join(f'"{i}_{n}"' for i, n in enumerate(names))
    return f"""WITH RECURSIVE {MESSAGES}{hashes},
    keyed AS (SELECT *, {key} AS k, {target} AS tgt FROM {source} WHERE NOT unreadable),
    wide AS (SELECT p, k, tgt, {", ".join(columns)}
             FROM keyed WHERE ({where}) AND k IS NOT NULL AND tgt IS NOT NULL),
    long AS (SELECT p, k, tgt, regexp_replace(numbered, '^[0-9]+_', '') AS name, val
             FROM (FROM wide UNPIVOT (val FOR numbered IN ({listed}))))
    SELECT tgt AS target, k AS rowkey, {families} AS family, name AS qualifier,
      {"arg_max(val, p)" if latest else "val"} AS value FROM long {"GROUP BY 1, 2, 3, 4" if latest else ""}"""


NEW_KEY = "urlhash"
NEW_WHERE = "urlhash <> ''"
DOMAINS = {"domain_1": _domain("url", 1), "domain_2": _domain("url", 2)}
OLD_WHERE = "NOT has_null"
HASH_ID = "CASE WHEN p % 5 <= 1 THEN t ELSE id END"


def _suffixed(key: str, ms: str) -> str:
    return f"{key} || '_' || {ms}"


def ingest_sql() -> dict[str, str]:
    """SQL of every ingest job that has a plain-text row key."""
    now = f"'{INGEST_MS}'"
    dashed_now = _text_or(_dashed_ms("gathertime"), now)
    dual_now = _text_or(_dual_ms("gathertime"), now)
    all_fields = tuple(MESSAGE_FIELDS)
    paper = dict(
        pad=fixed.PAPER_FIELDS,
        derived={"group_id": f"coalesce(group_id, {_group('site_id', 'url', '5')})"},
        apart=True,
    )
    webpage = dict(
        pad=fixed.WEBPAGE_FIELDS,
        where="urlhash <> '' AND url IS NOT NULL",
        derived={"group_id": _group("site_id", "url", "1"), **DOMAINS},
    )
    home_group = f"CASE WHEN group_id <> '' THEN group_id ELSE {_group('site_id', 'url', '1')} END"
    in_home = f"({_number('site_id')}) BETWEEN 300001 AND 300065"
    metasearch = {
        **DOMAINS,
        "group_id": _lookup("stype", fixed.SEARCH_TYPE_GROUPS, "0"),
        "metasearch": _lookup("sengine", fixed.ENGINE_NAMES, ""),
        "urlhash": HASH_ID,
        "inserttime": f"'{INGEST_TEXT}'",
    }
    weibo = dict(pad=fixed.WEIBO_FIELDS, derived={"group_id": "'4'"}, apart=True, hashed=True)
    yixing = dict(
        pad=fixed.YIXING_FIELDS, derived={"tendency": "coalesce(tendency_spaced, tendency, '')"}, drop=("tendency ",)
    )
    mix_group = f"coalesce(group_id, {_group('site_id', 'url', '5')})"
    route_group = "CASE {g} WHEN '3' THEN 'blog' WHEN '5' THEN 'paper' WHEN '14' THEN 'ask-answer' END"
    binary = "CASE WHEN group_id = '0' THEN 'homepage_hct' ELSE 'yixing' END"
    weibouser_old = dict(
        pad=fixed.WEIBOUSER_FIELDS,
        where=OLD_WHERE,
        blanks=all_fields,
        derived={"inserttime": "coalesce(insertime, inserttime)"},
        drop=("insertime",),
    )
    jobs = {
        "forum": cells_sql(NEW_KEY, "'forum'", NEW_WHERE),
        "homepage_hct": cells_sql(NEW_KEY, "'homepage_hct'", NEW_WHERE),
        "metasearch": cells_sql(HASH_ID, "'metasearch'", pad=fixed.METASEARCH_FIELDS, derived=metasearch, apart=True),
        "newspaper": cells_sql(
            NEW_KEY,
            "'paper'",
            NEW_WHERE,
            pad=fixed.PAPER_FIELDS,
            derived={"group_id": _group("site_id", "url", "5")},
            apart=True,
        ),
        "replies_plain": cells_sql(NEW_KEY, "'replies'", NEW_WHERE),
        "webpage_home": cells_sql(
            NEW_KEY,
            f"CASE WHEN {in_home} AND ({home_group}) <> '7' THEN 'homepage' ELSE 'webpage' END",
            **{**webpage, "derived": {"group_id": home_group, **DOMAINS}},
        ),
        "snapshot": cells_sql(
            NEW_KEY,
            f"CASE WHEN {in_home} AND ({home_group}) <> '7' THEN 'homepage' ELSE 'webpage' END",
            **{**webpage, "derived": {"group_id": home_group, **DOMAINS}, "latest": True},
        ),
        "webpage": cells_sql(NEW_KEY, "'webpage'", **webpage),
        "weibo": cells_sql("CAST(hash AS VARCHAR)", "'weibo'", **weibo),
        "old_weibo": cells_sql(
            _suffixed("hash", dashed_now),
            "'weibo'",
            OLD_WHERE,
            pad=fixed.WEIBO_FIELDS,
            derived={"group_id": "'4'", "inserttime": "coalesce(insertime, inserttime)"},
            drop=("insertime",),
            apart=True,
            blanks=all_fields,
            hashed=True,
        ),
        "weibo_timed": cells_sql(_suffixed("hash", dual_now), "'weibo'", **weibo),
        "weibouser": cells_sql("id", "'weibouser'", pad=fixed.WEIBOUSER_FIELDS),
        "yixing": cells_sql(NEW_KEY, "'yixing'", NEW_WHERE, **yixing),
        "zhimei_ask-answer": cells_sql(NEW_KEY, "'ask-answer'", NEW_WHERE, **paper),
        "zhimei_blog": cells_sql(NEW_KEY, "'blog'", NEW_WHERE, **paper),
        "zhimei_mobileclient": cells_sql(NEW_KEY, "'mobileclient'", NEW_WHERE, **paper),
        "yixing_hct_mix": cells_sql(
            NEW_KEY, binary, NEW_WHERE, pad=fixed.YIXING_FIELDS, pad_when="coalesce(group_id, '') <> '0'"
        ),
        "zhimei_mix": cells_sql(NEW_KEY, route_group.format(g=mix_group), NEW_WHERE, **paper),
        "old_forum": cells_sql(
            _suffixed("urlhash", dashed_now),
            "'forum1'",
            f"{OLD_WHERE} AND urlhash <> ''",
            pad=fixed.FORUM_FIELDS,
        ),
        "old_metasearch": cells_sql(
            _suffixed(HASH_ID, f"CAST({_dashed_ms('gathertime')} AS VARCHAR)"),
            "'metasearch'",
            OLD_WHERE,
            pad=fixed.METASEARCH_PAD_FIELDS,
            derived={
                **metasearch,
                "domain_1": f"CASE WHEN url IS NOT NULL THEN {DOMAINS['domain_1']} END",
                "domain_2": f"CASE WHEN url IS NOT NULL THEN {DOMAINS['domain_2']} END",
            },
            blanks=all_fields,
        ),
        "old_webpage": cells_sql(
            _suffixed("urlhash", dual_now),
            "'webpage'",
            f"{OLD_WHERE} AND urlhash <> ''",
            pad=fixed.WEBPAGE_FIELDS,
            derived={
                "group_id": _group("site_id", "url", "1"),
                "domain_1": f"CASE WHEN url IS NOT NULL THEN {DOMAINS['domain_1']} END",
                "domain_2": f"CASE WHEN url IS NOT NULL THEN {DOMAINS['domain_2']} END",
            },
            blanks=tuple(n for n in all_fields if n not in ("site_id", "url")),
        ),
        "old_weibouser": cells_sql(_suffixed("id", dashed_now), "'weibouser'", **weibouser_old),
        "old_yixing": cells_sql(
            _suffixed("trim(urlhash)", f"CAST({_dashed_ms('gathertime')} AS VARCHAR)"),
            "'yixing'",
            f"{OLD_WHERE} AND urlhash <> ''",
            blanks=all_fields,
        ),
        "old_newspaper": cells_sql(_suffixed("urlhash", dashed_now), "'paper'", OLD_WHERE, **paper),
        "old_zhimei_ask-answer": cells_sql(_suffixed("urlhash", dashed_now), "'ask-answer'", OLD_WHERE, **paper),
        "old_zhimei_blog": cells_sql(_suffixed("urlhash", dashed_now), "'blog'", OLD_WHERE, **paper),
        "old_zhimei_mobileclient": cells_sql(
            _suffixed("urlhash", dashed_now), "'mobileclient'", OLD_WHERE, **paper
        ),
        "first_receiver": cells_sql(
            _suffixed("urlhash", f"CAST({_dashed_ms('publishdate')} AS VARCHAR)"),
            "'newspaper'",
            apart=True,
            blanks=all_fields,
        ),
        "first_direct": cells_sql(
            _suffixed("urlhash", now),
            "'newspaper3'",
            "urlhash <> '' AND url IS NOT NULL AND group_id IS NOT NULL AND gathertime IS NOT NULL",
            only=(*fixed.FIRST_JOB_FIELDS, "urlhash", "author"),
            derived={"author": f"CASE WHEN NOT {_blank('author')} THEN author END"},
            apart=True,
        ),
        "forum_timed": cells_sql(_suffixed("urlhash", dual_now), "'test'"),
        "homepage_hct_timed": cells_sql(_suffixed("urlhash", "inserttime"), "'homepage_hct'"),
        "metasearch_timed": cells_sql(
            _suffixed(HASH_ID, _text_or(_dashed_ms("gathertime"), "'0'")),
            "'metasearch'",
            "TRUE",
            pad=fixed.METASEARCH_FIELDS,
            derived=metasearch,
            apart=True,
        ),
        "newspaper_timed": cells_sql(
            _suffixed("urlhash", dashed_now),
            "'paper'",
            pad=fixed.PAPER_FIELDS,
            derived={"group_id": _group("site_id", "url", "5")},
            apart=True,
        ),
        "replies_plain_timed": cells_sql(
            _suffixed("urlhash", _text_or(_dual_ms("inserttime"), now)), "'replies'"
        ),
        "webpage_home_timed": cells_sql(
            _suffixed("urlhash", dual_now),
            f"CASE WHEN {in_home} AND ({_group('site_id', 'url', '1')}) <> '7' THEN 'homepage' ELSE 'webpage' END",
            **{**webpage, "where": "url IS NOT NULL"},
        ),
        "webpage_timed": cells_sql(
            _suffixed("urlhash", dual_now), "'webpage'", **{**webpage, "where": "url IS NOT NULL"}
        ),
        "weibouser_timed": cells_sql(
            _suffixed("id", dashed_now), "'weibouser'", pad=fixed.WEIBOUSER_FIELDS
        ),
        "yixing_timed": cells_sql(_suffixed("urlhash", dual_now), "'yixing'", **yixing),
        "yixing_hct_mix_timed": cells_sql(
            _suffixed("urlhash", f"CASE WHEN group_id = '0' THEN inserttime ELSE {dual_now} END"),
            binary,
            "group_id IS NOT NULL",
            pad=fixed.YIXING_FIELDS,
            pad_when="group_id <> '0'",
        ),
        "zhimei_mix_timed": cells_sql(
            _suffixed("urlhash", dashed_now), route_group.format(g=mix_group), **paper
        ),
        "zhimei_blog_timed": cells_sql(_suffixed("urlhash", dashed_now), "'blog'", **paper),
    }
    return jobs


# Event time texts: the rule of queries.event_times in SQL.
_EVENT_TIMES = """
ev AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS d, strftime(ts, '%Y%m%d%H%M%S') AS n FROM events),
timed AS (
  SELECT event_id, forms[1 + event_id % 12] AS txt, forms[1 + (event_id + 11) % 12] AS gather_txt FROM (
    SELECT event_id, [d, n, '2016-13-45 25:61:61', d || '.9', 'soon', NULL, substr(n, 1, 8), substr(n, 1, 12),
      substr(n, 1, 13), substr(d, 1, 16), '', 'NULL'] AS forms FROM ev))
"""


def _digits_to_dashed(t: str) -> str:
    date = f"substr({t},1,4) || '-' || substr({t},5,2) || '-' || substr({t},7,2)"
    minute = f"substr({t},9,2) || ':' || substr({t},11,2)"
    return f"""CASE length({t})
      WHEN 14 THEN {date} || ' ' || {minute} || ':' || substr({t},13,2)
      WHEN 13 THEN {date} || ' ' || {minute} || ':00'
      WHEN 12 THEN {date} || ' ' || {minute} || ':00'
      WHEN 8 THEN {date} || ' 00:00:00' END"""


def _normalised(t: str) -> str:
    return f"""CASE WHEN {t} IS NULL OR {t} IN ('', 'NULL') THEN '{fixed.EPOCH_TEXT}'
      WHEN contains({t}, '-') THEN
        CASE WHEN regexp_matches({t}, '{_DASHED}') THEN {t} ELSE '{fixed.EPOCH_TEXT}' END
      ELSE coalesce({_digits_to_dashed(t)}, '{fixed.EPOCH_TEXT}') END"""


_PUBLISH = fixed.PUBLISH_TIME_PATTERN


def _repaired(sent: str, gather: str, source: str, keep: str) -> str:
    """Query adding publishtime and publishtime_str to `source`, from two of its columns."""
    return f"""SELECT {keep},
        CASE WHEN good THEN first_text ELSE {gather} END AS publishtime,
        CASE WHEN good THEN first_raw ELSE first_text END AS publishtime_str
      FROM (SELECT *, regexp_matches(first_text, '{_PUBLISH}') AND NOT contains(first_text, '&quot;') AS good
        FROM (SELECT *,
          CASE WHEN unset THEN {gather} ELSE coalesce(candidate, {gather}) END AS first_text,
          CASE WHEN NOT unset AND candidate IS NULL THEN {sent} ELSE '' END AS first_raw
          FROM (SELECT *, {sent} IS NULL OR {sent} IN ('', 'NULL') AS unset,
            CASE WHEN contains({sent}, '-') THEN
              CASE WHEN length({sent}) = 16 AND contains({sent}, ' ') THEN {sent} || ':00'
                   WHEN regexp_matches({sent}, '{_PUBLISH}') THEN {sent} END
            ELSE {_digits_to_dashed(sent)} END AS candidate
            FROM {source})))"""


_SITES = f"""
sites AS (
  SELECT CASE WHEN n_nationkey % 12 IN (3, 7) THEN 'other-' || n_nationkey ELSE
    ['5','60001','70001','90001','100001','200620','300001','300065','300066','-90100','-5','x'][1 + n_nationkey % 12]
    END AS site_id, max(n_name) AS site_label
  FROM nation GROUP BY 1),
languages AS (
  SELECT ['90001','-90100','-5','5'][1 + r_regionkey % 4] AS site_id, max(r_name) AS lang FROM region GROUP BY 1)
"""

_REPLIES = """
replies AS (
  SELECT doc_id AS d, CAST(doc_id * 7919 - 100000 AS VARCHAR) AS urlhash,
    'http://bbs.example.com/' || doc_id AS url, doc_id % 40 <> 7 AS has_time,
    string_split(replace(text, chr(10), '|||'), '|||') AS parts
  FROM documents),
floors AS (SELECT d, urlhash, url, has_time, unnest(range(1, len(parts) + 1)) AS i, parts FROM replies),
floor_rows AS (SELECT d, urlhash, url, has_time, CAST(i + 1 AS INTEGER) AS floorid, parts[i] AS reply, i, parts FROM floors)
"""

_LOGS = f"""
logs AS (
  SELECT event_id AS e, user_id,
    CASE WHEN event_id % 11 = 0 THEN 'x' ELSE CAST(event_id AS VARCHAR) END AS vtime_text,
    CASE WHEN event_id % 7 = 0 THEN 'null' WHEN event_id % 7 = 1 THEN '' ELSE 'm' || user_id END AS muid,
    {list(fixed.LOG_PAGES)}[1 + event_id % 3] AS ucp,
    ['100000726;100000730;123456789;987654321', 'c', 'null', 'null', 'null'][1 + event_id % 5] AS category,
    CASE WHEN event_id % 4 = 0 THEN 9 ELSE 0 END AS auto_sid,
    CASE WHEN event_id % 2 = 0 THEN 'null' ELSE 'n1' END AS news_id,
    CASE WHEN event_id % 13 < 6 THEN 'd' || event_id ELSE 'null' END AS dealer_id,
    CASE WHEN event_id % 13 < 10 THEN 't' || event_id ELSE 'null' END AS tuan_id
  FROM events)"""

_LOG_TYPES = """CASE WHEN category <> 'null' THEN
        CASE WHEN ucp LIKE 'http://www.chexun.com/%' THEN
          CASE WHEN category LIKE '100000726;100000730;%' THEN 'nv' WHEN news_id <> 'null' THEN 'ns' ELSE 'ne' END END
      WHEN auto_sid <> 0 THEN 'as'
      WHEN dealer_id <> 'null' THEN 'di'
      WHEN tuan_id <> 'null' THEN 'ti' END"""

_LOG = f"""{_LOGS},
log_rows AS (
  SELECT CAST(vtime_text AS BIGINT) AS vtime, muid, CAST(user_id AS VARCHAR) AS uid,
    CASE WHEN category <> 'null' THEN
        CASE WHEN ucp LIKE 'http://www.ihaha.com/%' THEN '23456789.' END
      WHEN auto_sid <> 0 THEN CAST(auto_sid AS VARCHAR)
      WHEN dealer_id <> 'null' THEN dealer_id
      WHEN tuan_id <> 'null' THEN tuan_id END AS item,
    {_LOG_TYPES} AS types
  FROM logs WHERE vtime_text <> 'x' AND muid NOT IN ('null', ''))
"""

_LOG_REJECTS = f"""WITH {_LOGS}, judged AS (
  SELECT CASE WHEN muid IN ('null', '') THEN 'no_visitor' WHEN vtime_text = 'x' THEN 'bad_time' WHEN {_LOG_TYPES} IS NULL THEN 'no_type' END AS reason,
    array_to_string([CAST(user_id AS VARCHAR), muid, '-', ucp, '-', '-', '-', '-', '-', vtime_text, '-', '-', '-', '-', '-', '-', '-', '-',
      CAST(auto_sid AS VARCHAR), '-', '-', '-', '-', '-', '-', category, '-', '-', news_id, dealer_id, tuan_id], chr(9)) AS record
  FROM logs)"""

_REASONS = """
  CASE WHEN unreadable THEN 'unreadable' WHEN url IS NULL THEN 'no_url'
    WHEN urlhash IS NULL THEN 'no_key' WHEN urlhash = '' THEN 'blank_key' END"""


# Values of the message texts where they differ from what the jobs read out of them.
_SENT = {
    "urlhash": "CASE WHEN c NOT IN (14, 17) THEN urlhash END",
    "click": "CASE WHEN p % 8 = 4 THEN '12' END",
    "tendency ": "tendency_spaced",
}
#: The text of a page message: its fields in order, without those that have no value.
_JSON = (
    "array_to_string(list_filter(["
    + ", ".join(f"""CASE WHEN {_SENT.get(name, name)} IS NOT NULL THEN '"{name}":' || CAST(to_json({_SENT.get(name, name)}) AS VARCHAR) END""" for name in FIELDS)
    + "], lambda x: x IS NOT NULL), ',') || '}'"
)
_OPENING = """'{' || CASE WHEN p % 8 = 3 THEN '"click":null,' ELSE '' END || CASE WHEN c = 17 THEN '"urlhash":null,' ELSE '' END
    || CASE WHEN c = 13 THEN '"urlhash":"first",' ELSE '' END"""
_RECORD = f"""CASE c WHEN 11 THEN 'not json ' || t WHEN 12 THEN '[' || {_OPENING} || {_JSON} || ']' ELSE {_OPENING} || {_JSON} END"""


def _latest_events(where: str = "TRUE") -> str:
    return f"""SELECT CAST(user_id AS VARCHAR) AS rowkey, event_type AS qualifier,
      arg_max(CAST(CAST(value * 100 AS BIGINT) AS VARCHAR), event_id) AS value
      FROM events WHERE {where} GROUP BY 1, 2"""


def _website(place: str = "") -> str:
    """Documents of the page messages, with the message's number where `place` is its name and a comma."""
    def text(column: str) -> str:
        return f"CASE WHEN {column} IS NULL OR {column} IN ('', '(null)') THEN '' ELSE {column} END"

    def title(column: str) -> str:
        return f"CASE WHEN {column} IS NULL OR {column} IN ('', 'null', '(null)') THEN '0^A' ELSE {column} END"

    site = _number("m.site_id")
    ladder = _group_intended("m.site_id", text("m.url"), "lang")
    url = text("m.url")
    outer_site = f"(({site}) < 1 OR ({site}) BETWEEN 90000 AND 99999)"
    return f"""WITH {MESSAGES}, {_SITES},
    joined AS (
      SELECT m.p, m.site_id, m.site_url, '' AS summary, {text('m.urlhash')} AS urlhash, {text('m.click')} AS click,
        {text('m.reply')} AS reply, '' AS source, '' AS area, {text('m.author')} AS author,
        {text('m.tendency')} AS tendency, '' AS sim_id, {url} AS url,
        CASE WHEN m.site_name <> '' THEN m.site_name ELSE coalesce(s.site_label, '') END AS site_name,
        CASE WHEN {text('m.group_id')} = '' THEN {ladder} ELSE m.group_id END AS group_id,
        CASE WHEN {text('m.group_id')} = '' AND {outer_site} AND NOT contains({url}, 'http://mp.weixin.qq.com')
          THEN coalesce(l.lang, '') ELSE '' END AS language,
        {title('m.title')} AS title, {title('m.content')} AS content,
        {_normalised('m.gathertime')} AS gathertime, {_normalised('m.inserttime')} AS inserttime,
        m.publishtime AS sent_time, ({site}) AS site_number
      FROM msg m LEFT JOIN sites s ON m.site_id = s.site_id LEFT JOIN languages l ON m.site_id = l.site_id
      WHERE NOT m.unreadable),
    placed AS (
      SELECT *, {_domain('url', 1, fixed.DOMAIN_ENDINGS_ABROAD)} AS domain_1,
        {_domain('url', 2, fixed.DOMAIN_ENDINGS_ABROAD)} AS domain_2,
        CASE WHEN TRY_CAST(group_id AS INTEGER) IS NULL THEN NULL
          WHEN site_number BETWEEN 300001 AND 300065 AND group_id <> '7' THEN 'souye/sy'
          WHEN group_id = '7' THEN 'weiwap/test'
          WHEN group_id <> '11' AND site_number IS NOT NULL THEN 'zong/tests' END AS idx
      FROM joined),
    dressed AS (SELECT *, domain_1 AS agg_domain_1 FROM placed)
    {_repaired('sent_time', 'gathertime', 'dressed', place +
      'idx, site_id, site_url, summary, urlhash, click, reply, source, area, author, tendency, sim_id, url, '
      'site_name, group_id, title, content, language, agg_domain_1, domain_1, domain_2, gathertime, inserttime')}"""


_PERSON_LINES = """people AS (
  SELECT p_partkey % 10 AS c, p_partkey AS id, p_brand AS name, CAST(p_size AS VARCHAR) AS age, CASE p_partkey % 10
      WHEN 3 THEN '?,' || p_brand || ',' || p_size WHEN 4 THEN p_partkey || ',' || p_brand
      WHEN 5 THEN p_partkey || ',' || p_brand || ',x' WHEN 6 THEN CAST(p_partkey AS VARCHAR) END AS bad FROM part)"""


def _stored_sql(queries: dict[str, str]) -> dict[str, str]:
    """SQL of the queries over stored tables and restarted streams."""
    website = f"({_website('p, ')})"
    lost = "p >= (SELECT count(*) // 3 FROM pages) AND p < (SELECT 2 * count(*) // 3 FROM pages)"
    stored = f"SELECT * FROM {website} WHERE idx IS NOT NULL AND url <> ''"
    webpage_home = ingest_sql()["snapshot"].replace("WHERE NOT unreadable)", f"WHERE NOT unreadable AND NOT ({lost}))", 1)
    return {
        "access_log_inserted": queries["tsv_log_classify"],
        "access_log_rejects": f"{_LOG_REJECTS} SELECT reason, record FROM judged WHERE reason IS NOT NULL",
        "access_log_ledger": f"""{_LOG_REJECTS} SELECT 'load' AS run, CAST(0 AS BIGINT) AS batch_id, count(*) AS n_read,
            count(*) FILTER (reason IS NULL) AS n_good, count(reason) AS n_rejected FROM judged""",
        "line_rejects": "SELECT 'no_value' AS reason, user_id || ',c1' AS record FROM events WHERE event_id % 17 = 3",
        "person_stored": f"""WITH {_PERSON_LINES}, good AS (SELECT CAST(id AS VARCHAR) AS rowkey, name, age FROM people WHERE c NOT IN (3, 4, 5, 6))
            SELECT rowkey, 'cf' AS family, qualifier, value FROM (FROM good UNPIVOT (value FOR qualifier IN (name, age)))""",
        "person_rejects": f"""WITH {_PERSON_LINES} SELECT DISTINCT CASE c WHEN 3 THEN 'bad_id' WHEN 6 THEN 'no_name' ELSE 'bad_age' END AS errmsg,
            bad AS record, 'lines' AS topic FROM people WHERE c IN (3, 4, 5, 6)""",
        "rekey_stored": queries["rekey_projection"].replace("SELECT hash ||", "SELECT * EXCLUDE (p) FROM (SELECT p, hash ||", 1)
        + ") QUALIFY row_number() OVER (PARTITION BY rowkey ORDER BY CAST(p AS VARCHAR) DESC) = 1",
        "rekey_rejects": f"WITH {MESSAGES} SELECT 'no_url' AS errmsg, 'newspaper' AS topic, title FROM msg WHERE NOT unreadable AND url IS NULL",
        "website_stored": f"""SELECT idx, url, site_name, group_id, title, content, language, domain_1, gathertime, publishtime_str
            FROM ({stored})""",
        "website_rejects": f"""WITH {MESSAGES}, dead AS (
              SELECT p, 'unreadable' AS errmsg FROM msg WHERE unreadable
              UNION ALL SELECT p, CASE WHEN idx IS NULL THEN 'no_index' ELSE 'no_url' END FROM {website} WHERE idx IS NULL OR url = '')
            SELECT 'website/load/0/pages_' || ((p - CASE WHEN p % 10 = 9 THEN 1 ELSE 0 END) % 4) || '_' || p AS rowkey, errmsg,
              'website' AS topic FROM dead""",
        "expired_files_cells": webpage_home,
        "expired_files_gaps": """SELECT 'webpage' AS topic, 0 AS partition, count(*) // 3 AS first, 2 * count(*) // 3 - 1 AS last,
            2 * count(*) // 3 - count(*) // 3 AS messages FROM pages""",
        "topics_added": ingest_sql()["zhimei_mix"],
        "text_files_forum": ingest_sql()["forum"],
        "text_stream_forum": ingest_sql()["forum"],
        "field_list_weibouser": ingest_sql()["weibouser"],
        "capped_stream": ingest_sql()["forum"],
        "website_dimension_change": f"""SELECT idx, url, CASE WHEN p % 2 = 0 AND p >= (SELECT count(*) // 2 FROM pages) AND site_name <> ''
            THEN site_name || '-2' ELSE site_name END AS site_name FROM ({stored})""",
    }


def oracle_sql() -> dict[str, str]:
    """SQL per registered query."""
    site_groups = f"WITH {MESSAGES} SELECT p AS page_id, {{group}} AS group_id FROM msg"
    engine = _lookup("sengine", fixed.ENGINE_NAMES, "")
    by_type = _lookup("stype", fixed.SEARCH_TYPE_GROUPS, "0")
    in_home = f"({_number('site_id')}) BETWEEN 300001 AND 300065 AND coalesce(group_id, '') <> '7'"
    floor_cells = """SELECT urlhash || '_' || floorid AS rowkey, url || '#' || floorid AS url,
      floorid, urlhash, '2016-11-24 11:57:02' AS kafkatime, reply AS replycontent
      FROM floor_rows WHERE has_time AND reply <> ''"""
    wide = ", ".join(f'CAST({column} AS VARCHAR) AS "{name}"' for name, column in MESSAGE_FIELDS.items())
    listed = ", ".join(f'"{name}"' for name in MESSAGE_FIELDS)
    sent = f"""WITH {MESSAGES}, wide AS (SELECT p AS page_id, {wide} FROM msg WHERE NOT unreadable),
        sent_cells AS (SELECT page_id, qualifier, value FROM (FROM wide UNPIVOT (value FOR qualifier IN ({listed}))))"""
    queries = {
        "domain_extract": f"SELECT page_id, {_domain('url', 1)} AS domain_1, {_domain('url', 2)} AS domain_2 FROM pages",
        "domain_counts": f"SELECT {_domain('url', 1)} AS domain_1, count(*) AS pages FROM pages GROUP BY 1",
        "domain_abroad": f"""WITH hosts AS (SELECT page_id, replace(replace(url, 'example.com', 'site-' || page_id || '.co.uk'),
            'example.org', 'page.ru') AS url FROM pages)
            SELECT page_id, {_domain('url', 1, fixed.DOMAIN_ENDINGS_ABROAD)} AS abroad_1,
              {_domain('url', 1)} AS plain_1 FROM hosts""",
        "site_group": site_groups.format(group=_group("site_id", "url", "1")),
        "site_group_intended": site_groups.format(
            group=_group_intended("site_id", "url", "CASE WHEN p % 2 = 0 THEN 'ru' ELSE '' END")
        ),
        "id_rehash": f"""WITH {MESSAGES} SELECT p AS page_id, id,
            CASE WHEN len(string_split(rtrim(id, '-'), '-')) = 2
              THEN string_split(rtrim(id, '-'), '-')[2] ELSE id END AS urlhash FROM msg""",
        "time_dashed": f"WITH {_EVENT_TIMES} SELECT event_id, {_text_or(_dashed_ms('txt'), chr(39) + INGEST_MS + chr(39))} AS ms FROM timed",
        "time_dual": f"WITH {_EVENT_TIMES} SELECT event_id, {_text_or(_dual_ms('txt'), chr(39) + INGEST_MS + chr(39))} AS ms FROM timed",
        "time_zero_on_error": f"WITH {_EVENT_TIMES} SELECT event_id, {_text_or(_dashed_ms('txt'), chr(39) + '0' + chr(39))} AS ms FROM timed",
        "time_twelve_hour": f"""WITH {_EVENT_TIMES} SELECT event_id,
            {_rolled('txt', _DASHED, 'CASE WHEN {h} = 12 THEN 0 ELSE {h} END')} AS ms FROM timed""",
        "time_normalise": f"WITH {_EVENT_TIMES} SELECT event_id, {_normalised('txt')} AS normal FROM timed",
        "publish_repair": f"""WITH {_EVENT_TIMES}, gathered AS (
            SELECT event_id, txt, {_normalised('gather_txt')} AS gather FROM timed)
            {_repaired('txt', 'gather', 'gathered', 'event_id, gather')}""",
        "reverse_text": """SELECT doc_id, array_to_string(list_reverse(string_split(text, '')), '') AS reversed
            FROM documents""",
        "json_parse_events": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
        "null_to_empty": f"{sent} SELECT page_id, qualifier, value FROM sent_cells",
        "blank_to_empty": f"""{sent} SELECT page_id, qualifier, value AS sent,
            CASE WHEN {_blank('value')} THEN '' ELSE value END AS value FROM sent_cells""",
        "pad_fields": f"""WITH {MESSAGES}, wide AS (SELECT p, {", ".join(
            f"coalesce({MESSAGE_FIELDS.get(n, 'NULL')}, '') AS " + chr(34) + n + chr(34) for n in fixed.METASEARCH_PAD_FIELDS)}
            FROM msg WHERE NOT unreadable)
            SELECT p AS page_id, qualifier, value FROM (FROM wide UNPIVOT (value FOR qualifier IN ({", ".join(
            chr(34) + n + chr(34) for n in fixed.METASEARCH_PAD_FIELDS)})))""",
        "repair_keys": f"""WITH {MESSAGES} SELECT p AS page_id, coalesce(insertime, inserttime) AS inserttime,
            coalesce(tendency_spaced, tendency) AS tendency FROM msg WHERE NOT unreadable""",
        "const_group": f"WITH {MESSAGES} SELECT p AS page_id, '4' AS group_id FROM msg WHERE NOT unreadable AND url IS NOT NULL",
        "engine_lookup": f"WITH {MESSAGES} SELECT p AS page_id, sengine, {engine} AS metasearch FROM msg",
        "stype_lookup": f"WITH {MESSAGES} SELECT p AS page_id, stype, {by_type} AS group_id FROM msg",
        "site_name_lookup": f"""WITH {MESSAGES}, {_SITES} SELECT p AS page_id,
            CASE WHEN site_name <> '' THEN site_name ELSE coalesce(site_label, '') END AS site_name
            FROM msg LEFT JOIN sites USING (site_id)""",
        "language_lookup": f"""WITH {MESSAGES}, {_SITES} SELECT p AS page_id, lang AS language,
            CASE WHEN lang IS NULL THEN '1' ELSE '7' END AS group_id FROM msg LEFT JOIN languages USING (site_id)""",
        "route_group": f"""WITH {MESSAGES} SELECT coalesce(CASE group_id WHEN '3' THEN 'blog' WHEN '5' THEN 'paper'
            WHEN '14' THEN 'ask-answer' END, 'none') AS target, count(*) AS n FROM msg GROUP BY 1""",
        "route_binary": f"""WITH {MESSAGES} SELECT CASE WHEN group_id = '0' THEN 'homepage_hct' ELSE 'yixing' END AS target,
            count(*) AS n FROM msg GROUP BY 1""",
        "home_split": f"WITH {MESSAGES} SELECT p AS page_id, site_id FROM msg WHERE {in_home}",
        "home_complement": f"WITH {MESSAGES} SELECT p AS page_id, site_id FROM msg WHERE NOT coalesce({in_home}, FALSE)",
        "index_route": f"""WITH {MESSAGES} SELECT p AS page_id, CASE WHEN {_number('group_id')} IS NULL THEN NULL
            WHEN {in_home} THEN 'souye/sy' WHEN group_id = '7' THEN 'weiwap/test'
            WHEN ({_number('site_id')}) IS NOT NULL THEN 'zong/tests' END AS idx FROM msg""",
        "valid_interval_by_city": """WITH subs AS (SELECT o_orderkey AS sub_id, 'sp' || (o_custkey % 3) AS sp_id,
              CAST(o_custkey AS VARCHAR) AS location_id, CAST(o_orderkey % 31 AS VARCHAR) AS prov_id,
              (o_custkey % 5) || '|' || (o_orderkey % 7) || '|' AS city_code, o_custkey % 60 AS interv,
              o_orderkey % 2 AS available, epoch_ms(o_orderdate) AS start_time,
              epoch_ms(o_orderdate) + (o_custkey % 400) * 86400000 AS end_time,
              CAST(o_custkey % 360 AS DOUBLE) / 2 AS center_longitude,
              CAST(o_custkey % 180 AS DOUBLE) / 2 AS center_latitude, o_custkey % 5000 AS radius,
              o_orderpriority AS shape FROM orders),
            told AS (SELECT sub_id, concat_ws('/', sub_id, sp_id, location_id, prov_id, city_code, interv, available,
              start_time, end_time, center_longitude, center_latitude, radius, shape) AS subscription,
              CAST(('0x' || substr(md5(CAST(sub_id AS VARCHAR)), 1, 8))::BIGINT % 8 AS INTEGER) AS list_no,
              unnest(string_split(city_code, '|')) AS code
              FROM subs WHERE start_time < 852076800000 AND end_time > 852076800000)
            SELECT CAST(code AS INTEGER) AS city, list_no,
              CAST(row_number() OVER (PARTITION BY CAST(code AS INTEGER), list_no ORDER BY sub_id) AS INTEGER) AS list_pos,
              subscription FROM told WHERE code <> ''""",
        "upsert_latest_cells": _latest_events(),
        "table_snapshot": f"""SELECT rowkey, max(CASE WHEN qualifier = 'click' THEN value END) AS click,
            max(CASE WHEN qualifier = 'view' THEN value END) AS view,
            count(*) AS cells, string_agg(qualifier || '=' || value, ',' ORDER BY qualifier) AS cell_texts
            FROM ({_latest_events()}) GROUP BY 1""",
        "range_scan": f"SELECT rowkey, qualifier, value FROM ({_latest_events()}) WHERE rowkey >= '1' AND rowkey < '3' AND qualifier IN ('click', 'view')",
        "csv_cells": """SELECT CAST(user_id AS VARCHAR) AS rowkey, 'c1' AS family, event_type AS qualifier,
            CAST(event_id AS VARCHAR) AS value FROM events""",
        "csv_typed": """SELECT CASE WHEN p_partkey % 10 = 3 THEN NULL ELSE CAST(p_partkey AS INTEGER) END AS id,
            p_brand AS name, CAST(p_size AS INTEGER) AS age FROM part""",
        "tsv_log_classify": f"WITH {_LOG} SELECT * FROM log_rows WHERE types IS NOT NULL",
        "reply_explode": f"WITH {_REPLIES} {floor_cells}",
        "reply_explode_all": f"""WITH {_REPLIES}, lasts AS (SELECT d, max(i) AS last_i FROM floor_rows WHERE reply <> '' GROUP BY d)
            SELECT f.urlhash AS rowkey, f.url || '#' || f.floorid AS url, f.floorid, f.reply AS replycontent
            FROM floor_rows f LEFT JOIN lasts l ON f.d = l.d
            WHERE f.i <= coalesce(l.last_i, 0) OR (len(f.parts) = 1 AND f.parts[1] = '')""",
        "cells_explode": f"""{cells_sql('urlhash', "'weibo'", pad=fixed.WEIBO_FIELDS, where="urlhash <> ''", apart=True)}""",
        "url_hash64": f"""WITH RECURSIVE {xxh64_ctes("SELECT url AS s FROM pages")}
            SELECT page_id, hash FROM pages JOIN hashed ON s = url""",
        "rekey_projection": f"""WITH RECURSIVE {MESSAGES}, {URL_HASHES}
            SELECT hash || '_' || {_text_or(_dashed_ms('gathertime'), "'0'")} AS rowkey, CAST(hash AS VARCHAR) AS urlhash,
            content, coalesce(gathertime, '') AS gathertime, inserttime, site_id, site_name, site_url, title, url,
            coalesce(publishdate, publishtime) AS publishtime, {_group('site_id', 'url', '5')} AS group_id,
            snapshot, '' AS author, '' AS sim_id FROM msg JOIN hashed ON s = url WHERE NOT unreadable""",
        "dead_letters": f"""WITH {MESSAGES}, judged AS (SELECT p, {_REASONS} AS errmsg, {_RECORD} AS record FROM msg)
            SELECT 'webpage_' || ((p - CASE WHEN p % 10 = 9 THEN 1 ELSE 0 END) % 4) || '_' || p AS rowkey, errmsg, 'webpage' AS topic,
              '{INGEST_TEXT}' AS time, record FROM judged WHERE errmsg IS NOT NULL""",
        "dead_letter_summary": f"""WITH {MESSAGES}, judged AS (SELECT {_REASONS} AS errmsg FROM msg)
            SELECT errmsg, count(*) AS n FROM judged WHERE errmsg IS NOT NULL GROUP BY 1""",
        "website_documents": _website(),
        "website_index_counts": f"SELECT coalesce(idx, 'none') AS idx, count(*) AS n FROM ({_website()}) GROUP BY 1",
    }
    for name, sql in ingest_sql().items():
        queries[f"ingest_{name.replace('-', '_')}"] = sql
    queries["ingest_replies_all_parts"] = f"""WITH parts AS ({queries["reply_explode_all"]}),
        r AS (SELECT rowkey, url AS "url", CAST(floorid AS VARCHAR) AS "floorid", rowkey AS "urlhash",
          replycontent AS "replycontent" FROM parts)
        SELECT 'test' AS target, rowkey, 'c1' AS family, qualifier, value FROM
        (FROM r UNPIVOT (value FOR qualifier IN ("url", "floorid", "urlhash", "replycontent")))"""
    queries |= _stored_sql(queries)
    queries["ingest_two_runs"] = f"""SELECT target, rowkey, family, qualifier, value, 3 * count(*) AS writes,
        CAST(3 AS BIGINT) AS runs FROM ({queries["ingest_webpage_home"]}) GROUP BY ALL"""
    for name in ("stream_equals_batch", "stream_replay_idempotent"):
        queries[name] = queries["ingest_snapshot"]
    for name, time_name in (("ingest_replies", "kafkatime"), ("ingest_replies_timed", "inserttime")):
        queries[name] = f"""WITH {_REPLIES}, r AS (SELECT rowkey, url AS "url", CAST(floorid AS VARCHAR) AS "floorid", urlhash AS "urlhash",
            kafkatime AS "{time_name}", replycontent AS "replycontent" FROM ({floor_cells}))
            SELECT 'replies' AS target, rowkey, 'c1' AS family, qualifier, value FROM
            (FROM r UNPIVOT (value FOR qualifier IN ("url", "floorid", "urlhash", "{time_name}", "replycontent")))"""
    return queries
