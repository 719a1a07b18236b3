"""The ingest jobs, as specs.

`rate` is messages per partition and second, `interval` the batch length in
seconds. Topic names take an optional prefix through `topic_names`.
"""

from __future__ import annotations

from crawlflow import fixed_values as fixed
from crawlflow.functions.domains import domain_of_host
from crawlflow.functions.groups import site_group
from crawlflow.functions.keys import url_hash_key
from crawlflow.functions.texts import rehash_id
from crawlflow.functions.times import dashed_millis, dual_millis, millis_text
from crawlflow.operators import routes
from crawlflow.operators.lookups import engine_name, search_type_group
from crawlflow.plans.spec import Derived, IngestSpec, Record, ReplySpec, Rule, Spec

from pyspark.sql import Column
from pyspark.sql import functions as F


# Keys -----------------------------------------------------------------------
def field_key(name: str) -> Rule:
    return lambda r: r.get(name)


def rehashed_id(r: Record) -> Column:
    return rehash_id(r.get("id"))


def hashed_url(r: Record) -> Column:
    return url_hash_key(r.get("url"))


# Times after the key ----------------------------------------------------------
def dashed_or_now(name: str = "gathertime") -> Rule:
    return lambda r: millis_text(dashed_millis(r.get(name), r.zone), r.ingest_ms)


def dual_or_now(name: str = "gathertime") -> Rule:
    return lambda r: millis_text(dual_millis(r.get(name), r.zone), r.ingest_ms)


def dashed_or_zero(name: str = "gathertime") -> Rule:
    return lambda r: millis_text(dashed_millis(r.get(name), r.zone), "0")


def dashed_or_drop(name: str) -> Rule:
    return lambda r: millis_text(dashed_millis(r.get(name), r.zone), None)


def raw_text(name: str) -> Rule:
    """The text itself; a missing field reads 'null', as stored before."""
    return lambda r: F.coalesce(r.get(name), F.lit("null"))


def ingest_time(r: Record) -> Column:
    return r.ingest_ms.cast("string")


# Derived fields -----------------------------------------------------------------
def group_of_site(default: str) -> Rule:
    return lambda r: site_group(r.number("site_id"), r.get("url"), default)


def group_if_blank(default: str) -> Rule:
    def rule(r: Record) -> Column:
        given = r.get("group_id")
        return F.when(given != "", given).otherwise(
            site_group(r.number("site_id"), r.get("url"), default)
        )

    return rule


def domain_1(r: Record) -> Column:
    return domain_of_host(r.host("url"), 1)


def domain_2(r: Record) -> Column:
    return domain_of_host(r.host("url"), 2)


def _missing(name: str) -> Rule:
    return lambda r: ~r.has(name)


def _present(name: str) -> Rule:
    return lambda r: r.has(name)


DOMAINS = (Derived("domain_1", domain_1), Derived("domain_2", domain_2))
DOMAINS_IF_URL = tuple(Derived(d.name, d.value, _present("url")) for d in DOMAINS)
GROUP_IF_MISSING = Derived("group_id", group_of_site("5"), _missing("group_id"))
WEIBO_GROUP = Derived("group_id", lambda r: F.lit("4"))
SEARCH_TYPE = Derived("group_id", lambda r: search_type_group(r.get("stype")))
SEARCH_ENGINE = Derived("metasearch", lambda r: engine_name(r.get("sengine")))
INSERT_TIME = Derived("inserttime", lambda r: r.ingest_time)
ID_AS_HASH = Derived("urlhash", rehashed_id)

URL_HASH = field_key("urlhash")


# Jobs -----------------------------------------------------------------------------
FORUM = IngestSpec("forum", ("forum",), "forum", URL_HASH, start="latest", rate=30, interval=60)

HOMEPAGE_HCT = IngestSpec(
    "homepage_hct", ("hct_homepage",), "homepage_hct", URL_HASH, start="latest", rate=30, interval=60
)

METASEARCH = IngestSpec(
    "metasearch",
    ("metasearch",),
    "metasearch",
    rehashed_id,
    fields=fixed.METASEARCH_FIELDS,
    derived=(*DOMAINS, SEARCH_TYPE, SEARCH_ENGINE, ID_AS_HASH, INSERT_TIME),
    snapshot="apart",
    rate=30,
    interval=61,
)

NEWSPAPER = IngestSpec(
    "newspaper",
    ("paper",),
    "paper",
    URL_HASH,
    fields=fixed.PAPER_FIELDS,
    derived=(Derived("group_id", group_of_site("5")),),
    snapshot="apart",
    start="latest",
    rate=30,
    interval=60,
)

REPLIES = ReplySpec("replies", ("replies",), "replies", start="latest", rate=30, interval=62)

REPLIES_PLAIN = IngestSpec("replies_plain", ("replies",), "replies", URL_HASH, start="latest", rate=30, interval=62)

WEBPAGE_HOME = IngestSpec(
    "webpage_home",
    ("webpage",),
    lambda r: routes.page_table(r.get("group_id"), r.number("site_id")),
    URL_HASH,
    fields=fixed.WEBPAGE_FIELDS,
    derived=(Derived("group_id", group_if_blank("1")), *DOMAINS),
    required=("url",),
    rate=30,
    interval=58,
)

WEBPAGE = IngestSpec(
    "webpage",
    ("webpage",),
    "webpage",
    URL_HASH,
    fields=fixed.WEBPAGE_FIELDS,
    derived=(Derived("group_id", group_of_site("1")), *DOMAINS),
    required=("url",),
    start="latest",
    rate=30,
    interval=60,
)

WEIBO = IngestSpec(
    "weibo",
    ("weibo",),
    "weibo",
    hashed_url,
    fields=fixed.WEIBO_FIELDS,
    derived=(WEIBO_GROUP,),
    snapshot="apart",
    rate=30,
    interval=59,
)

WEIBOUSER = IngestSpec(
    "weibouser",
    ("weibouser",),
    "weibouser",
    field_key("id"),
    fields=fixed.WEIBOUSER_FIELDS,
    start="latest",
    rate=30,
    interval=57,
)

YIXING = IngestSpec(
    "yixing",
    ("yixing",),
    "yixing",
    URL_HASH,
    fields=fixed.YIXING_FIELDS,
    repairs={"tendency ": "tendency"},
    rate=30,
    interval=60,
)


def zhimei(topic: str = "blog", table: str | None = None) -> IngestSpec:
    """Job template for one of the topics ask-answer, blog and mobileclient."""
    return IngestSpec(
        f"zhimei_{topic}",
        (topic,),
        table or topic,
        URL_HASH,
        fields=fixed.PAPER_FIELDS,
        derived=(GROUP_IF_MISSING,),
        snapshot="apart",
        rate=30,
        interval=65,
    )


YIXING_HCT_MIX = IngestSpec(
    "yixing_hct_mix",
    ("yixing", "hct_homepage"),
    lambda r: routes.home_or_other(r.get("group_id")),
    URL_HASH,
    fields=fixed.YIXING_FIELDS,
    pad_if=lambda r: F.coalesce(r.get("group_id"), F.lit("")) != "0",
    start="latest",
    rate=20,
    interval=66,
)

ZHIMEI_MIX = IngestSpec(
    "zhimei_mix",
    ("blog", "paper", "ask-answer"),
    lambda r: routes.by_group(r.get("group_id")),
    URL_HASH,
    fields=fixed.PAPER_FIELDS,
    derived=(GROUP_IF_MISSING,),
    snapshot="apart",
    start="latest",
    rate=20,
    interval=68,
)

# First generation of the jobs: a time follows the key, a JSON null is an error.
OLD_FORUM = IngestSpec(
    "old_forum",
    ("forum1",),
    "forum1",
    URL_HASH,
    key_time=dashed_or_now(),
    fields=fixed.FORUM_FIELDS,
    reject_nulls=True,
    max_message_bytes=20 * 1024 * 1024,
    rate=150,
    interval=6,
)

OLD_METASEARCH = IngestSpec(
    "old_metasearch",
    ("metasearch",),
    "metasearch",
    rehashed_id,
    key_time=dashed_or_drop("gathertime"),
    fields=fixed.METASEARCH_PAD_FIELDS,
    derived=(
        *DOMAINS_IF_URL,
        Derived(SEARCH_TYPE.name, SEARCH_TYPE.value, _present("stype")),
        Derived(SEARCH_ENGINE.name, SEARCH_ENGINE.value, _present("sengine")),
        ID_AS_HASH,
        INSERT_TIME,
    ),
    snapshot="apart_if_padded",
    blanks=True,
    reject_nulls=True,
    rate=200,
    interval=5,
)

OLD_WEBPAGE = IngestSpec(
    "old_webpage",
    ("webpage",),
    "webpage",
    URL_HASH,
    key_time=dual_or_now(),
    fields=fixed.WEBPAGE_FIELDS,
    derived=(Derived("group_id", group_of_site("1"), _present("site_id")), *DOMAINS_IF_URL),
    blanks=True,
    keep_blank=("site_id", "url"),
    reject_nulls=True,
    rate=150,
    interval=8,
)

OLD_WEIBO = IngestSpec(
    "old_weibo",
    ("weibo",),
    "weibo",
    hashed_url,
    key_time=dashed_or_now(),
    fields=fixed.WEIBO_FIELDS,
    derived=(WEIBO_GROUP,),
    repairs={"insertime": "inserttime"},
    snapshot="apart",
    blanks=True,
    reject_nulls=True,
    rate=200,
    interval=5,
)

OLD_WEIBOUSER = IngestSpec(
    "old_weibouser",
    ("weibouser",),
    "weibouser",
    field_key("id"),
    key_time=dashed_or_now(),
    fields=fixed.WEIBOUSER_FIELDS,
    repairs={"insertime": "inserttime"},
    blanks=True,
    reject_nulls=True,
    rate=200,
    interval=5,
)

OLD_YIXING = IngestSpec(
    "old_yixing",
    ("yixing",),
    "yixing",
    lambda r: F.trim(r.get("urlhash")),
    key_time=dashed_or_drop("gathertime"),
    blanks=True,
    reject_nulls=True,
    rate=200,
    interval=5,
)

OLD_NEWSPAPER = IngestSpec(
    "old_newspaper",
    ("paper",),
    "paper",
    URL_HASH,
    key_time=dashed_or_now(),
    fields=fixed.PAPER_FIELDS,
    derived=(GROUP_IF_MISSING,),
    snapshot="apart",
    reject_nulls=True,
    blank_key_ok=True,
    rate=150,
    interval=8,
)


def old_zhimei(topic: str = "blog", table: str | None = None) -> IngestSpec:
    """First generation of the three-topic template."""
    return OLD_NEWSPAPER.with_options(
        name=f"old_zhimei_{topic}", topics=(topic,), table=table or topic
    )


FIRST_RECEIVER = IngestSpec(
    "first_receiver",
    ("paper",),
    "newspaper",
    URL_HASH,
    key_time=dashed_or_drop("publishdate"),
    snapshot="apart",
    blanks=True,
    blank_key_ok=True,
    interval=5,
)

FIRST_DIRECT = IngestSpec(
    "first_direct",
    ("testnew",),
    "newspaper3",
    URL_HASH,
    key_time=ingest_time,
    only_fields=(*fixed.FIRST_JOB_FIELDS, "urlhash"),
    optional=fixed.FIRST_JOB_OPTIONAL_FIELDS,
    required=fixed.FIRST_JOB_FIELDS,
    required_values=True,
    snapshot="apart",
    interval=5,
)

# Debug variants: the same jobs with a time after the key.
FORUM_TIMED = FORUM.with_options(
    name="forum_timed", table="test", key_time=dual_or_now(), blank_key_ok=True, rate=5, interval=10
)
REPLIES_TIMED = ReplySpec(
    "replies_timed", ("replies",), "replies", stored_time="inserttime", rate=30, interval=62
)
REPLIES_ALL_PARTS = ReplySpec(
    "replies_all_parts", ("replies",), "test", time_field=None, keep_empty=True, floor_in_key=False
)


def _timed(spec: IngestSpec, key_time: Rule, **changes) -> IngestSpec:
    return spec.with_options(
        name=f"{spec.name}_timed", key_time=key_time, blank_key_ok=True, **changes
    )


TIMED = {
    spec.name: spec
    for spec in (
        FORUM_TIMED,
        _timed(HOMEPAGE_HCT, raw_text("inserttime")),
        METASEARCH.with_options(name="metasearch_timed", key_time=dashed_or_zero()),
        _timed(NEWSPAPER, dashed_or_now()),
        _timed(REPLIES_PLAIN, dual_or_now("inserttime")),
        _timed(
            WEBPAGE_HOME,
            dual_or_now(),
            derived=(Derived("group_id", group_of_site("1")), *DOMAINS),
        ),
        _timed(WEBPAGE, dual_or_now()),
        _timed(WEIBO, dual_or_now()),
        _timed(WEIBOUSER, dashed_or_now()),
        _timed(YIXING, dual_or_now()),
        _timed(
            YIXING_HCT_MIX,
            lambda r: F.when(r.get("group_id") == "0", raw_text("inserttime")(r)).otherwise(
                dual_or_now()(r)
            ),
            required=("group_id",),
        ),
        _timed(ZHIMEI_MIX, dashed_or_now()),
        _timed(zhimei(), dashed_or_now()),
        REPLIES_TIMED,
    )
}

JOBS: dict[str, Spec] = {
    spec.name: spec
    for spec in (
        FORUM,
        HOMEPAGE_HCT,
        METASEARCH,
        NEWSPAPER,
        REPLIES,
        REPLIES_PLAIN,
        WEBPAGE_HOME,
        WEBPAGE,
        WEIBO,
        WEIBOUSER,
        YIXING,
        zhimei("ask-answer"),
        zhimei("blog"),
        zhimei("mobileclient"),
        YIXING_HCT_MIX,
        ZHIMEI_MIX,
        OLD_FORUM,
        OLD_METASEARCH,
        OLD_WEBPAGE,
        OLD_WEIBO,
        OLD_WEIBOUSER,
        OLD_YIXING,
        OLD_NEWSPAPER,
        old_zhimei("ask-answer"),
        old_zhimei("blog"),
        old_zhimei("mobileclient"),
        FIRST_RECEIVER,
        FIRST_DIRECT,
        REPLIES_ALL_PARTS,
    )
} | TIMED


def topic_names(spec: Spec, prefix: str = "") -> list[str]:
    """Topics of a job, with the prefix a deployment puts before them."""
    return [prefix + topic for topic in spec.topics]
