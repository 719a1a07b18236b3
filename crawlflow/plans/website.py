"""Website documents to their indices: empty markers, lookups, time repair, routing."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlflow.fixed_values import DOMAIN_ENDINGS_ABROAD, WEBSITE_TEXT_FIELDS
from crawlflow.functions.domains import domain_of_host, host
from crawlflow.functions.groups import site_group_intended, whole_number
from crawlflow.functions.texts import is_blank, marked_title, marker_to_empty
from crawlflow.functions.times import normalise_time, with_repaired_publish_time
from crawlflow.operators.judged import REASON, RECORD, judged_cells, judged_columns
from crawlflow.operators.lookups import dimension_lookup, fill_from_dimension
from crawlflow.operators.records import held, text_map, with_records
from crawlflow.operators.routes import index_of
from crawlflow.sources.dimensions import VersionedDimension

DOCUMENT_FIELDS = (
    *WEBSITE_TEXT_FIELDS,
    "site_name",
    "group_id",
    "title",
    "content",
    "language",
    "agg_domain_1",
    "domain_1",
    "domain_2",
    "gathertime",
    "inserttime",
    "publishtime",
    "publishtime_str",
)


POSITION = ("partition", "offset", "topic")
_SENT_FIELDS = (
    *WEBSITE_TEXT_FIELDS,
    "site_name",
    "group_id",
    "language",
    "title",
    "content",
    "gathertime",
    "inserttime",
    "publishtime",
)


def judged_documents(messages: DataFrame, sites: DataFrame, languages: DataFrame) -> DataFrame:
    """A row per message: its document with its `index`, or why it is stored nowhere.

    `sites` has site_id and site_name, `languages` site_id and language. Rejected are messages that
    cannot be read, that no index takes, or whose URL, the document's id, is blank.
    """

    read = held(with_records(messages)).select(
        *POSITION,
        "value",
        F.col("fields").isNull().alias("_unreadable"),
        *[F.element_at("fields", F.lit(name)).alias(f"_{name}") for name in _SENT_FIELDS]
    )
    cleaned = read.select(
        *POSITION,
        "value",
        "_unreadable",
        *[marker_to_empty(F.col(f"_{name}")).alias(name) for name in WEBSITE_TEXT_FIELDS],
        marker_to_empty(F.col("_site_name")).alias("site_name"),
        marker_to_empty(F.col("_group_id")).alias("given_group"),
        marker_to_empty(F.col("_language")).alias("given_language"),
        marked_title(F.col("_title")).alias("title"),
        marked_title(F.col("_content")).alias("content"),
        normalise_time(F.col("_gathertime")).alias("gathertime"),
        normalise_time(F.col("_inserttime")).alias("inserttime"),
        F.col("_publishtime").alias("sent_publishtime"),
    )
    named = fill_from_dimension(held(cleaned), "site_name", "site_id", sites, "site_id", "site_name")
    spoken = dimension_lookup(named, "site_id", languages, "site_id", "language", "site_language")
    staged = spoken.withColumns({"_site": whole_number(F.col("site_id")), "_host": host(F.col("url"))})
    by_rule = (F.col("site_id") != "") & (F.col("given_group") == "")
    ladder = site_group_intended(F.col("_site"), F.col("url"), F.col("site_language"))
    outside = (F.col("_site") < 1) | F.col("_site").between(90000, 99999)
    from_lookup = by_rule & outside & ~F.col("url").contains("http://mp.weixin.qq.com")
    repaired = with_repaired_publish_time(staged, "sent_publishtime", "gathertime")
    documents = repaired.withColumns(
        {
            "group_id": F.when(by_rule, ladder).otherwise(F.col("given_group")),
            "language": F.when(from_lookup, F.coalesce("site_language", F.lit("")))
            .when((F.col("site_id") == "") & (F.col("given_group") != ""), F.col("given_language"))
            .otherwise(""),
            "domain_1": domain_of_host(F.col("_host"), 1, DOMAIN_ENDINGS_ABROAD),
            "domain_2": domain_of_host(F.col("_host"), 2, DOMAIN_ENDINGS_ABROAD),
        }
    ).withColumn("agg_domain_1", F.col("domain_1"))
    routed = documents.withColumn("index", index_of(F.col("group_id"), F.col("_site")))
    reason = (
        F.when(F.col("_unreadable"), "unreadable").when(F.col("index").isNull(), "no_index").when(is_blank(F.col("url")), "no_url")
    )
    return routed.select("index", *DOCUMENT_FIELDS, *POSITION, *judged_columns(reason, F.col("value")))


def website_documents(messages: DataFrame, sites: DataFrame, languages: DataFrame) -> DataFrame:
    """One document per readable message, with its `index` (null: no index takes it)."""
    documents = held(judged_documents(messages, sites, languages))
    return documents.where(~F.col(REASON).eqNullSafe("unreadable")).drop(REASON, RECORD)


def document_cells(judged: DataFrame, time: datetime) -> DataFrame:
    """Cells of the documents that have an index and a URL, which is the document id; dead letters of the others."""
    positions = {"partition": "src_partition", "offset": "src_offset", "topic": "src_topic"}
    rows = judged.withColumnsRenamed(positions).withColumn("rowkey", F.col("url"))
    fields = text_map({name: F.col(name) for name in DOCUMENT_FIELDS})
    return judged_cells(rows, F.col("index"), fields, F.lit("c1"), "website", time)


SITE_SCHEMA = "site_id string, site_name string"
LANGUAGE_SCHEMA = "site_id string, language string"


@dataclass(frozen=True)
class WebsiteSpec:
    """The website job, with its dimension tables; runs like any ingest spec.

    A dimension is a DataFrame, which stays as it is, or a versioned one: then each batch of a
    stream joins the version that was newest when it first ran.
    """

    sites: DataFrame | VersionedDimension
    languages: DataFrame | VersionedDimension
    name: str = "website"
    topics: tuple[str, ...] = ("outside",)
    rate: int = 10
    interval: int = 60
    start: str = "earliest"
    max_message_bytes: int = 10485760

    def cells(self, messages: DataFrame, ingest_time: datetime, zone: str | None = None) -> DataFrame:
        return document_cells(judged_documents(messages, self.sites, self.languages), ingest_time)

    def for_batch(self, run: str, batch_id: int) -> WebsiteSpec:
        """The spec with the dimensions' versions of a batch."""

        def rows(dimension: DataFrame | VersionedDimension) -> DataFrame:
            return dimension.of_batch(run, batch_id) if isinstance(dimension, VersionedDimension) else dimension

        return replace(self, sites=rows(self.sites), languages=rows(self.languages))
