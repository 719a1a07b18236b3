"""Registered queries: every operator and job, over the whole given tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlflow import fixed_values as fixed
from crawlflow.catalog.messages import (
    INGEST_TIME,
    SITE_IDS,
    message_fields,
    page_messages,
    reply_messages,
    table,
)
from crawlflow.functions.domains import domain_of_host, host
from crawlflow.functions.groups import site_group, site_group_intended, whole_number
from crawlflow.functions.hashing import xxh64
from crawlflow.functions.keys import row_key
from crawlflow.functions.texts import blank_to_empty, rehash_id, reverse_text
from crawlflow.functions.times import (
    dashed_millis,
    dual_millis,
    millis_text,
    normalise_time,
    with_repaired_publish_time,
)
from crawlflow.operators import routes
from crawlflow.operators.cells import (
    explode_fields,
    latest_cells,
    null_to_empty,
    rows_of,
    rows_with_columns,
)
from crawlflow.operators.lookups import (
    dimension_lookup,
    engine_name,
    fill_from_dimension,
    search_type_group,
)
from crawlflow.operators.records import field, padded, parse_fields, readable_records
from crawlflow.plans.access_log import access_records
from crawlflow.plans.registry import JOBS, REPLIES, REPLIES_ALL_PARTS, WEBPAGE, WEBPAGE_HOME, WEIBO
from crawlflow.plans.rekey import rekeyed_rows
from crawlflow.plans.subscriptions import city_entries, valid_by_city
from crawlflow.plans.website import website_documents
from crawlflow.session import checkpoint_root
from crawlflow.sources.keyed_store import DEAD_LETTERS, KeyedStore, epoch_ms
from crawlflow.sources.messages import stream_message_files
from crawlflow.sources.tables import csv_cells as csv_cell_columns
from crawlflow.sources.tables import csv_person
from crawlflow.streaming.runs import run_batch, run_stream

Query = Callable[[SparkSession, str], DataFrame]
ZONE = "UTC"


def page_records(spark: SparkSession, sf: str, repairs: dict[str, str] | None = None) -> DataFrame:
    """Parsed page messages: page_id and the field map; unreadable ones left out."""
    readable = readable_records(page_messages(spark, sf), repairs)
    return readable.select(F.col("offset").alias("page_id"), "fields")


# URLs, hashes, groups -----------------------------------------------------------------
def domain_extract(spark: SparkSession, sf: str) -> DataFrame:
    hosts = table(spark, sf, "pages").select("page_id", host(F.col("url")).alias("host"))
    return hosts.select(
        "page_id",
        domain_of_host(F.col("host"), 1).alias("domain_1"),
        domain_of_host(F.col("host"), 2).alias("domain_2"),
    )


def domain_counts(spark: SparkSession, sf: str) -> DataFrame:
    return domain_extract(spark, sf).groupBy("domain_1").agg(F.count(F.lit(1)).alias("pages"))


def domain_abroad(spark: SparkSession, sf: str) -> DataFrame:
    site = F.concat(F.lit("site-"), F.col("page_id").cast("string"), F.lit(".co.uk"))
    url = F.replace(F.replace("url", F.lit("example.com"), site), F.lit("example.org"), F.lit("page.ru"))
    hosts = table(spark, sf, "pages").select("page_id", host(url).alias("host"))
    return hosts.select(
        "page_id",
        domain_of_host(F.col("host"), 1, fixed.DOMAIN_ENDINGS_ABROAD).alias("abroad_1"),
        domain_of_host(F.col("host"), 1).alias("plain_1"),
    )


def url_hash64(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", xxh64(F.col("url")).alias("hash"))


def _sites(spark: SparkSession, sf: str) -> DataFrame:
    return message_fields(spark, sf, "site_id", "url", "group_id").withColumn(
        "site", whole_number(F.col("site_id"))
    )


def site_group_query(spark: SparkSession, sf: str) -> DataFrame:
    return _sites(spark, sf).select(
        "page_id", site_group(F.col("site"), F.col("url"), "1").alias("group_id")
    )


def site_group_intended_query(spark: SparkSession, sf: str) -> DataFrame:
    language = F.when(F.col("page_id") % 2 == 0, "ru").otherwise("")
    group = site_group_intended(F.col("site"), F.col("url"), language)
    return _sites(spark, sf).select("page_id", group.alias("group_id"))


def id_rehash(spark: SparkSession, sf: str) -> DataFrame:
    ids = message_fields(spark, sf, "id")
    return ids.select("page_id", "id", rehash_id(F.col("id")).alias("urlhash"))


# Times and texts ------------------------------------------------------------------------
def event_times(spark: SparkSession, sf: str) -> DataFrame:
    """Event times as texts in every form the jobs meet; `gather_txt` in another one than `txt`."""
    texts = table(spark, sf, "events").selectExpr(
        "event_id",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') as d",
        "date_format(ts, 'yyyyMMddHHmmss') as n",
    )
    forms = """element_at(array(d, n, '2016-13-45 25:61:61', d || '.9', 'soon', null, substring(n, 1, 8),
        substring(n, 1, 12), substring(n, 1, 13), substring(d, 1, 16), '', 'NULL'), cast({} % 12 + 1 as int))"""
    return texts.selectExpr(
        "event_id", f"{forms.format('event_id')} as txt", f"{forms.format('(event_id + 11)')} as gather_txt"
    )


def _now_ms() -> Column:
    return F.lit(epoch_ms(INGEST_TIME))


def time_dashed(spark: SparkSession, sf: str) -> DataFrame:
    ms = millis_text(dashed_millis(F.col("txt"), ZONE), _now_ms())
    return event_times(spark, sf).select("event_id", ms.alias("ms"))


def time_dual(spark: SparkSession, sf: str) -> DataFrame:
    ms = millis_text(dual_millis(F.col("txt"), ZONE), _now_ms())
    return event_times(spark, sf).select("event_id", ms.alias("ms"))


def time_zero_on_error(spark: SparkSession, sf: str) -> DataFrame:
    ms = millis_text(dashed_millis(F.col("txt"), ZONE), "0")
    return event_times(spark, sf).select("event_id", ms.alias("ms"))


def time_twelve_hour(spark: SparkSession, sf: str) -> DataFrame:
    ms = dashed_millis(F.col("txt"), ZONE, clock12=True)
    return event_times(spark, sf).select("event_id", ms.alias("ms"))


def time_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return event_times(spark, sf).select("event_id", normalise_time(F.col("txt")).alias("normal"))


def publish_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Publish times repaired with the gather time of the same event."""
    times = event_times(spark, sf).withColumn("gather", normalise_time(F.col("gather_txt")))
    repaired = with_repaired_publish_time(times, "txt", "gather")
    return repaired.select("event_id", "gather", "publishtime", "publishtime_str")


def reverse_text_query(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", reverse_text(F.col("text")).alias("reversed"))


# Records --------------------------------------------------------------------------------
def json_parse_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", parse_fields(F.col("props")).alias("m"))
    return events.select("event_id", field(F.col("m"), "k").alias("k"))


def null_to_empty_query(spark: SparkSession, sf: str) -> DataFrame:
    cells = explode_fields(page_records(spark, sf))
    return cells.select("page_id", "qualifier", null_to_empty(F.col("value")).alias("value"))


def blank_to_empty_query(spark: SparkSession, sf: str) -> DataFrame:
    cells = explode_fields(page_records(spark, sf)).withColumn("sent", null_to_empty(F.col("value")))
    return cells.select("page_id", "qualifier", "sent", blank_to_empty(F.col("sent")).alias("value"))


def pad_fields(spark: SparkSession, sf: str) -> DataFrame:
    filled = page_records(spark, sf).withColumn(
        "fields", padded(F.col("fields"), fixed.METASEARCH_PAD_FIELDS)
    )
    wanted = F.col("qualifier").isin(list(fixed.METASEARCH_PAD_FIELDS))
    return explode_fields(filled).where(wanted).select(
        "page_id", "qualifier", null_to_empty(F.col("value")).alias("value")
    )


def repair_keys(spark: SparkSession, sf: str) -> DataFrame:
    repaired = page_records(spark, sf, {"insertime": "inserttime", "tendency ": "tendency"})
    return repaired.select(
        "page_id",
        field(F.col("fields"), "inserttime").alias("inserttime"),
        field(F.col("fields"), "tendency").alias("tendency"),
    )


def const_group(spark: SparkSession, sf: str) -> DataFrame:
    cells = WEIBO.cells(page_messages(spark, sf), INGEST_TIME, ZONE)
    return cells.where((F.col("qualifier") == "group_id") & (F.col("table") == "weibo")).select(
        F.col("src_offset").alias("page_id"), F.col("value").alias("group_id")
    )


# Lookups and routes -----------------------------------------------------------------------
def engine_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return message_fields(spark, sf, "sengine").withColumn("metasearch", engine_name(F.col("sengine")))


def stype_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return message_fields(spark, sf, "stype").withColumn("group_id", search_type_group(F.col("stype")))


def site_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Names of sites, from the nation table; two of the messages' sites are not among them."""
    key = F.col("n_nationkey") % 12
    ids = F.array(*[F.lit(s) for s in SITE_IDS])
    other = F.concat(F.lit("other-"), F.col("n_nationkey").cast("string"))
    site_id = F.when(key.isin(3, 7), other).otherwise(F.get(ids, key.cast("int")))
    return table(spark, sf, "nation").select(site_id.alias("site_id"), F.col("n_name").alias("site_name"))


def language_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Languages of some sites, from the region table."""
    ids = F.array(F.lit("90001"), F.lit("-90100"), F.lit("-5"), F.lit("5"))
    key = (F.col("r_regionkey") % 4).cast("int")
    return table(spark, sf, "region").select(
        F.get(ids, key).alias("site_id"), F.col("r_name").alias("language")
    )


def site_name_lookup(spark: SparkSession, sf: str) -> DataFrame:
    pages = message_fields(spark, sf, "site_id", "site_name")
    named = fill_from_dimension(
        pages, "site_name", "site_id", site_dimension(spark, sf), "site_id", "site_name"
    )
    return named.select("page_id", "site_name")


def language_lookup(spark: SparkSession, sf: str) -> DataFrame:
    pages = message_fields(spark, sf, "site_id")
    spoken = dimension_lookup(
        pages, "site_id", language_dimension(spark, sf), "site_id", "language", "language"
    )
    group = F.when(F.col("language").isNull(), "1").otherwise("7")
    return spoken.select("page_id", "language", group.alias("group_id"))


def _route_counts(sites: DataFrame, route: Column) -> DataFrame:
    target = F.coalesce(route, F.lit("none")).alias("target")
    return sites.select(target).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


def route_group(spark: SparkSession, sf: str) -> DataFrame:
    return _route_counts(_sites(spark, sf), routes.by_group(F.col("group_id")))


def route_binary(spark: SparkSession, sf: str) -> DataFrame:
    return _route_counts(_sites(spark, sf), routes.home_or_other(F.col("group_id")))


def home_split(spark: SparkSession, sf: str) -> DataFrame:
    home = routes.is_home_page(F.col("group_id"), F.col("site"))
    return _sites(spark, sf).where(home).select("page_id", "site_id")


def home_complement(spark: SparkSession, sf: str) -> DataFrame:
    home = routes.is_home_page(F.col("group_id"), F.col("site"))
    return _sites(spark, sf).where(~home).select("page_id", "site_id")


def index_route(spark: SparkSession, sf: str) -> DataFrame:
    index = routes.index_of(F.col("group_id"), F.col("site"))
    return _sites(spark, sf).select("page_id", index.alias("idx"))


# Subscriptions, logs, lines -----------------------------------------------------------------
NOW_MS = 852076800000


def subscriptions(spark: SparkSession, sf: str) -> DataFrame:
    """Subscriptions made of the orders, with all fields of a subscription."""
    start = F.unix_millis(F.to_timestamp(F.concat(F.col("o_orderdate").cast("string"), F.lit("Z"))))
    dated = table(spark, sf, "orders").withColumn("start_time", start)
    return dated.selectExpr(
        "o_orderkey as sub_id",
        "'sp' || o_custkey % 3 as sp_id",
        "cast(o_custkey as string) as location_id",
        "cast(o_orderkey % 31 as string) as prov_id",
        "o_custkey % 5 || '|' || o_orderkey % 7 || '|' as city_code",
        "cast(o_custkey % 60 as int) as interv",
        "cast(o_orderkey % 2 as int) as available",
        "start_time",
        "start_time + o_custkey % 400 * 86400000 as end_time",
        "cast(o_custkey % 360 as double) / 2 as center_longitude",
        "cast(o_custkey % 180 as double) / 2 as center_latitude",
        "cast(o_custkey % 5000 as int) as radius",
        "o_orderpriority as shape",
    )


def valid_interval_by_city(spark: SparkSession, sf: str) -> DataFrame:
    """The entries of all cities, each subscription as the text of its fields."""
    entries = city_entries(valid_by_city(subscriptions(spark, sf), F.lit(NOW_MS)), buckets=8)
    told = F.concat_ws("/", *[F.col(name).cast("string") for name in fixed.SUBSCRIPTION_FIELDS])
    return entries.select("city", "list_no", "list_pos", told.alias("subscription"))


def tsv_log_classify(spark: SparkSession, sf: str) -> DataFrame:
    return access_records(access_lines(spark, sf))


def access_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Tab-separated access-log lines made of the events."""
    at = {
        0: "cast(user_id as string)",
        1: "case event_id % 7 when 0 then 'null' when 1 then '' else 'm' || user_id end",
        3: f"element_at(array({', '.join(repr(url) for url in fixed.LOG_PAGES)}), cast(event_id % 3 + 1 as int))",
        9: "if(event_id % 11 = 0, 'x', cast(event_id as string))",
        18: "if(event_id % 4 = 0, '9', '0')",
        25: "case event_id % 5 when 0 then '100000726;100000730;123456789;987654321' when 1 then 'c' else 'null' end",
        28: "if(event_id % 2 = 0, 'null', 'n1')",
        29: "if(event_id % 13 < 6, 'd' || event_id, 'null')",
        30: "if(event_id % 13 < 10, 't' || event_id, 'null')",
    }
    columns = ", ".join(at.get(i, "'-'") for i in range(31))
    return table(spark, sf, "events").selectExpr(f"concat_ws(char(9), {columns}) as value")


def csv_cells(spark: SparkSession, sf: str) -> DataFrame:
    line = F.concat_ws(",", F.col("user_id").cast("string"), F.lit("c1"), "event_type", F.col("event_id").cast("string"))
    lines = table(spark, sf, "events").select(line.alias("value"))
    return lines.select(*csv_cell_columns(F.col("value"), "events")).drop("table")


def csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    bad = F.when(F.col("p_partkey") % 10 == 3, "?").otherwise(F.col("p_partkey").cast("string"))
    line = F.concat_ws(",", bad, "p_brand", F.col("p_size").cast("string"))
    return table(spark, sf, "part").select(line.alias("value")).select(*csv_person(F.col("value")))


# Cells and stored tables ----------------------------------------------------------------------
def event_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Events as writes: user is the row, event type the column, event id the order."""
    cents = F.round(F.col("value") * 100).cast("long").cast("string")
    return table(spark, sf, "events").select(
        F.lit("users").alias("table"),
        F.col("user_id").cast("string").alias("rowkey"),
        F.lit("c1").alias("family"),
        F.col("event_type").alias("qualifier"),
        cents.alias("value"),
        F.lit(0).alias("src_partition"),
        F.col("event_id").alias("src_offset"),
    )


def upsert_latest_cells(spark: SparkSession, sf: str) -> DataFrame:
    return latest_cells(event_cells(spark, sf)).select("rowkey", "qualifier", "value")


def table_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    rows = rows_of(latest_cells(event_cells(spark, sf)))
    texts = F.transform(F.map_entries("c1"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.select(
        "rowkey",
        F.element_at("c1", F.lit("click")).alias("click"),
        F.element_at("c1", F.lit("view")).alias("view"),
        F.size("c1").cast("long").alias("cells"),
        F.array_join(texts, ",").alias("cell_texts"),
    )


def range_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Row-key range and two columns, read back from a stored table."""
    store = KeyedStore(spark, scratch(spark, "range"))
    store.append(event_cells(spark, sf), "users", 0, epoch_ms(INGEST_TIME), run="load")
    found = store.latest("users", columns=["click", "view"], families=["c1"], start="1", stop="3")
    return found.select("rowkey", "qualifier", "value")


def cells_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Padded records as cells in two families, keyed by the sent hash."""
    spec = WEIBO.with_options(key=lambda r: r.get("urlhash"), derived=())
    return good_cells(spec.cells(page_messages(spark, sf), INGEST_TIME, ZONE))


def rekey_projection(spark: SparkSession, sf: str) -> DataFrame:
    names = (*fixed.REKEY_FIELDS, "publishdate", "publishtime", fixed.SNAPSHOT)
    rows = page_records(spark, sf).select(
        *[F.element_at("fields", F.lit(name)).alias(name) for name in names]
    )
    return rekeyed_rows(rows, zone=ZONE)


def reply_explode(spark: SparkSession, sf: str) -> DataFrame:
    rows = REPLIES.replies(reply_messages(spark, sf), INGEST_TIME, ZONE)
    return rows.where(F.col("_reason").isNull()).select(
        row_key(F.col("urlhash"), F.col("floorid")).alias("rowkey"),
        F.concat("url", F.lit("#"), F.col("floorid").cast("string")).alias("url"),
        "floorid",
        "urlhash",
        F.col("_seen").alias("kafkatime"),
        "replycontent",
    )


def reply_explode_all(spark: SparkSession, sf: str) -> DataFrame:
    rows = REPLIES_ALL_PARTS.replies(reply_messages(spark, sf), INGEST_TIME, ZONE)
    return rows.where(F.col("_reason").isNull()).select(
        F.col("urlhash").alias("rowkey"),
        F.concat("url", F.lit("#"), F.col("floorid").cast("string")).alias("url"),
        "floorid",
        "replycontent",
    )


# Jobs ---------------------------------------------------------------------------------------------
def good_cells(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("table") != DEAD_LETTERS).select(
        F.col("table").alias("target"), "rowkey", "family", "qualifier", "value"
    )


def ingest(name: str) -> Query:
    spec = JOBS[name]
    messages = reply_messages if name.startswith("replies") and "plain" not in name else page_messages

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return good_cells(spec.cells(messages(spark, sf), INGEST_TIME, ZONE))

    return run


def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters with the text of their record."""
    cells = WEBPAGE.cells(page_messages(spark, sf, "webpage"), INGEST_TIME, ZONE)
    dead = cells.where(F.col("table") == DEAD_LETTERS)
    return rows_with_columns(dead, ["errmsg", "topic", "time", "record"]).drop("table")


def dead_letter_summary(spark: SparkSession, sf: str) -> DataFrame:
    reasons = WEBPAGE.reject_reasons(page_messages(spark, sf), INGEST_TIME, ZONE)
    return reasons.groupBy(F.col("reason").alias("errmsg")).agg(F.count(F.lit(1)).alias("n"))


def website_documents_query(spark: SparkSession, sf: str) -> DataFrame:
    documents = website_documents(
        page_messages(spark, sf), site_dimension(spark, sf), language_dimension(spark, sf)
    )
    return documents.withColumnRenamed("index", "idx").drop("partition", "offset", "topic")


def website_index_counts(spark: SparkSession, sf: str) -> DataFrame:
    index = F.coalesce("idx", F.lit("none")).alias("idx")
    return website_documents_query(spark, sf).groupBy(index).agg(F.count(F.lit(1)).alias("n"))


# Streams --------------------------------------------------------------------------------------------
def scratch(spark: SparkSession, name: str) -> str:
    """New folder: in the cluster's checkpoint folder, or in local mode a temporary one where none is set."""
    local = spark.sparkContext.master.startswith("local[")
    root = checkpoint_root(spark, tempfile.gettempdir() if local else None)
    return f"{root}/crawlflow-{name}-{uuid.uuid4().hex}"


def _streamed(spark: SparkSession, sf: str, replay: bool) -> DataFrame:
    """Current cells after page messages went through a stream, batch by batch."""
    folder = scratch(spark, "stream")
    messages = page_messages(spark, sf, "webpage")
    messages.write.option("maxRecordsPerFile", 100_000).parquet(f"{folder}/messages")
    store = KeyedStore(spark, f"{folder}/store")
    source = stream_message_files(spark, f"{folder}/messages", max_files=4)
    query = run_stream(
        WEBPAGE_HOME, source, store, f"{folder}/checkpoint", available_now=True, zone=ZONE, now=lambda: INGEST_TIME
    )
    query.awaitTermination()
    if replay:
        # The same messages again under the batch id they had: nothing may change.
        again = {"run": query.id, "replay": True}
        run_batch(WEBPAGE_HOME, messages, store, INGEST_TIME + timedelta(hours=1), 0, ZONE, **again)
        run_batch(WEBPAGE_HOME, messages, store, INGEST_TIME, 0, ZONE, **again)
    cells = store.cells("webpage").unionByName(store.cells("homepage"))
    return latest_cells(cells).select(F.col("table").alias("target"), "rowkey", "family", "qualifier", "value")


def stream_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, replay=False)


def stream_replay_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, replay=True)


def ingest_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Stored writes of each cell after a back-fill, a stream and a second back-fill into one store."""
    folder = scratch(spark, "runs")
    messages = page_messages(spark, sf, "webpage")
    messages.write.option("maxRecordsPerFile", 100_000).parquet(f"{folder}/messages")
    store = KeyedStore(spark, f"{folder}/store")
    run_batch(WEBPAGE_HOME, messages, store, INGEST_TIME, zone=ZONE, run="first")
    source = stream_message_files(spark, f"{folder}/messages")
    run_stream(
        WEBPAGE_HOME, source, store, f"{folder}/checkpoint", available_now=True, zone=ZONE, now=lambda: INGEST_TIME
    ).awaitTermination()
    run_batch(WEBPAGE_HOME, messages, store, INGEST_TIME, zone=ZONE, run="second")
    cells = store.cells("webpage").unionByName(store.cells("homepage"))
    key = [F.col("table").alias("target"), "rowkey", "family", "qualifier", "value"]
    return cells.groupBy(*key).agg(F.count(F.lit(1)).alias("writes"), F.countDistinct("run").alias("runs"))


def ingest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Current cells of the two page tables after one batch."""
    cells = WEBPAGE_HOME.cells(page_messages(spark, sf, "webpage"), INGEST_TIME, ZONE)
    good = cells.where(F.col("table") != DEAD_LETTERS)
    return latest_cells(good).select(F.col("table").alias("target"), "rowkey", "family", "qualifier", "value")


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "domain_extract": domain_extract,
        "domain_counts": domain_counts,
        "domain_abroad": domain_abroad,
        "url_hash64": url_hash64,
        "site_group": site_group_query,
        "site_group_intended": site_group_intended_query,
        "id_rehash": id_rehash,
        "time_dashed": time_dashed,
        "time_dual": time_dual,
        "time_zero_on_error": time_zero_on_error,
        "time_twelve_hour": time_twelve_hour,
        "time_normalise": time_normalise,
        "publish_repair": publish_repair,
        "reverse_text": reverse_text_query,
        "json_parse_events": json_parse_events,
        "null_to_empty": null_to_empty_query,
        "blank_to_empty": blank_to_empty_query,
        "pad_fields": pad_fields,
        "repair_keys": repair_keys,
        "const_group": const_group,
        "engine_lookup": engine_lookup,
        "stype_lookup": stype_lookup,
        "site_name_lookup": site_name_lookup,
        "language_lookup": language_lookup,
        "route_group": route_group,
        "route_binary": route_binary,
        "home_split": home_split,
        "home_complement": home_complement,
        "index_route": index_route,
        "valid_interval_by_city": valid_interval_by_city,
        "upsert_latest_cells": upsert_latest_cells,
        "table_snapshot": table_snapshot,
        "range_scan": range_scan,
        "csv_cells": csv_cells,
        "csv_typed": csv_typed,
        "tsv_log_classify": tsv_log_classify,
        "reply_explode": reply_explode,
        "reply_explode_all": reply_explode_all,
        "cells_explode": cells_explode,
        "rekey_projection": rekey_projection,
        "dead_letters": dead_letters,
        "dead_letter_summary": dead_letter_summary,
        "website_documents": website_documents_query,
        "website_index_counts": website_index_counts,
        "ingest_snapshot": ingest_snapshot,
        "ingest_two_runs": ingest_two_runs,
        "stream_equals_batch": stream_equals_batch,
        "stream_replay_idempotent": stream_replay_idempotent,
    }
    for name in JOBS:
        registered[f"ingest_{name.replace('-', '_')}"] = ingest(name)
    from crawlflow.catalog import stored  # it uses the functions of this module

    return registered | stored.queries()
