"""Registered queries over what jobs have stored: plain and keyed tables, dead letters, and streams that restart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crawlflow.catalog.messages import INGEST_TIME, page_messages, table
from crawlflow.catalog.queries import (
    ZONE,
    Query,
    access_lines,
    good_cells,
    language_dimension,
    page_records,
    scratch,
    site_dimension,
)
from crawlflow.fixed_values import REKEY_FIELDS, SNAPSHOT
from crawlflow.operators.cells import explode_fields, family_of, latest_cells
from crawlflow.operators.records import text_map
from crawlflow.plans.access_log import RECORD_SCHEMA, judged_access_records
from crawlflow.plans.lines import CELL_SCHEMA, judged_line_cells, judged_person_cells
from crawlflow.plans.registry import FORUM, WEBPAGE_HOME, WEIBOUSER, ZHIMEI_MIX
from crawlflow.plans.rekey import rekey_table
from crawlflow.plans.website import LANGUAGE_SCHEMA, SITE_SCHEMA, WebsiteSpec
from crawlflow.sources.dimensions import VersionedDimension
from crawlflow.sources.keyed_store import DEAD_LETTERS, KeyedStore, epoch_ms
from crawlflow.sources.ledger import LedgerTable
from crawlflow.sources.messages import from_lines, land_messages, read_text_messages, stream_message_files, stream_text
from crawlflow.sources.shared_files import SharedFiles
from crawlflow.sources.tables import read_field_list
from crawlflow.streaming.gaps import Places
from crawlflow.streaming.runs import run_batch, run_inserts, run_stream, run_topics

INDICES = ("souye/sy", "weiwap/test", "zong/tests")


# Plain tables ---------------------------------------------------------------------------------------
def access_log_inserted(spark: SparkSession, sf: str) -> DataFrame:
    """Records of a plain table after a stream of log lines and the replay of its first batch."""
    folder = scratch(spark, "inserts")
    access_lines(spark, sf).repartition(8).write.text(f"{folder}/lines")
    log = LedgerTable(spark, f"{folder}/log", RECORD_SCHEMA)
    lines = stream_text(spark, f"{folder}/lines", max_files=3)
    stream = run_inserts(lines, judged_access_records, log, f"{folder}/checkpoint", available_now=True)
    stream.awaitTermination()
    if log.insert(judged_access_records(spark.read.text(f"{folder}/lines")), stream.id, 0) is not None:
        raise AssertionError("a batch of the ledger was inserted again")
    return log.rows()


def _inserted(spark: SparkSession, name: str, lines: DataFrame, judge, schema: str) -> LedgerTable:
    """A plain table after one batch, whose good and rejected rows are as many as were read."""
    stored = LedgerTable(spark, f"{scratch(spark, name)}/{name}", schema)
    read = Observation()
    stored.insert(judge(lines.observe(read, F.count(F.lit(1)).alias("n_read"))), "load", 0, read)
    return stored


def access_log_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return _inserted(spark, "log", access_lines(spark, sf), judged_access_records, RECORD_SCHEMA).rejects()


def access_log_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """What the ledger says of the batch."""
    stored = _inserted(spark, "log", access_lines(spark, sf), judged_access_records, RECORD_SCHEMA)
    return stored.records().drop("attempt")


def cell_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Cell lines made of the events; every 17th ends after its family."""
    whole = "concat_ws(',', user_id, 'c1', event_type, event_id)"
    return table(spark, sf, "events").selectExpr(f"if(event_id % 17 = 3, user_id || ',c1', {whole}) as value")


def line_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return _inserted(spark, "cells", cell_lines(spark, sf), lambda df: judged_line_cells(df, "events"), CELL_SCHEMA).rejects()


# Keyed tables ---------------------------------------------------------------------------------------
def person_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Person lines made of the parts, with bad ids and ages, and lines that end early."""
    return table(spark, sf, "part").selectExpr(
        """case p_partkey % 10 when 3 then concat_ws(',', '?', p_brand, p_size) when 4 then p_partkey || ',' || p_brand
          when 5 then concat_ws(',', p_partkey, p_brand, 'x') when 6 then cast(p_partkey as string)
          else concat_ws(',', p_partkey, p_brand, p_size) end as value"""
    )


def _people(spark: SparkSession, sf: str) -> KeyedStore:
    store = KeyedStore(spark, scratch(spark, "people"))
    cells = judged_person_cells(person_lines(spark, sf), INGEST_TIME)
    store.append(cells, "people", 0, epoch_ms(INGEST_TIME), run="load")
    return store


def person_stored(spark: SparkSession, sf: str) -> DataFrame:
    return _people(spark, sf).latest("account").drop("table")


def person_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return _people(spark, sf).columns(DEAD_LETTERS, ["errmsg", "record", "topic"]).drop("table", "rowkey")


def _rekeyed(spark: SparkSession, sf: str) -> KeyedStore:
    """Page records stored by page number, then re-keyed into another store."""
    folder = scratch(spark, "rekey")
    source, target = KeyedStore(spark, f"{folder}/old"), KeyedStore(spark, f"{folder}/new")
    names = (*REKEY_FIELDS, "publishdate", "publishtime", SNAPSHOT)
    stored = text_map({name: F.element_at("fields", F.lit(name)) for name in names})
    rows = page_records(spark, sf).select(
        F.lit("newspaper").alias("table"), F.col("page_id").cast("string").alias("rowkey"), stored.alias("fields")
    )
    cells = explode_fields(rows).where(F.col("value").isNotNull())
    source.append(cells.withColumn("family", family_of(F.col("qualifier"))), "pages", 0, epoch_ms(INGEST_TIME), run="load")
    rekey_table(source, target, INGEST_TIME, zone=ZONE, run="rekey")
    return target


def rekey_stored(spark: SparkSession, sf: str) -> DataFrame:
    names = [*REKEY_FIELDS, "urlhash", "publishtime", "group_id", SNAPSHOT, "author", "sim_id"]
    return _rekeyed(spark, sf).columns("paper", names).drop("table")


def rekey_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Why a row got no new key, and the title that its record names."""
    dead = _rekeyed(spark, sf).columns(DEAD_LETTERS, ["errmsg", "record", "topic"])
    return dead.select("errmsg", "topic", F.get_json_object("record", "$.title").alias("title"))


def _website_store(spark: SparkSession, sf: str) -> KeyedStore:
    store = KeyedStore(spark, scratch(spark, "website"))
    spec = WebsiteSpec(site_dimension(spark, sf), language_dimension(spark, sf))
    run_batch(spec, page_messages(spark, sf), store, INGEST_TIME, run="load")
    return store


def website_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of all indices, some of their fields side by side."""
    store = _website_store(spark, sf)
    names = ["site_name", "group_id", "title", "content", "language", "domain_1", "gathertime", "publishtime_str"]
    found = [store.columns(index, names) for index in INDICES if store.exists(index)]
    whole = found[0]
    for other in found[1:]:
        whole = whole.unionByName(other)
    return whole.withColumnsRenamed({"table": "idx", "rowkey": "url"})


def website_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters of the website job: where each stood, and why it is one."""
    return _website_store(spark, sf).columns(DEAD_LETTERS, ["errmsg", "topic"]).drop("table")


# Files ------------------------------------------------------------------------------------------------
def _text_messages(spark: SparkSession, sf: str, name: str) -> str:
    """A folder of text files with a message a line."""
    folder = f"{scratch(spark, name)}/lines"
    page_messages(spark, sf).select("value").write.text(folder)
    return folder


def _cells_in(store: KeyedStore, name: str) -> DataFrame:
    return store.cells(name).select(F.col("table").alias("target"), "rowkey", "family", "qualifier", "value")


def text_files_forum(spark: SparkSession, sf: str) -> DataFrame:
    """Stored cells of the messages of text files."""
    store = KeyedStore(spark, scratch(spark, "text"))
    messages = read_text_messages(spark, _text_messages(spark, sf, "text"), "forum")
    run_batch(FORUM, messages, store, INGEST_TIME, zone=ZONE, run="load")
    return _cells_in(store, "forum")


def text_stream_forum(spark: SparkSession, sf: str) -> DataFrame:
    """Stored cells of a folder of text files that a stream reads."""
    folder = scratch(spark, "lines")
    store = KeyedStore(spark, f"{folder}/store")
    lines = stream_text(spark, _text_messages(spark, sf, "lines"), max_files=2)
    options = {"available_now": True, "zone": ZONE, "now": lambda: INGEST_TIME, "prepare": lambda df: from_lines(df, "forum")}
    run_stream(FORUM, lines, store, f"{folder}/checkpoint", **options).awaitTermination()
    return _cells_in(store, "forum")


def field_list_weibouser(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of a job whose fields come from a file with a name a line."""
    folder = f"{scratch(spark, 'fields')}/names"
    spark.createDataFrame([(name,) for name in WEIBOUSER.fields], "name string").write.text(folder)
    spec = WEIBOUSER.with_options(fields=read_field_list(spark, folder))
    return good_cells(spec.cells(page_messages(spark, sf), INGEST_TIME, ZONE))


# Streams that restart -----------------------------------------------------------------------------------
def _numbered(spark: SparkSession, sf: str, topic: str) -> tuple[DataFrame, int]:
    """Page messages of one partition, their offsets without holes; and their number."""
    messages = page_messages(spark, sf, topic).withColumn("partition", F.lit(0))
    return messages, messages.count()


def _expired(spark: SparkSession, sf: str) -> tuple[KeyedStore, Places]:
    """A job that was down while the middle third of its messages came and went."""
    folder = scratch(spark, "expired")
    messages, n = _numbered(spark, sf, "webpage")
    inbox, store = f"{folder}/messages", KeyedStore(spark, f"{folder}/store")
    places = Places(spark, f"{folder}/places")
    first, last = n // 3, 2 * n // 3

    def run() -> None:
        source = stream_message_files(spark, inbox, after_read="delete")
        options = {"available_now": True, "zone": ZONE, "now": lambda: INGEST_TIME, "places": places}
        run_stream(WEBPAGE_HOME, source, store, f"{folder}/checkpoint", **options).awaitTermination()

    land_messages(messages.where(F.col("offset") < first), inbox, 100_000)
    run()
    files = SharedFiles(spark, inbox)
    before = set(files.glob(f"{inbox}/part-*"))
    land_messages(messages.where(F.col("offset").between(first, last - 1)), inbox, 100_000)
    for path in set(files.glob(f"{inbox}/part-*")) - before:
        files.delete(path)
    land_messages(messages.where(F.col("offset") >= last), inbox, 100_000)
    run()
    return store, places


def expired_files_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Current cells of what was still there when the job came back."""
    store, _ = _expired(spark, sf)
    cells = store.cells("webpage").unionByName(store.cells("homepage"))
    return latest_cells(cells).withColumnRenamed("table", "target")


def expired_files_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The counted gap."""
    return _expired(spark, sf)[1].gaps().drop("batch_id")


def topics_added(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of a job of two topics that is stopped and goes on with a third."""
    folder = scratch(spark, "topics")
    store = KeyedStore(spark, f"{folder}/store")
    topics = ZHIMEI_MIX.topics
    of = {topic: page_messages(spark, sf, topic).where(F.col("offset") % len(topics) == k) for k, topic in enumerate(topics)}

    def run(names: tuple[str, ...]) -> None:
        sources = {topic: stream_message_files(spark, f"{folder}/{topic}") for topic in names}
        options = {"available_now": True, "zone": ZONE, "now": lambda: INGEST_TIME}
        for query in run_topics(ZHIMEI_MIX, sources, store, f"{folder}/checkpoint", **options).values():
            query.awaitTermination()

    for topic in topics[:2]:
        land_messages(of[topic].where("offset % 2 = 0"), f"{folder}/{topic}", 100_000)
    run(topics[:2])
    for topic in topics[:2]:
        land_messages(of[topic].where("offset % 2 = 1"), f"{folder}/{topic}", 100_000)
    land_messages(of[topics[2]], f"{folder}/{topics[2]}", 100_000)
    run(topics)
    stored = [store.cells(name) for name in ("blog", "paper", "ask-answer") if store.exists(name)]
    whole = stored[0]
    for cells in stored[1:]:
        whole = whole.unionByName(cells)
    return whole.select(F.col("table").alias("target"), "rowkey", "family", "qualifier", "value")


def capped_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of a file stream whose batches hold no more messages than rate x interval x partitions."""
    folder = scratch(spark, "capped")
    spec, partitions = FORUM.with_options(rate=10, interval=30), 4
    cap = spec.rate * spec.interval * partitions
    land_messages(page_messages(spark, sf, "forum"), f"{folder}/messages", cap // 4)
    source = stream_message_files(spark, f"{folder}/messages", max_rows=cap, rows_per_file=cap // 4)
    store = KeyedStore(spark, f"{folder}/store")
    options = {"available_now": True, "zone": ZONE, "now": lambda: INGEST_TIME}
    run_stream(spec, source, store, f"{folder}/checkpoint", **options).awaitTermination()
    cells = store.cells("forum")
    place = F.countDistinct("src_topic", "src_partition", "src_offset")
    most = cells.groupBy("batch_id").agg(place.alias("n")).agg(F.max("n")).first()[0] or 0
    if most > cap:
        raise AssertionError(f"a batch of {most} messages, the cap is {cap}")
    return cells.select(F.col("table").alias("target"), "rowkey", "family", "qualifier", "value")


def website_dimension_change(spark: SparkSession, sf: str) -> DataFrame:
    """Site names of documents whose dimension changed between two batches; the first batch runs again after that."""
    folder = scratch(spark, "versions")
    messages, n = _numbered(spark, sf, "outside")
    sites = VersionedDimension(spark, f"{folder}/sites", SITE_SCHEMA)
    languages = VersionedDimension(spark, f"{folder}/languages", LANGUAGE_SCHEMA)
    spec, store = WebsiteSpec(sites, languages), KeyedStore(spark, f"{folder}/store")

    def run(part: DataFrame):
        land_messages(part, f"{folder}/messages", 100_000)
        source = stream_message_files(spark, f"{folder}/messages")
        query = run_stream(spec, source, store, f"{folder}/checkpoint", available_now=True, now=lambda: INGEST_TIME)
        query.awaitTermination()
        return query

    sites.publish(site_dimension(spark, sf))
    languages.publish(language_dimension(spark, sf))
    early = messages.where(F.col("offset") < n // 2)
    query = run(early)
    sites.publish(site_dimension(spark, sf).withColumn("site_name", F.concat("site_name", F.lit("-2"))))
    languages.publish(language_dimension(spark, sf))
    run(messages.where(F.col("offset") >= n // 2))
    run_batch(spec.for_batch(query.id, 0), early, store, INGEST_TIME, 0, run=query.id, replay=True)
    found = [store.columns(index, ["site_name"]) for index in INDICES if store.exists(index)]
    whole = found[0]
    for other in found[1:]:
        whole = whole.unionByName(other)
    return whole.withColumnsRenamed({"table": "idx", "rowkey": "url"})


def queries() -> dict[str, Query]:
    return {
        q.__name__: q
        for q in (
            access_log_inserted,
            access_log_rejects,
            access_log_ledger,
            line_rejects,
            person_stored,
            person_rejects,
            rekey_stored,
            rekey_rejects,
            website_stored,
            website_rejects,
            text_files_forum,
            text_stream_forum,
            field_list_weibouser,
            expired_files_cells,
            expired_files_gaps,
            topics_added,
            capped_stream,
            website_dimension_change,
        )
    }
