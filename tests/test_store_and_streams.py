import json
import random
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from crawlflow.operators.cells import latest_cells, rows_of, rows_with_columns
from crawlflow.plans import registry as jobs
from crawlflow.plans.access_log import access_records
from crawlflow.plans.rekey import rekey_table
from crawlflow.plans.website import WebsiteSpec
from crawlflow.session import checkpoint_root
from crawlflow.sources.keyed_store import DEAD_LETTERS, KeyedStore, epoch_ms
from crawlflow.sources.messages import (
    MESSAGE_SCHEMA,
    KafkaTopics,
    from_lines,
    kafka_columns,
    read_message_files,
    read_text_messages,
    stream_message_files,
    stream_text,
)
from crawlflow.sources.tables import jdbc_options, read_field_list
from crawlflow.streaming.runs import print_stream, run_batch, run_rows, run_stream, topics_of

NOW = datetime(2024, 2, 1, 8, 30, 15, tzinfo=timezone.utc)
CELL_SCHEMA = (
    "table string, rowkey string, family string, qualifier string, value string, "
    "src_partition int, src_offset long"
)


def messages(spark, texts, topic="t", first=0):
    rows = [(None, t if isinstance(t, str) else json.dumps(t), topic, 0, first + i, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def values(df):
    return {(r.rowkey, r.family, r.qualifier): r.value for r in df.collect()}


def random_cells(rng, count, keys):
    return [
        ("t", str(rng.randrange(keys)), rng.choice(["c1", "c2"]), rng.choice("abc"), str(rng.random()), 0, i)
        for i in range(count)
    ]


def brute_latest(cells):
    return {(c[1], c[2], c[3]): c[4] for c in sorted(cells, key=lambda c: c[6])}


def test_latest_cells_equal_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    cells = random_cells(rng, 3000, 50)
    # A third of all writes go to one cell.
    cells += [("t", "hot", "c1", "a", str(i), 0, 10_000 + i) for i in range(1500)]
    df = spark.createDataFrame(rng.sample(cells, len(cells)), CELL_SCHEMA).repartition(4)
    latest = latest_cells(df)
    assert values(latest) == brute_latest(cells)
    plan = latest_cells(spark.createDataFrame(cells, CELL_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and plan.count("Exchange") == 1


def test_rows_and_columns(spark):
    cells = [
        ("t", "1", "c1", "a", "x", 0, 0),
        ("t", "1", "c1", "b", "y", 0, 1),
        ("t", "1", "c2", "snapshot", "s", 0, 2),
        ("t", "2", "c1", "a", "old", 0, 3),
    ]
    cells += [("t", "2", "c1", "a", "", 0, 4)]
    df = spark.createDataFrame(cells, CELL_SCHEMA)
    latest = latest_cells(df)
    rows = {r.rowkey: (r.c1, r.c2) for r in rows_of(latest).collect()}
    assert rows == {"1": ({"a": "x", "b": "y"}, {"snapshot": "s"}), "2": ({"a": ""}, {})}
    picked = {r.rowkey: (r.a, r.b) for r in rows_with_columns(df, ["a", "b"]).collect()}
    assert picked == {"1": ("x", "y"), "2": ("", None)}


def test_put_keeps_the_other_cells(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"))
    run_batch(jobs.FORUM, messages(spark, [{"urlhash": "1", "a": "x", "b": "y"}]), store, NOW, 0, run="r")
    later = NOW + timedelta(seconds=1)
    run_batch(jobs.FORUM, messages(spark, [{"urlhash": "1", "b": "z"}]), store, later, 1, run="r")
    assert values(store.latest("forum")) == {
        ("1", "c1", "urlhash"): "1",
        ("1", "c1", "a"): "x",
        ("1", "c1", "b"): "z",
    }


def test_replayed_batch_changes_nothing(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"))
    batch = messages(spark, [{"urlhash": "1", "a": "x"}, "bad"])
    run_batch(jobs.FORUM, batch, store, NOW, 0, run="r")
    before = store.cells("forum").count()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run_batch(jobs.FORUM, batch, store, NOW, 0, run="r")
    run_batch(jobs.FORUM, batch, store, NOW, 0, run="r", replay=True)
    assert store.cells("forum").count() == before
    assert store.cells(DEAD_LETTERS).count() == 4


def test_one_job_writes_all_tables_and_families(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"))
    texts = [{"urlhash": str(i), "group_id": g, "snapshot": "s"} for i, g in enumerate(["3", "5", "14", "9"])]
    run_batch(jobs.ZHIMEI_MIX, messages(spark, texts), store, NOW, 0, max_records_per_file=5, even_files=True, run="r")
    folder = tmp_path / "s" / "log" / "writer=zhimei_mix" / "run=r" / "batch_id=0"
    assert {p.name for p in folder.iterdir() if p.is_dir()} == {
        "table=blog", "table=paper", "table=ask-answer", f"table={DEAD_LETTERS}",
    }
    assert {p.name for p in (folder / "table=blog").iterdir()} == {"family=c1", "family=c2"}
    assert len(list((folder / "table=blog" / "family=c1").glob("*.parquet"))) >= 2
    assert store.rows("paper").first().c2 == {"snapshot": "s"}
    assert store.columns(DEAD_LETTERS, ["errmsg"]).first().errmsg == "unrouted"


def test_scan_reads_only_what_is_asked(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"))
    texts = [{"urlhash": str(i), "title": f"t{i}", "snapshot": "s" * 50} for i in range(20)]
    run_batch(jobs.NEWSPAPER, messages(spark, texts), store, NOW, 0, run="r")
    found = store.cells("paper", columns=["title"], families=["c1"], start="1", stop="2")
    assert {r.rowkey for r in found.collect()} == {"1", *[str(i) for i in range(10, 20)]}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rowkey,1)" in plan and "LessThan(rowkey,2)" in plan
    assert "EqualTo(qualifier,title)" in plan or "In(qualifier" in plan
    assert all("family=c1" in f for f in found.inputFiles())
    assert {r.title for r in store.columns("paper", ["title"], start="1", stop="11").collect()} == {"t1", "t10"}


def test_compacted_table_and_later_writes(spark, tmp_path):
    rng = random.Random(5)
    old = random_cells(rng, 600, 40)
    new = random_cells(rng, 60, 60)
    store, target = KeyedStore(spark, str(tmp_path / "a")), KeyedStore(spark, str(tmp_path / "b"))
    store.append(spark.createDataFrame(old[:300], CELL_SCHEMA), "w", 0, 1000, run="r")
    store.append(spark.createDataFrame(old[300:], CELL_SCHEMA), "w", 1, 2000, run="r")
    store.compact(target, "t", partitions=4)
    assert values(target.latest("t")) == brute_latest(old) == values(store.latest("t"))
    assert target.cells("t").count() == len(brute_latest(old))
    assert "Exchange" not in target.latest("t")._jdf.queryExecution().executedPlan().toString()
    target.append(spark.createDataFrame(new, CELL_SCHEMA), "w", 2, 3000, run="r")
    # A late write that is older than the compacted cells must lose.
    target.append(spark.createDataFrame(old[:50], CELL_SCHEMA), "late", 0, 500, run="r")
    assert values(target.latest("t")) == brute_latest(old) | brute_latest(new)
    plan = target.latest("t")._jdf.queryExecution().executedPlan().toString()
    # Few new keys: the compacted cells pass by a broadcast and are not shuffled.
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "LeftSemi" in plan
    assert "SortMergeJoin" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert values(target.latest("t")) == brute_latest(old) | brute_latest(new)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def test_compaction_sorts_files_by_key_range(spark, tmp_path):
    store, target = KeyedStore(spark, str(tmp_path / "a")), KeyedStore(spark, str(tmp_path / "b"))
    cells = [("t", f"{i:04d}", "c1", "a", "v", 0, i) for i in range(400)]
    store.append(spark.createDataFrame(cells, CELL_SCHEMA), "w", 0, 1, run="r")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.compact(target, "t", partitions=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranges = (
        target.cells("t")
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("rowkey").alias("low"), F.max("rowkey").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert len(ranges) >= 3
    assert all(a.high < b.low for a, b in zip(ranges, ranges[1:], strict=False))


def test_rekey_table(spark, tmp_path):
    source, target = KeyedStore(spark, str(tmp_path / "a")), KeyedStore(spark, str(tmp_path / "b"))
    sent = {"urlhash": "9", "url": "abc", "gathertime": "2016-11-24 11:57:02", "publishdate": "d", "title": "T", "snapshot": "s"}
    run_batch(jobs.FIRST_RECEIVER.with_options(key_time=None), messages(spark, [sent]), source, NOW, 0, run="r")
    rekey_table(source, target, NOW, zone="UTC", max_records_per_file=2000, run="r")
    row = target.rows("paper").first()
    assert row.rowkey == "4952883123889572249_1479988622000"
    assert row.c1["publishtime"] == "d" and row.c1["title"] == "T" and row.c2 == {"snapshot": "s"}


def write_files(df, folder, count):
    for i in range(count):
        df.where(F.col("offset") % count == i).coalesce(1).write.mode("append").parquet(str(folder))


def test_stream_equals_batch(spark, tmp_path):
    texts = [{"urlhash": str(i % 30), "url": f"http://www.e{i}.com", "site_id": str(300000 + i % 5), "n": str(i)} for i in range(60)]
    sent = messages(spark, [*texts, "bad"])
    write_files(sent.where("offset < 30 or offset = 60"), tmp_path / "in", 3)
    stream_store, batch_store = KeyedStore(spark, str(tmp_path / "a")), KeyedStore(spark, str(tmp_path / "b"))
    clock = iter(NOW + timedelta(seconds=i) for i in range(100))

    def run():
        source = stream_message_files(spark, str(tmp_path / "in"), max_files=1)
        query = run_stream(
            jobs.WEBPAGE_HOME, source, stream_store, str(tmp_path / "ck"), available_now=True, zone="UTC", now=lambda: next(clock)
        )
        query.awaitTermination()
        return query

    run()
    # More messages arrive; the restarted stream goes on from its checkpoint.
    write_files(sent.where("offset >= 30 and offset < 60"), tmp_path / "in", 2)
    run()
    [stream_run] = [p for p in (tmp_path / "a" / "log" / "writer=webpage_home").iterdir() if p.is_dir()]
    batches = [p.name for p in stream_run.iterdir() if p.is_dir()]
    assert sorted(batches) == [f"batch_id={i}" for i in range(5)]
    run()  # nothing new
    assert len([p for p in (tmp_path / "a" / "log" / "writer=webpage_home").iterdir() if p.is_dir()]) == 1
    assert len([p for p in stream_run.iterdir() if p.is_dir()]) == 5
    run_batch(jobs.WEBPAGE_HOME, read_message_files(spark, str(tmp_path / "in")), batch_store, NOW, 0, "UTC", run="r")
    for table in ("webpage", "homepage"):
        assert values(stream_store.latest(table)) == values(batch_store.latest(table))
    assert stream_store.columns(DEAD_LETTERS, ["record"]).first().record == "bad"


def test_failed_batch_is_written_again(spark, tmp_path):
    sent = messages(spark, [{"urlhash": str(i)} for i in range(10)])
    write_files(sent, tmp_path / "in", 1)
    store = KeyedStore(spark, str(tmp_path / "s"))
    source = stream_message_files(spark, str(tmp_path / "in"))
    written = []

    def fail_after_write(batch, batch_id):
        run_batch(jobs.FORUM, batch, store, NOW, batch_id, run="r", replay=True)
        written.append(batch_id)
        if len(written) == 1:
            raise RuntimeError("lost before the commit")

    def start():
        return (
            source.writeStream.option("checkpointLocation", str(tmp_path / "ck"))
            .foreachBatch(fail_after_write)
            .trigger(availableNow=True)
            .start()
        )

    with pytest.raises(Exception, match="lost before the commit"):
        start().awaitTermination()
    start().awaitTermination()
    assert written == [0, 0]
    assert store.cells("forum").count() == 10


def test_empty_batch_writes_nothing(spark, tmp_path):
    messages(spark, ["x"]).where("false").write.parquet(str(tmp_path / "in"))
    store = KeyedStore(spark, str(tmp_path / "s"))
    source = stream_message_files(spark, str(tmp_path / "in"))
    run_stream(jobs.FORUM, source, store, str(tmp_path / "ck"), available_now=True).awaitTermination()
    assert not store.exists("forum")


def test_several_topic_folders(spark, tmp_path):
    write_files(messages(spark, [{"urlhash": "1", "group_id": "0"}], "hct"), tmp_path / "a", 1)
    write_files(messages(spark, [{"urlhash": "2"}], "yixing"), tmp_path / "b", 1)
    store = KeyedStore(spark, str(tmp_path / "s"))
    folders = [str(tmp_path / "a"), str(tmp_path / "b")]
    source = stream_message_files(spark, folders)
    run_stream(jobs.YIXING_HCT_MIX, source, store, str(tmp_path / "ck"), available_now=True).awaitTermination()
    assert store.exists("homepage_hct") and store.exists("yixing")
    assert read_message_files(spark, folders).count() == 2


def test_text_source_and_console(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.txt").write_text('{"urlhash":"1"}\n{"urlhash":"2"}\n')
    path = str(tmp_path / "lines")
    assert read_text_messages(spark, path, "forum").count() == 2
    query = print_stream(stream_text(spark, path, max_files=1), available_now=True)
    query.awaitTermination()
    assert query.recentProgress[0]["numInputRows"] == 2


def test_text_stream_into_the_store(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"urlhash":"1","a":"x"}\n{"urlhash":"1","a":"y"}\nbad\n')
    store = KeyedStore(spark, str(tmp_path / "s"))
    run_stream(
        jobs.FORUM,
        stream_text(spark, str(tmp_path / "in")),
        store,
        str(tmp_path / "ck"),
        available_now=True,
        prepare=lambda lines: from_lines(lines, "forum"),
    ).awaitTermination()
    assert values(store.latest("forum")) == {("1", "c1", "urlhash"): "1", ("1", "c1", "a"): "y"}
    assert store.columns(DEAD_LETTERS, ["record"]).first().record == "bad"


def test_access_log_stream(spark, tmp_path):
    parts = ["-"] * 31
    parts[0], parts[1], parts[9], parts[18], parts[25], parts[29] = "u", "m", "77", "0", "null", "d1"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("\t".join(parts) + "\n" + "short\tline\n")
    out = str(tmp_path / "out")
    query = run_rows(
        stream_text(spark, str(tmp_path / "in")),
        access_records,
        lambda df: df.write.mode("append").parquet(out),
        str(tmp_path / "ck"),
        available_now=True,
    )
    query.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(77, "m", "u", "d1", "di")]


def test_website_stream(spark, tmp_path):
    sites = spark.createDataFrame([("5", "five")], "site_id string, site_name string")
    languages = spark.createDataFrame([("-5", "ru")], "site_id string, language string")
    sent = [{"url": "http://a.com/1", "site_id": "5", "title": t} for t in ("old", "new")] + [{"site_id": "5"}]
    write_files(messages(spark, sent), tmp_path / "in", 1)
    store = KeyedStore(spark, str(tmp_path / "s"))
    source = stream_message_files(spark, str(tmp_path / "in"))
    spec = WebsiteSpec(sites, languages)
    run_stream(spec, source, store, str(tmp_path / "ck"), available_now=True).awaitTermination()
    rows = store.columns("zong/tests", ["title", "site_name"]).collect()
    assert [(r.rowkey, r.title, r.site_name) for r in rows] == [("http://a.com/1", "new", "five")]
    target = KeyedStore(spark, str(tmp_path / "c"))
    store.compact(target, "zong/tests")
    assert values(target.latest("zong/tests")) == values(store.latest("zong/tests"))


def test_kafka_options():
    topics = topics_of(jobs.ZHIMEI_MIX, "a:1,b:2", prefix="crawl_", partitions=3, earliest=False)
    assert topics.options() == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "crawl_blog,crawl_paper,crawl_ask-answer",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "kafka.max.partition.fetch.bytes": "10485760",
        "maxOffsetsPerTrigger": str(20 * 68 * 3),
    }
    plain = KafkaTopics("a:1", ["t"], max_message_bytes=20971520, extra={"groupIdPrefix": "g"}).options()
    assert plain["startingOffsets"] == "earliest" and plain["groupIdPrefix"] == "g"
    assert "maxOffsetsPerTrigger" not in plain and plain["kafka.max.partition.fetch.bytes"] == "20971520"


def test_kafka_columns(spark):
    raw = spark.createDataFrame(
        [(None, bytearray(b'{"urlhash":"1"}'), "t", 0, 5, NOW, 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int",
    )
    row = kafka_columns(raw).first()
    assert (row.value, row.offset) == ('{"urlhash":"1"}', 5)


def test_field_list(spark, tmp_path):
    (tmp_path / "fields").write_text("id\naid\n\nid\n url \n")
    assert read_field_list(spark, str(tmp_path / "fields")) == ("aid", "id", "url")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_field_list(spark, str(tmp_path / "missing"))
    (tmp_path / "long").write_text("\n".join(str(i) for i in range(10_001)))
    with pytest.raises(ValueError, match="not a field list"):
        read_field_list(spark, str(tmp_path / "long"))


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "sites", "u", "p", "d", "site_id", (0, 100), 4)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "site_id"
    assert "numPartitions" not in jdbc_options("jdbc:x", "sites", "u", "p", "d")


def test_checkpoint_root_comes_from_the_session():
    def session(values):
        return SimpleNamespace(conf=SimpleNamespace(get=values.get))

    assert checkpoint_root(session({"spark.checkpoint.dir": "/shared/"}), "/tmp/x") == "/shared"
    assert checkpoint_root(session({}), "/tmp/x/") == "/tmp/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(session({}))


def test_epoch_ms():
    assert epoch_ms(NOW) == epoch_ms(NOW.replace(tzinfo=None)) == 1706776215000


def test_runs_of_one_job_and_tables_of_one_rekey_keep_each_other(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"))
    run_batch(jobs.FORUM, messages(spark, [{"urlhash": "1", "a": "x"}, "bad"]), store, NOW, run="march")
    write_files(messages(spark, [{"urlhash": "2", "a": "y"}, "worse"]), tmp_path / "in", 1)
    source = stream_message_files(spark, str(tmp_path / "in"))
    for part in (1, 2):  # a stream, and another one with a checkpoint of its own
        run_stream(jobs.FORUM, source, store, str(tmp_path / f"ck{part}"), available_now=True).awaitTermination()
    run_batch(jobs.FORUM, messages(spark, [{"urlhash": "3", "a": "z"}]), store, NOW, run="april")
    other = jobs.FORUM.with_options(table="forum2")
    run_batch(other, messages(spark, [{"urlhash": "4", "a": "z"}]), store, NOW, run="may")
    assert {r.rowkey for r in store.columns("forum", ["a"]).collect()} == {"1", "2", "3"}
    assert {r.rowkey for r in store.columns("forum2", ["a"]).collect()} == {"4"}
    dead = store.columns(DEAD_LETTERS, ["record"]).collect()
    assert sorted(r.record for r in dead) == ["bad", "worse", "worse"]
    runs = {r.run for r in store.cells("forum").select("run").distinct().collect()}
    assert len(runs) == 4 and {"march", "april"} < runs


def test_rekeys_into_two_tables_and_rows_with_the_same_new_key(spark, tmp_path):
    source, target = KeyedStore(spark, str(tmp_path / "a")), KeyedStore(spark, str(tmp_path / "b"))
    same = {"url": "http://a.b.cn/1", "gathertime": "2024-01-01 00:00:00", "publishtime": "t"}
    cells = [("newspaper", key, "c1", k, v, 0, 0) for key in "12" for k, v in {**same, "title": key}.items()]
    source.append(spark.createDataFrame(cells, CELL_SCHEMA), "w", 0, 1, run="r")
    for table in ("paper", "paper1"):
        rekey_table(source, target, NOW, out_table=table, zone="UTC", run="once")
    titles = [r.title for t in ("paper", "paper1") for r in target.columns(t, ["title"]).collect()]
    assert titles == ["2", "2"]


def test_ties_between_topics_do_not_follow_the_order_of_rows(spark, tmp_path):
    schema = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
    topics = sorted(jobs.YIXING_HCT_MIX.topics)
    rows = [(None, json.dumps({"urlhash": "1", "group_id": "5", "title": t}), t, 0, 0, None) for t in topics]
    titles = set()
    for name, sent in (("a", rows), ("b", rows[::-1])):
        store = KeyedStore(spark, str(tmp_path / name))
        run_batch(jobs.YIXING_HCT_MIX, spark.createDataFrame(sent, schema).coalesce(1), store, NOW, run="r")
        [table] = [p.name.removeprefix("table=") for p in (tmp_path / name / "log").glob("*/*/*/table=*")]
        titles |= {r.title for r in store.columns(table, ["title"]).collect()}
    assert titles == {topics[-1]}


def test_families_that_are_absent_or_unusual(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"))
    store.append(spark.createDataFrame([("t", "1", "cf", "q", "v", 0, 0)], CELL_SCHEMA), "w", 0, 1, run="r")
    assert store.latest("t", families=["c1"]).count() == 0
    row = store.rows("t").first()
    assert (row.c1, row.c2, row.other_families) == ({}, {}, {"cf": {"q": "v"}})


def test_start_and_message_size_of_each_job():
    # The jobs that start at the newest message.
    latest = "forum homepage_hct newspaper replies replies_plain webpage weibouser yixing_hct_mix zhimei_mix"
    assert {n for n, j in jobs.JOBS.items() if j.start == "latest"} >= set(latest.split())
    for job in jobs.JOBS.values():
        options = topics_of(job, "a:1", partitions=1).options()
        assert options["startingOffsets"] == job.start
        assert options["kafka.max.partition.fetch.bytes"] == str((20 if job is jobs.OLD_FORUM else 10) * 1024 * 1024)
