"""Exactly-once inserts, rejects, gaps, topics added later, capped batches and dimensions that change."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from crawlflow.operators.judged import REASON, RECORD, good_rows, judged_columns, rejected_rows
from crawlflow.plans import registry as jobs
from crawlflow.plans.access_log import RECORD_SCHEMA, judged_access_records
from crawlflow.plans.lines import judged_people
from crawlflow.plans.website import SITE_SCHEMA, WebsiteSpec
from crawlflow.sources.dimensions import VersionedDimension
from crawlflow.sources.keyed_store import DEAD_LETTERS, KeyedStore
from crawlflow.sources.ledger import LedgerTable
from crawlflow.sources.messages import files_for, land_messages, stream_message_files, stream_text
from crawlflow.sources.shared_files import SharedFiles
from crawlflow.streaming.gaps import Gap, LostDataError, Places
from crawlflow.streaming.runs import batch_writer, run_batch, run_inserts, run_stream, run_topics
from tests.test_store_and_streams import NOW, messages, values


def log_line(vtime, muid="m", dealer="d1"):
    parts = ["-"] * 31
    parts[0], parts[1], parts[9], parts[18], parts[25], parts[29] = "u", muid, str(vtime), "0", "null", dealer
    return "\t".join(parts)


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def judged(spark, n, bad=()):
    df = spark.range(n)
    reason = F.when(F.col("id").isin(list(bad)), "bad")
    return df.select("id", *judged_columns(reason, F.concat(F.lit("r"), "id")))


class Failing(LedgerTable):
    """Fails once, before or after its record is in place."""

    def _commit(self, record):
        fail = FAILURES.pop() if FAILURES else None
        if fail == "before":
            raise RuntimeError("lost before the record")
        done = super()._commit(record)
        if fail == "after":
            raise RuntimeError("lost after the record")
        return done


FAILURES: list[str] = []


@pytest.mark.parametrize("fail", ["before", "after"])
def test_a_batch_that_fails_around_its_record_is_inserted_once(spark, tmp_path, fail):
    for k in range(3):
        write_lines(tmp_path / "in", f"{k}.log", [log_line(10 * k + i) for i in range(10)] + [log_line("x"), log_line(1, "null")])
    log = Failing(spark, str(tmp_path / "log"), RECORD_SCHEMA)

    def run():
        lines = stream_text(spark, str(tmp_path / "in"), max_files=1)
        return run_inserts(lines, judged_access_records, log, str(tmp_path / "ck"), available_now=True)

    FAILURES.append(fail)
    with pytest.raises(StreamingQueryException):
        run().awaitTermination()
    seen = log.rows().count()
    assert seen == (0 if fail == "before" else 10)
    query = run()
    query.awaitTermination()
    assert sorted(r.vtime for r in log.rows().collect()) == list(range(30))
    assert sorted(r.reason for r in log.rejects().collect()) == ["bad_time"] * 3 + ["no_visitor"] * 3
    records = log.records().orderBy("batch_id").collect()
    assert [(r.run, r.batch_id, r.n_read, r.n_good, r.n_rejected) for r in records] == [(query.id, k, 12, 10, 2) for k in range(3)]
    assert log.vacuum() == (1 if fail == "before" else 0)
    assert log.rows().count() == 30 and log.vacuum() == 0


def test_the_second_writer_of_a_batch_is_not_seen(spark, tmp_path, monkeypatch):
    table = LedgerTable(spark, str(tmp_path), "id long")
    first = table.insert(judged(spark, 5, bad=[2]), "r/1", 7)
    assert (first.n_read, first.n_good, first.n_rejected) == (5, 4, 1)
    # A writer that looked before the first one's record was there.
    monkeypatch.setattr(LedgerTable, "record", lambda self, run, batch_id, found=[None, first]: found.pop(0))
    assert table.insert(judged(spark, 9), "r/1", 7) is None
    monkeypatch.undo()
    assert table.insert(judged(spark, 9), "r/1", 7) is None
    assert table.insert(judged(spark, 3), "r/2", 7).n_good == 3
    assert sorted(r.id for r in table.rows().collect()) == [0, 0, 1, 1, 2, 3, 4]
    assert [tuple(r) for r in table.rejects().collect()] == [("bad", "r2")]
    assert table.vacuum() == 1


def test_empty_tables_and_batches(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path), "id long, name string")
    assert table.rows().columns == ["id", "name"] and table.rows().count() == table.rejects().count() == table.records().count() == 0
    assert table.vacuum() == 0
    empty = spark.createDataFrame([], f"id long, name string, {REASON} string, {RECORD} string")
    assert table.insert(empty, "r", 0).n_read == 0 and table.rows().count() == 0
    assert table.insert(empty, "r", 0) is None


def test_lost_rows_are_refused(spark, tmp_path):
    read = Observation()
    rows = spark.range(10).observe(read, F.count(F.lit(1)).alias("n_read")).withColumn("held", F.explode(F.array(F.lit(1)))).where("id < 9")
    table = LedgerTable(spark, str(tmp_path), "id long")
    with pytest.raises(ValueError, match="read 10 rows, 9 good"):
        table.insert(rows.select("id", *judged_columns(F.lit(None).cast("string"), F.lit(""))), "r", 0, read)
    assert table.rows().count() == 0


def test_good_and_rejected_rows_are_all_rows(spark):
    lines = spark.createDataFrame([("1,a,2",), ("x,a,2",), ("3",), ("4,b,y",), (None,), ("",)], "value string")
    people = judged_people(lines)
    assert [tuple(r) for r in good_rows(people).collect()] == [(1, "a", 2)]
    assert sorted(tuple(r) for r in rejected_rows(people).collect()) == [
        ("bad_age", "4,b,y"), ("bad_id", ""), ("bad_id", ""), ("bad_id", "x,a,2"), ("no_name", "3"),
    ]


def test_website_dead_letters(spark, tmp_path):
    sites = spark.createDataFrame([("5", "five")], SITE_SCHEMA)
    languages = spark.createDataFrame([("-5", "ru")], "site_id string, language string")
    store = KeyedStore(spark, str(tmp_path))
    sent = [{"url": "http://a.com", "site_id": "5"}, "bad", {"url": "http://b.com", "site_id": "9", "group_id": "11"}, {"url": " ", "site_id": "5"}]
    run_batch(WebsiteSpec(sites, languages), messages(spark, sent), store, NOW, run="one")
    dead = {r.rowkey: (r.errmsg, r.record) for r in store.columns(DEAD_LETTERS, ["errmsg", "record"]).collect()}
    assert {k: v[0] for k, v in dead.items()} == {f"website/one/0/t_0_{k}": e for k, e in ((1, "unreadable"), (2, "no_index"), (3, "no_url"))}
    assert dead["website/one/0/t_0_1"][1] == "bad"
    assert {r.rowkey for r in store.latest("zong/tests").collect()} == {"http://a.com"}


def sent(spark, first, last):
    return messages(spark, [{"urlhash": str(i), "n": str(i)} for i in range(first, last)], topic="forum", first=first)


@pytest.mark.parametrize("strict", [False, True])
def test_messages_that_expired_are_counted_or_refused(spark, tmp_path, strict):
    inbox, store = str(tmp_path / "in"), KeyedStore(spark, str(tmp_path / "s"))
    places = Places(spark, str(tmp_path / "places"), strict)

    def run():
        source = stream_message_files(spark, inbox, max_files=1, after_read="delete")
        run_stream(jobs.FORUM, source, store, str(tmp_path / "ck"), available_now=True, places=places).awaitTermination()

    land_messages(sent(spark, 0, 10).coalesce(1), inbox, 100)
    run()
    land_messages(sent(spark, 17, 20).coalesce(1), inbox, 100)
    if strict:
        with pytest.raises(StreamingQueryException, match="7 messages are gone"):
            run()
        assert len(values(store.latest("forum"))) == 20
        # A stream that is told to go on counts them.
        places = Places(spark, str(tmp_path / "places"))
    run()
    assert [tuple(r) for r in places.gaps().drop("batch_id").collect()] == [("forum", 0, 10, 16, 7)]
    assert {k[0] for k in values(store.latest("forum"))} == {str(i) for i in [*range(10), *range(17, 20)]}


def test_places_of_a_batch_that_runs_again(spark, tmp_path):
    places = Places(spark, str(tmp_path))
    assert places.gaps().count() == 0
    assert places.check(sent(spark, 0, 5), 0) == []
    gap = [Gap(1, "forum", 0, 5, 7)]
    assert places.check(sent(spark, 8, 9), 1) == gap == places.check(sent(spark, 8, 9), 1)
    assert places.check(messages(spark, ["a"], topic="new", first=40), 2) == []
    assert places.check(sent(spark, 9, 10), 3) == [] and places.gaps().count() == 1
    # After many batches without messages.
    assert places.check(sent(spark, 10, 12), 50) == [] and places.check(sent(spark, 14, 15), 51) == [Gap(51, "forum", 0, 12, 13)]
    with pytest.raises(LostDataError):
        Places(spark, str(tmp_path), strict=True).check(sent(spark, 20, 21), 4)


def test_a_topic_added_at_restart(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"))

    def run(*topics):
        sources = {t: stream_message_files(spark, str(tmp_path / t)) for t in topics}
        queries = run_topics(jobs.FORUM, sources, store, str(tmp_path / "ck"), available_now=True)
        for query in queries.values():
            query.awaitTermination()
        return {t: q.id for t, q in queries.items()}

    land_messages(sent(spark, 0, 3), str(tmp_path / "a"), 10)
    land_messages(sent(spark, 10, 13), str(tmp_path / "b"), 10)
    before = run("a", "b")
    land_messages(sent(spark, 3, 5), str(tmp_path / "a"), 10)
    land_messages(sent(spark, 20, 23), str(tmp_path / "c"), 10)
    after = run("a", "b", "c")
    assert before == {t: after[t] for t in "ab"}
    written = store.cells("forum").where("qualifier = 'n'").groupBy("rowkey").count().collect()
    assert {r.rowkey: r["count"] for r in written} == {str(i): 1 for i in [*range(5), *range(10, 13), *range(20, 23)]}


def test_batches_are_capped_by_rows(spark, tmp_path):
    inbox, store = str(tmp_path / "in"), KeyedStore(spark, str(tmp_path / "s"))
    land_messages(sent(spark, 0, 95).repartition(3), inbox, 10)
    source = stream_message_files(spark, inbox, max_rows=25, rows_per_file=10)
    run_stream(jobs.FORUM, source, store, str(tmp_path / "ck"), available_now=True).awaitTermination()
    read = [r["count"] for r in store.cells("forum").where("qualifier = 'n'").groupBy("batch_id").count().collect()]
    assert sum(read) == 95 and max(read) <= 20 and len(values(store.latest("forum"))) == 190
    assert files_for(25, 10) == 2
    with pytest.raises(ValueError, match="does not fit"):
        stream_message_files(spark, inbox, max_rows=5, rows_per_file=10)
    with pytest.raises(ValueError, match="rows_per_file"):
        stream_message_files(spark, inbox, max_rows=5)


def test_a_batch_is_read_once_and_an_expired_replay_keeps_its_cells(spark, tmp_path):
    inbox, store = str(tmp_path / "in"), KeyedStore(spark, str(tmp_path / "s"))
    land_messages(sent(spark, 0, 40).repartition(2), inbox, 10)
    source = stream_message_files(spark, inbox, max_rows=20, rows_per_file=10)
    query = run_stream(jobs.FORUM, source, store, str(tmp_path / "ck"), available_now=True)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 40
    stored = values(store.latest("forum"))
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", query.id)
    try:
        write = batch_writer(jobs.FORUM, store)
        write(sent(spark, 0, 0), 0)
        write(sent(spark, 0, 0), 99)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert len(stored) == 80 and values(store.latest("forum")) == stored


def test_a_dimension_that_changes_between_batches(spark, tmp_path):
    dimension = VersionedDimension(spark, str(tmp_path), SITE_SCHEMA)
    with pytest.raises(ValueError, match="no version"):
        dimension.of_batch("r", 0)
    old, new = (spark.createDataFrame([("5", name), (None, name), ("5", name)], SITE_SCHEMA) for name in ("old", "new"))
    assert dimension.publish(old) == 0 == dimension.publish(old.orderBy("site_id"))
    assert {r.site_name for r in dimension.of_batch("r", 0).collect()} == {"old"}
    assert dimension.publish(new) == 1
    assert {r.site_name for r in dimension.of_batch("r", 0).collect()} == {"old"}
    assert {r.site_name for r in dimension.of_batch("r", 1).collect()} == {r.site_name for r in dimension.of_batch("s", 0).collect()} == {"new"}
    assert dimension.publish(old) == 2 and dimension.newest() == 2
    assert dimension.version(1).count() == 3


def test_shared_files(spark, tmp_path):
    files = SharedFiles(spark, str(tmp_path))
    for text in ("one", "two"):
        files.write_new(f"{tmp_path}/aside/{text}", text)
    assert files.move_new(f"{tmp_path}/aside/one", f"{tmp_path}/to/it") and not files.move_new(f"{tmp_path}/aside/two", f"{tmp_path}/to/it")
    assert (tmp_path / "to" / "it").read_text() == "one" and [p.rpartition("/")[2] for p in files.glob(f"{tmp_path}/aside/*")] == ["two"]
    files.delete(f"{tmp_path}/aside")
    assert not files.exists(f"{tmp_path}/aside") and files.glob(f"{tmp_path}/aside/*") == []
