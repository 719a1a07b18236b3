import json
from collections import defaultdict
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from crawlflow import fixed_values as fixed
from crawlflow.catalog.messages import page_messages
from crawlflow.operators.explode import explode_codes
from crawlflow.operators.lookups import dimension_lookup, fill_from_dimension
from crawlflow.plans import registry as jobs
from crawlflow.plans.lines import line_cells, person_cells
from crawlflow.plans.rekey import cells_of_rows, judged_rekeyed_rows, rekeyed_rows
from crawlflow.plans.subscriptions import city_entries, valid_by_city
from crawlflow.plans.website import document_cells, judged_documents, website_documents
from crawlflow.sources.keyed_store import DEAD_LETTERS
from crawlflow.sources.messages import from_lines, from_rows

NOW = datetime(2024, 2, 1, 8, 30, 15, tzinfo=timezone.utc)
NOW_MS = "1706776215000"


def rows_by_key(cells):
    """(table, rowkey) -> {family:qualifier -> value}."""
    rows = defaultdict(dict)
    for c in cells.collect():
        assert c.value is not None
        rows[c.table, c.rowkey][f"{c.family}:{c.qualifier}"] = c.value
    return dict(rows)


def ingest(spark, spec, *messages):
    texts = [m if isinstance(m, str) else json.dumps(m, ensure_ascii=False) for m in messages]
    return rows_by_key(spec.cells(from_rows(spark, texts), NOW, "UTC"))


def reasons(rows):
    return {key: row["c1:errmsg"] for (table, key), row in rows.items() if table == DEAD_LETTERS}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(jobs.JOBS))
def test_ingest_is_one_narrow_stage(spark, sf, name):
    plan = plan_of(jobs.JOBS[name].cells(page_messages(spark, sf), NOW, "UTC"))
    assert "Exchange" not in plan
    assert "Python" not in plan
    assert plan.count("from_json") == 1


def test_filter_on_derived_columns_does_not_parse_again(spark, sf):
    cells = jobs.ZHIMEI_MIX.cells(page_messages(spark, sf), NOW, "UTC")
    plan = plan_of(cells.where((F.col("table") == "blog") & (F.col("rowkey") > "5")))
    assert plan.count("from_json") == 1


def test_open_schema_and_null(spark):
    rows = ingest(
        spark, jobs.FORUM, {"urlhash": 7, "x": None, "n": {"a": [1, 2]}, "b": True, "f": 1.50, "s": " "}
    )
    assert rows == {
        ("forum", "7"): {
            "c1:urlhash": "7",
            "c1:x": "",
            "c1:n": '{"a":[1,2]}',
            "c1:b": "true",
            "c1:f": "1.5",
            "c1:s": " ",
        }
    }


def test_last_duplicate_wins_and_unquoted_names(spark):
    rows = ingest(spark, jobs.FORUM, '{"urlhash":"1","a":"x","a":"y"}', "{urlhash:'2'}")
    assert rows["forum", "1"]["c1:a"] == "y"
    assert ("forum", "2") in rows


def test_dead_letters(spark):
    rows = ingest(
        spark,
        jobs.FORUM,
        "not json",
        "[]",
        '[{"urlhash":"1"}]',
        "",
        "null",
        '{"urlhash":"1"} x',
        {},
        {"urlhash": None},
        {"urlhash": " "},
        {"urlhash": "ok"},
    )
    assert reasons(rows) == {
        "rows_0_0": "unreadable",
        "rows_0_1": "unreadable",
        "rows_0_2": "unreadable",
        "rows_0_3": "unreadable",
        "rows_0_4": "unreadable",
        "rows_0_5": "unreadable",
        "rows_0_6": "no_key",
        "rows_0_7": "blank_key",
        "rows_0_8": "blank_key",
    }
    assert rows[DEAD_LETTERS, "rows_0_0"] == {
        "c1:time": "2024-02-01 08:30:15",
        "c1:topic": "rows",
        "c1:record": "not json",
        "c1:errmsg": "unreadable",
    }
    assert ("forum", "ok") in rows


def test_ingest_time_text_follows_the_zone(spark):
    cells = jobs.METASEARCH.cells(from_rows(spark, ['{"id":"1"}']), NOW, "Asia/Shanghai")
    assert rows_by_key(cells)["metasearch", "1"]["c1:inserttime"] == "2024-02-01 16:30:15"


def test_metasearch(spark):
    rows = ingest(
        spark,
        jobs.METASEARCH,
        {"id": "c-1", "sengine": 8, "stype": 3, "url": "http://www.example.com/", "urlhash": "u", "group_id": "99"},
        {"id": "2", "sengine": 99, "snapshot": "<p>"},
        {"sengine": 1},
    )
    row = rows["metasearch", "1"]
    assert row["c1:metasearch"] == "必应" and row["c1:group_id"] == "11"
    assert row["c1:urlhash"] == "1" and row["c1:inserttime"] == "2024-02-01 08:30:15"
    assert row["c1:domain_1"] == "example.com" and row["c1:domain_2"] == "www.example.com"
    assert row["c2:snapshot"] == "" and "c1:snapshot" not in row
    assert {f"c1:{f}" for f in fixed.METASEARCH_FIELDS if f != "snapshot"} <= set(row)
    other = rows["metasearch", "2"]
    assert other["c1:metasearch"] == "" and other["c1:group_id"] == "0" and other["c2:snapshot"] == "<p>"
    assert other["c1:domain_1"] == fixed.DOMAIN_BAD_URL and other["c1:url"] == ""
    assert reasons(rows) == {"rows_0_2": "no_key"}


def test_webpage_and_home(spark):
    page = {"urlhash": "1", "url": "http://www.example.com/", "site_id": "5"}
    home = {"urlhash": "2", "url": "http://www.example.com/", "site_id": 300065}
    abroad = {"urlhash": "3", "url": "http://www.example.com/", "site_id": "300001", "group_id": "7"}
    rows = ingest(spark, jobs.WEBPAGE_HOME, page, home, abroad, {"urlhash": "4"}, {"urlhash": "5", "url": None})
    assert {key for key in rows if key[0] != DEAD_LETTERS} == {
        ("webpage", "1"),
        ("homepage", "2"),
        ("webpage", "3"),
        ("webpage", "5"),
    }
    assert rows["webpage", "3"]["c1:group_id"] == "7"
    assert rows["webpage", "1"]["c1:snapshot"] == ""
    assert rows["webpage", "5"]["c1:domain_1"] == fixed.DOMAIN_BAD_URL
    assert reasons(rows) == {"rows_0_3": "no_url"}
    # The plain job always computes the group.
    assert ingest(spark, jobs.WEBPAGE, abroad)["webpage", "3"]["c1:group_id"] == "1"


def test_group_only_when_missing(spark):
    base = {"url": "http://www.example.com/", "site_id": "60001"}
    rows = ingest(
        spark,
        jobs.ZHIMEI_MIX,
        {**base, "urlhash": "1", "group_id": "3"},
        {**base, "urlhash": "2", "group_id": ""},
        {**base, "urlhash": "3"},
        {**base, "urlhash": "4", "site_id": "300066"},
        {**base, "urlhash": "5", "group_id": 14},
    )
    assert set(rows) == {
        ("blog", "1"),
        (DEAD_LETTERS, "rows_0_1"),
        (DEAD_LETTERS, "rows_0_2"),
        ("paper", "4"),
        ("ask-answer", "5"),
    }
    assert reasons(rows) == {"rows_0_1": "unrouted", "rows_0_2": "unrouted"}


def test_binary_route_pads_one_side(spark):
    rows = ingest(spark, jobs.YIXING_HCT_MIX, {"urlhash": "1", "group_id": "0"}, {"urlhash": "2"})
    assert rows["homepage_hct", "1"] == {"c1:urlhash": "1", "c1:group_id": "0"}
    assert set(rows["yixing", "2"]) == {f"c1:{f}" for f in fixed.YIXING_FIELDS}


def test_key_repairs(spark):
    rows = ingest(
        spark, jobs.YIXING, '{"tendency ":"1","tendency":"0","urlhash":"1"}', '{"tendency":"0","tendency ":"1","urlhash":"2"}'
    )
    for key in ("1", "2"):
        assert rows["yixing", key]["c1:tendency"] == "1"
        assert "c1:tendency " not in rows["yixing", key]
    old = ingest(spark, jobs.OLD_WEIBOUSER, {"id": "1", "insertime": "t", "gathertime": "2016-11-24 11:57:02"})
    assert old["weibouser", "1_1479988622000"]["c1:inserttime"] == "t"


def test_old_jobs(spark):
    gathered = {"urlhash": "1", "gathertime": "2016-11-24 11:57:02"}
    assert set(ingest(spark, jobs.OLD_FORUM, gathered)) == {("forum1", "1_1479988622000")}
    assert set(ingest(spark, jobs.OLD_FORUM, {"urlhash": "1"})) == {("forum1", f"1_{NOW_MS}")}
    assert reasons(ingest(spark, jobs.OLD_FORUM, {**gathered, "x": None})) == {"rows_0_0": "null_value"}
    assert set(ingest(spark, jobs.OLD_YIXING, {"urlhash": " 1 ", "gathertime": "2016-11-24 11:57:02"})) == {
        ("yixing", "1_1479988622000")
    }
    assert reasons(ingest(spark, jobs.OLD_YIXING, {"urlhash": "1", "gathertime": "soon"})) == {"rows_0_0": "bad_time"}
    assert set(ingest(spark, jobs.OLD_NEWSPAPER, {"urlhash": ""})) == {("paper", f"_{NOW_MS}")}
    compact = {"urlhash": "1", "gathertime": "20161124115702", "site_id": " ", "click": " "}
    row = ingest(spark, jobs.OLD_WEBPAGE, compact)["webpage", "1_1479988622000"]
    assert row["c1:click"] == "" and row["c1:site_id"] == " " and row["c1:group_id"] == "1"
    assert "c1:domain_1" not in row


def test_old_metasearch_snapshot_family(spark):
    base = {"id": "1", "gathertime": "2016-11-24 11:57:02"}
    padded = ingest(spark, jobs.OLD_METASEARCH, base)["metasearch", "1_1479988622000"]
    assert padded["c2:snapshot"] == "" and "c1:group_id" not in padded and "c1:domain_1" not in padded
    sent = ingest(spark, jobs.OLD_METASEARCH, {**base, "snapshot": "s", "stype": "0"})["metasearch", "1_1479988622000"]
    assert sent["c1:snapshot"] == "s" and "c2:snapshot" not in sent and sent["c1:group_id"] == "1"


def test_first_direct_projection(spark):
    full = {name: "v" for name in fixed.FIRST_JOB_FIELDS} | {"urlhash": "1", "author": " ", "sim_id": "s", "other": "o"}
    rows = ingest(spark, jobs.FIRST_DIRECT, full, {**full, "title": None})
    row = rows["newspaper3", f"1_{NOW_MS}"]
    assert row["c2:snapshot"] == "v" and row["c1:sim_id"] == "s"
    assert "c1:author" not in row and "c1:other" not in row
    assert reasons(rows) == {"rows_0_1": "no_title"}


def test_template_and_options():
    spec = jobs.zhimei("mobileclient").with_options(rate=5, interval=10, table="t")
    assert (spec.topics, spec.table, spec.rate, spec.interval) == (("mobileclient",), "t", 5, 10)
    assert jobs.topic_names(jobs.ZHIMEI_MIX, "crawl_") == ["crawl_blog", "crawl_paper", "crawl_ask-answer"]


def java_parts(text):
    """Split on the separator, empty parts at the end dropped."""
    parts = text.split("|||")
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_replies(spark):
    threads = ["a|||b|||c", "a||||||c", "|||", "", "x", "|||y", "a|||||", "z|||"]
    messages = [
        {"url": f"http://e.com/{i}", "urlhash": str(i), "kafkatime": "k", "replycontent": t}
        for i, t in enumerate(threads)
    ]
    rows = ingest(spark, jobs.REPLIES, *messages, {"urlhash": "n", "kafkatime": "k"}, {"replycontent": "q", "kafkatime": "k"})
    expected = {}
    every = defaultdict(list)
    for i, text in enumerate(threads):
        for floor, part in enumerate(java_parts(text), start=2):
            every[str(i)].append((floor, part))
            if part:
                expected["replies", f"{i}_{floor}"] = {
                    "c1:url": f"http://e.com/{i}#{floor}",
                    "c1:floorid": str(floor),
                    "c1:urlhash": str(i),
                    "c1:kafkatime": "k",
                    "c1:replycontent": part,
                }
    assert {k: v for k, v in rows.items() if k[0] != DEAD_LETTERS} == expected
    assert reasons(rows) == {"rows_0_8": "no_replycontent", "rows_0_9": "no_urlhash"}
    texts = [json.dumps(m) for m in messages]
    kept = jobs.REPLIES_ALL_PARTS.replies(from_rows(spark, texts), NOW)
    got = defaultdict(list)
    for r in kept.collect():
        got[r.urlhash].append((r.floorid, r.replycontent))
    assert {k: sorted(v) for k, v in got.items()} == dict(every)


def test_reply_without_url_and_time_name(spark):
    message = {"urlhash": "1", "kafkatime": "k", "replycontent": "a"}
    assert ingest(spark, jobs.REPLIES, message)["replies", "1_2"]["c1:url"] == "null#2"
    timed = ingest(spark, jobs.REPLIES_TIMED, message)["replies", "1_2"]
    assert timed["c1:inserttime"] == "k" and "c1:kafkatime" not in timed


def test_rekey(spark):
    full = {"url": "abc", "gathertime": "2016-11-24 11:57:02", "site_id": "5", "publishtime": "p"}
    samples = [full, {**full, "publishdate": "d", "gathertime": "x"}, {**full, "publishtime": None}, {**full, "url": None}]
    names = (*fixed.REKEY_FIELDS, "publishdate", "publishtime", "snapshot")
    df = spark.createDataFrame([tuple(s.get(n) for n in names) for s in samples], ", ".join(f"{n} string" for n in names))
    assert rekeyed_rows(df, zone="UTC").count() == 2
    rows = rows_by_key(cells_of_rows(judged_rekeyed_rows(df, zone="UTC"), "paper", "newspaper", NOW))
    dead = {r["c1:errmsg"]: json.loads(r["c1:record"]) for (table, _), r in rows.items() if table == "_dead_letter"}
    assert set(dead) == {"no_url", "no_publish_time"} and dead["no_publish_time"]["url"] == "abc"
    rows = {k: r for k, r in rows.items() if k[0] == "paper"}
    assert set(rows) == {("paper", "4952883123889572249_1479988622000"), ("paper", "4952883123889572249_0")}
    row = rows["paper", "4952883123889572249_0"]
    assert row["c1:publishtime"] == "d" and row["c1:urlhash"] == "4952883123889572249"
    assert row["c1:group_id"] == "1" and row["c2:snapshot"] == "" and row["c1:author"] == ""


def test_line_cells(spark):
    lines = spark.createDataFrame([("1,cf,name,jack",), ("2,cf",)], "value string")
    assert rows_by_key(line_cells(lines, "t")) == {("t", "1"): {"cf:name": "jack"}}
    people = spark.createDataFrame([("1,jack,15",), ("2,Lily,16",), ("x,y,z",)], "value string")
    assert rows_by_key(person_cells(people)) == {
        ("account", "1"): {"cf:name": "jack", "cf:age": "15"},
        ("account", "2"): {"cf:name": "Lily", "cf:age": "16"},
    }


def test_lookups_with_unknown_and_repeated_keys(spark):
    left = spark.createDataFrame([(1, "a", ""), (2, "b", "own"), (3, "c", None), (4, None, "")], "i int, k string, n string")
    dim = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "k string, v string")
    filled = fill_from_dimension(left, "n", "k", dim, "k", "v")
    assert {r.i: r.n for r in filled.collect()} == {1: "y", 2: "own", 3: "", 4: ""}
    looked = dimension_lookup(left, "k", dim, "k", "v", "found")
    assert {r.i: r.found for r in looked.collect()} == {1: "y", 2: "z", 3: None, 4: None}


def test_lookup_result_is_the_same_without_broadcast(spark):
    left = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    dim = spark.createDataFrame([("hot", "x")], "k string, v string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = dimension_lookup(left, "k", dim, "k", "v", "found")
        assert joined.where("found = 'x'").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_city_entries_are_whole_and_dealt_out(spark):
    subs = spark.range(5000).selectExpr(
        "id as sub_id", "if(id % 3 = 0, '1|2', '1||3') as city_code", "id as start_time", "id + 9000 as end_time"
    )
    rows = city_entries(valid_by_city(subs, F.lit(4500)), buckets=32).collect()
    got, lists = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.end_time == r.start_time + 9000 and r.city_code
        got[r.city].append(r.sub_id)
        lists[r.city, r.list_no].append((r.list_pos, r.sub_id))
    valid = range(0, 4500)
    assert {k: sorted(v) for k, v in got.items()} == {
        1: list(valid),
        2: [i for i in valid if i % 3 == 0],
        3: [i for i in valid if i % 3],
    }
    for entries in lists.values():
        entries.sort()
        assert [pos for pos, _ in entries] == list(range(1, len(entries) + 1)) and len(entries) < 250
        assert [sub for _, sub in entries] == sorted(sub for _, sub in entries)


def test_city_entries_keep_codes_that_are_no_number(spark):
    subs = spark.createDataFrame([(1, "x|2", 0, 9), (2, "y", 0, 9)], "sub_id long, city_code string, start_time long, end_time long")
    got = sorted((r.city or 0, r.sub_id) for r in city_entries(valid_by_city(subs, F.lit(5))).collect())
    assert got == [(0, 1), (0, 2), (2, 1)]


def test_a_hot_city_is_many_tasks_and_no_array(spark):
    subs = spark.range(20_000).selectExpr("id as sub_id", "if(id % 3 = 0, '7', string(id % 500)) as city_code", "0L as start_time", "9L as end_time")
    entries = city_entries(valid_by_city(subs, F.lit(5)))
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "collect_" not in plan
    sizes = entries.where("city = 7").groupBy("list_no").count().collect()
    assert len(sizes) == 64 and max(r["count"] for r in sizes) < 3 * 20_000 / 3 / 64


def test_codes(spark):
    df = spark.createDataFrame([("a|b||c|",)], "codes string")
    assert sorted(r.c for r in explode_codes(df, "codes", "c").collect()) == ["a", "b", "c"]


def test_website_documents(spark):
    sites = spark.createDataFrame([("5", "five")], "site_id string, site_name string")
    languages = spark.createDataFrame([("-5", "ru")], "site_id string, language string")
    sent = [
        {"url": "http://a.co.uk/1", "site_id": "5", "title": "null", "publishtime": "20161124115702"},
        {"url": "http://b.am/2", "site_id": "-5", "gathertime": "20161124"},
        {"url": "http://c.com/3", "site_id": "300001"},
        {"url": "http://d.com/4", "site_id": "", "group_id": "7", "language": "en"},
        {"url": "http://mp.weixin.qq.com/5", "site_id": "60001"},
        {"url": "http://e.com/6", "site_id": "9", "group_id": "11"},
        {"url": "http://f.com/7", "site_id": "x"},
    ]
    messages = from_rows(spark, [json.dumps(m) for m in sent])
    documents = website_documents(messages, sites, languages)
    by_url = {r.url: r for r in documents.collect()}
    assert {u[-1]: r["index"] for u, r in by_url.items()} == {
        "1": "zong/tests", "2": "weiwap/test", "3": "souye/sy", "4": "weiwap/test", "5": None, "6": None, "7": None,
    }
    one = by_url["http://a.co.uk/1"]
    assert (one.site_name, one.title, one.publishtime, one.domain_1) == ("five", "0^A", "2016-11-24 11:57:02", "a.co.uk")
    two = by_url["http://b.am/2"]
    assert (two.language, two.group_id, two.gathertime, two.domain_1) == ("ru", "7", "2016-11-24 00:00:00", "b.am")
    assert by_url["http://d.com/4"].language == "en"
    cells = rows_by_key(document_cells(judged_documents(messages, sites, languages), NOW))
    dead = [r["c1:errmsg"] for (table, _), r in cells.items() if table == "_dead_letter"]
    assert ("souye/sy", "http://c.com/3") in cells and len(cells) == 7 and dead == ["no_index"] * 3


def test_lines_become_messages(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([('{"urlhash":"1"}',), ('{"urlhash":"2"}',)], "value string").coalesce(1).write.text(path)
    messages = from_lines(spark.read.text(path), "forum")
    assert [r.offset for r in messages.orderBy("offset").collect()] == [0, 1]
    assert set(rows_by_key(jobs.FORUM.cells(messages, NOW))) == {("forum", "1"), ("forum", "2")}
