"""Every registered query against its SQL, on the smallest given tables."""

import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import launch
from bench import HEADLINE
from check import TABLES, rows
from crawlflow.catalog.queries import queries


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(queries()) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert set(HEADLINE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, sf, db, name):
    df = entry.queries()[name](spark, sf)
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = rows(columns, result.fetchall())
    assert sorted(columns) == sorted(df.columns)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert sum(got.values()) > 0
    assert got == expected


def test_entry(spark):
    assert Counter(r.target for r in entry.entry(spark).collect()).keys() == {"webpage", "homepage"}


def test_launch_arguments():
    args = launch.arguments(["zhimei", "--servers", "a:1", "--store", "/s", "--partitions", "4", "--topic", "blog", "--rate", "9", "--table", "t"])
    spec = launch.spec_of(args)
    assert (spec.topics, spec.rate, spec.interval, spec.table) == (("blog",), 9, 65, "t")


def test_launch_needs_what_a_job_reads(capsys):
    for job, given in (("forum", []), ("website", ["--servers", "a:1", "--partitions", "2"]), ("access_log", []), ("rekey", ["--target", "/t"])):
        with pytest.raises(SystemExit):
            launch.arguments([job, "--store", "/s", *given])
        assert f"{job} needs --" in capsys.readouterr().err


def test_launch_access_log_and_rekey(spark, tmp_path):
    from crawlflow.plans.access_log import RECORD_SCHEMA
    from crawlflow.sources.keyed_store import DEAD_LETTERS, KeyedStore
    from crawlflow.sources.ledger import LedgerTable

    parts = ["-"] * 31
    parts[0], parts[1], parts[9], parts[18], parts[25], parts[29] = "u", "m", "77", "0", "null", "d1"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("\t".join(parts) + "\nshort\n")
    args = launch.arguments(["access_log", "--store", str(tmp_path / "s"), "--lines", str(tmp_path / "in"), "--checkpoint", str(tmp_path / "ck"), "--available-now"])
    for query in launch.start(spark, args):
        query.awaitTermination()
    table = LedgerTable(spark, str(tmp_path / "s" / "access_log"), RECORD_SCHEMA)
    assert [tuple(r) for r in table.rows().collect()] == [(77, "m", "u", "d1", "di")] and table.rejects().count() == 1

    old = KeyedStore(spark, str(tmp_path / "old"))
    cells = [("t", "k", "c1", "url", "abc"), ("t", "k", "c1", "publishtime", "p"), ("t", "l", "c1", "url", "abd")]
    old.append(spark.createDataFrame(cells, "table string, rowkey string, family string, qualifier string, value string"), "w", 0, 1, run="r")
    args = launch.arguments(["rekey", "--store", str(tmp_path / "old"), "--target", str(tmp_path / "new"), "--run", "one", "--table", "t", "--zone", "UTC"])
    assert launch.start(spark, args) == []
    new = KeyedStore(spark, str(tmp_path / "new"))
    assert [r.publishtime for r in new.columns("paper", ["publishtime"]).collect()] == ["p"]
    assert [r.errmsg for r in new.columns(DEAD_LETTERS, ["errmsg"]).collect()] == ["no_publish_time"]


def test_launch_website_spec_and_topics(spark):
    args = launch.arguments(["website", "--store", "/s", "--servers", "a:1", "--partitions", "4", "--sites", "/d/s", "--languages", "/d/l", "--rate", "3"])
    spec = launch.website_spec(spark, args)
    assert (spec.rate, spec.interval, spec.sites.root, spec.languages.root) == (3, 60, "/d/s", "/d/l")
    kafka = launch.topics_of(launch.JOBS["zhimei_mix"], "a:1", "x_", partitions=6)
    one = kafka.only(kafka.topics[0]).options()
    assert one["subscribe"] == kafka.topics[0] and int(one["maxOffsetsPerTrigger"]) * 3 == int(kafka.options()["maxOffsetsPerTrigger"])


HIDDEN = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == NAME or name.startswith(NAME + '.'):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
names = set(entry.queries())
assert len(names) > 90 and names == set(entry.oracle_sql()) and not any(n.startswith("op") for n in names), len(names)
"""


@pytest.mark.parametrize("name", ["zstandard", "regex", "public_tokenizers", "corpus_pipeline", "crawlflow.llm"])
def test_entry_without_what_the_training_data_package_needs(name):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run([sys.executable, "-c", f"NAME = {name!r}\n{HIDDEN}"], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
