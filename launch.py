"""Start a job: spark-submit launch.py JOB --store ...

Ingest jobs and `website` read Kafka (--servers, --partitions) and need its connector on the class path; `access_log`
reads a folder of log lines (--lines) into a plain table; `rekey` re-keys a stored table once. The checkpoint
lies in the folder that spark.checkpoint.dir names, or in the one given.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from crawlflow.plans.access_log import RECORD_SCHEMA, judged_access_records
from crawlflow.plans.registry import JOBS, old_zhimei, zhimei
from crawlflow.plans.rekey import rekey_table
from crawlflow.plans.website import LANGUAGE_SCHEMA, SITE_SCHEMA, WebsiteSpec
from crawlflow.session import checkpoint_root, configure
from crawlflow.sources.dimensions import VersionedDimension
from crawlflow.sources.keyed_store import KeyedStore
from crawlflow.sources.ledger import LedgerTable
from crawlflow.sources.messages import stream_text
from crawlflow.streaming.gaps import Places
from crawlflow.streaming.runs import run_inserts, run_stream, run_topics, topics_of

TEMPLATES = {"zhimei": zhimei, "old_zhimei": old_zhimei}
#: What the jobs without a spec of their own must be given.
NEEDED = {"website": ("servers", "partitions", "sites", "languages"), "access_log": ("lines",), "rekey": ("target", "run")}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=sorted([*JOBS, *TEMPLATES, *NEEDED]))
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--store", required=True, help="folder of the tables")
    parser.add_argument("--topic-prefix", default="")
    parser.add_argument("--topic", help="topic of the job templates zhimei and old_zhimei")
    parser.add_argument("--rate", type=int, help="messages per partition and second")
    parser.add_argument("--interval", type=int, help="seconds between batches")
    parser.add_argument("--table", help="target table instead of the job's own; of rekey: the table that is read")
    parser.add_argument("--partitions", type=int, help="partitions of all the job's topics together")
    parser.add_argument("--records-per-file", type=int, help="most cells of a stored file")
    parser.add_argument("--checkpoint")
    parser.add_argument("--zone", help="time zone of the time texts")
    parser.add_argument("--stream-per-topic", action="store_true", help="a stream and checkpoint a topic: topics may be added later")
    parser.add_argument("--strict", action="store_true", help="fail where messages expired before they were read")
    parser.add_argument("--sites", help="website: folder of the versioned site names")
    parser.add_argument("--languages", help="website: folder of the versioned site languages")
    parser.add_argument("--lines", help="access_log: folder of log lines")
    parser.add_argument("--available-now", action="store_true", help="access_log: read what is there and stop")
    parser.add_argument("--target", help="rekey: folder of the tables that are written")
    parser.add_argument("--target-table", default="paper", help="rekey: table that is written")
    parser.add_argument("--run", help="rekey: name of the run")
    args = parser.parse_args(argv)
    missing = [name for name in NEEDED.get(args.job, ("servers", "partitions")) if getattr(args, name) is None]
    if missing:
        parser.error(f"{args.job} needs " + ", ".join(f"--{name}" for name in missing))
    return args


def spec_of(args: argparse.Namespace):
    spec = TEMPLATES[args.job](args.topic) if args.job in TEMPLATES else JOBS[args.job]
    changes = {name: getattr(args, name) for name in ("rate", "interval", "table") if getattr(args, name)}
    return spec.with_options(**changes)


def website_spec(spark: SparkSession, args: argparse.Namespace) -> WebsiteSpec:
    sites = VersionedDimension(spark, args.sites, SITE_SCHEMA)
    languages = VersionedDimension(spark, args.languages, LANGUAGE_SCHEMA)
    changes = {name: getattr(args, name) for name in ("rate", "interval") if getattr(args, name)}
    return WebsiteSpec(sites, languages, **changes)


def start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Run the job, or start it; its streams."""
    store = KeyedStore(spark, args.store)
    if args.job == "rekey":
        names = {"in_table": args.table or "newspaper", "out_table": args.target_table, "zone": args.zone}
        rekey_table(store, KeyedStore(spark, args.target), datetime.now(timezone.utc), run=args.run, max_records_per_file=args.records_per_file, **names)
        return []
    if args.job == "access_log":
        table = LedgerTable(spark, f"{args.store}/{args.table or 'access_log'}", RECORD_SCHEMA)
        checkpoint = args.checkpoint or f"{checkpoint_root(spark)}/access_log"
        lines = stream_text(spark, args.lines)
        return [run_inserts(lines, judged_access_records, table, checkpoint, args.interval or 5, args.available_now)]
    spec = website_spec(spark, args) if args.job == "website" else spec_of(args)
    kafka = topics_of(spec, args.servers, args.topic_prefix, partitions=args.partitions)
    options = {"zone": args.zone, "max_records_per_file": args.records_per_file}
    checkpoint = args.checkpoint or f"{checkpoint_root(spark)}/{spec.name}"
    if args.stream_per_topic:
        sources = {topic: kafka.only(topic).read_stream(spark) for topic in kafka.topics}
        return list(run_topics(spec, sources, store, checkpoint, **options).values())
    places = Places(spark, f"{checkpoint}-places", args.strict)
    return [run_stream(spec, kafka.read_stream(spark), store, checkpoint, places=places, **options)]


def main() -> None:
    args = arguments()
    spark = configure(SparkSession.builder.appName(args.job).getOrCreate())
    for query in start(spark, args):
        query.awaitTermination()


if __name__ == "__main__":
    main()
