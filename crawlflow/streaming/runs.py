"""Run an ingest job over a batch or a stream of messages.

Both ways call the same plan. A stream hands each micro-batch to the store under
the id that its checkpoint holds and the batch id; the checkpoint records the batch
only after the write, and a batch that runs again replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlflow.plans.registry import topic_names
from crawlflow.plans.spec import Spec
from crawlflow.session import checkpoint_root, configure
from crawlflow.sources.keyed_store import KeyedStore, epoch_ms
from crawlflow.sources.ledger import LedgerTable
from crawlflow.sources.messages import KafkaTopics
from crawlflow.streaming.gaps import Places


def topics_of(spec: Spec, servers: str, prefix: str = "", *, partitions: int, **options) -> KafkaTopics:
    """Kafka subscription of a job, with its start, message size and rate limit.

    `partitions` is the number of partitions of all its topics: the rate is one partition's.
    """
    own = {"earliest": spec.start == "earliest", "max_message_bytes": spec.max_message_bytes}
    return KafkaTopics(
        servers,
        topic_names(spec, prefix),
        rate_per_partition=spec.rate,
        interval_seconds=spec.interval,
        partitions=partitions,
        **{**own, **options},
    )


def run_batch(
    spec: Spec,
    messages: DataFrame,
    store: KeyedStore,
    ingest_time: datetime,
    batch_id: int = 0,
    zone: str | None = None,
    max_records_per_file: int | None = None,
    even_files: bool = False,
    *,
    run: str,
    replay: bool = False,
) -> None:
    """Ingest a whole DataFrame of messages as one batch of the back-fill `run`.

    A batch id that the run has written is refused, unless this is a `replay` of it.
    """
    store.append(
        spec.cells(messages, ingest_time, zone),
        writer=spec.name,
        batch_id=batch_id,
        put_ms=epoch_ms(ingest_time),
        run=run,
        replay=replay,
        max_records_per_file=max_records_per_file,
        even_files=even_files,
    )


def batch_writer(
    spec: Spec,
    store: KeyedStore,
    zone: str | None = None,
    now: Callable[[], datetime] | None = None,
    even_files: bool = False,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    max_records_per_file: int | None = None,
    places: Places | None = None,
) -> Callable[[DataFrame, int], None]:
    """Function for `foreachBatch`: ingest one micro-batch.

    Only a batch that runs again is first asked whether it is empty, its source having expired: it leaves what
    it wrote. A new empty batch writes no cells; to ask each batch would cost a job of its own.
    The run is the stream's id, which its checkpoint keeps over restarts.
    `prepare` turns the rows of the source into messages, such as `from_lines`.
    `places` looks for messages that expired before the batch. A spec with `for_batch`
    is asked for the spec of each batch, as its dimensions may have changed.
    """
    clock = now or (lambda: datetime.now(timezone.utc))

    def write(messages: DataFrame, batch_id: int) -> None:
        run = stream_run(messages)
        if store.has_batch(spec.name, run, batch_id) and messages.isEmpty():
            return
        batch = prepare(messages) if prepare else messages
        if places:
            places.check(batch, batch_id)
        own = spec.for_batch(run, batch_id) if hasattr(spec, "for_batch") else spec
        run_batch(own, batch, store, clock(), batch_id, zone, max_records_per_file, even_files, run=run, replay=True)

    return write


def stream_run(batch: DataFrame) -> str:
    """The id that a stream's checkpoint keeps, seen from inside `foreachBatch`."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def run_stream(
    spec: Spec,
    messages: DataFrame,
    store: KeyedStore,
    checkpoint: str | None = None,
    available_now: bool = False,
    zone: str | None = None,
    now: Callable[[], datetime] | None = None,
    even_files: bool = True,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    max_records_per_file: int | None = None,
    places: Places | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start the job on a stream, every `spec.interval` seconds or once over all there is.

    The checkpoint lies in the cluster's checkpoint folder unless one is given.
    """
    spark = configure(messages.sparkSession)
    location = checkpoint or f"{checkpoint_root(spark)}/{name or spec.name}"
    writer = (
        messages.writeStream.queryName(name or spec.name)
        .option("checkpointLocation", location)
        .foreachBatch(batch_writer(spec, store, zone, now, even_files, prepare, max_records_per_file, places))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{spec.interval or 60} seconds")
    return writer.start()


def run_topics(
    spec: Spec, sources: Mapping[str, DataFrame], store: KeyedStore, checkpoint: str | None = None, **options
) -> dict[str, StreamingQuery]:
    """Start the job on several topics, each a stream with its own checkpoint, all into one store.

    A checkpoint holds a fixed set of sources. With one a topic, topics can be added to a job that has run, or
    left out of it for a while, and the others go on where they were.
    """
    spark = configure(store.spark)
    root = checkpoint or f"{checkpoint_root(spark)}/{spec.name}"
    return {
        topic: run_stream(spec, messages, store, f"{root}/{topic}", name=f"{spec.name}-{topic}", **options)
        for topic, messages in sources.items()
    }


def run_inserts(
    rows: DataFrame,
    judge: Callable[[DataFrame], DataFrame],
    table: LedgerTable,
    checkpoint: str,
    seconds: int = 5,
    available_now: bool = False,
) -> StreamingQuery:
    """Judge every micro-batch and insert its rows and rejects into a plain table, exactly once.

    `judge` gives judged rows, such as `judged_access_records`. What a batch read is counted as it passes.
    """

    def insert(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            read = Observation()
            table.insert(judge(df.observe(read, F.count(F.lit(1)).alias("n_read"))), stream_run(df), batch_id, read)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(insert)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def run_rows(
    rows: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], None],
    checkpoint: str,
    seconds: int = 5,
    available_now: bool = False,
) -> StreamingQuery:
    """Transform every micro-batch and hand it to a table writer, such as `write_jdbc`.

    For tables outside of Spark's reach, such as a database: a batch that fails after its write
    is written again, and the writer decides what a repeated row means. `run_inserts` inserts once.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            write(transform(df))

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def print_stream(lines: DataFrame, seconds: int = 10, available_now: bool = False) -> StreamingQuery:
    """Show the rows of a stream on the console."""
    writer = lines.writeStream.format("console").option("truncate", "false")
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()
