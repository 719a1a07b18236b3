"""Message sources: Kafka topics, folders of message files, text, in-memory rows.

Every source gives the same columns, so a plan does not see where its messages
come from.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = (
    "key string, value string, topic string, partition int, offset long, timestamp timestamp"
)
MESSAGE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")


@dataclass(frozen=True)
class KafkaTopics:
    """Kafka subscription. Positions live in the stream's checkpoint once it has run."""

    servers: str
    topics: Sequence[str]
    earliest: bool = True
    rate_per_partition: int | None = None
    interval_seconds: int | None = None
    partitions: int = 1
    max_message_bytes: int = 10485760
    fail_on_lost_data: bool = False
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        """Reader options. A rate is given per partition and second, Spark wants one per batch."""
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": ",".join(self.topics),
            "startingOffsets": "earliest" if self.earliest else "latest",
            "failOnDataLoss": str(self.fail_on_lost_data).lower(),
            "kafka.max.partition.fetch.bytes": str(self.max_message_bytes),
        }
        if self.rate_per_partition and self.interval_seconds:
            per_batch = self.rate_per_partition * self.interval_seconds * self.partitions
            options["maxOffsetsPerTrigger"] = str(per_batch)
        return {**options, **self.extra}

    def only(self, topic: str) -> KafkaTopics:
        """The same subscription of one of its topics, with an equal share of the rate."""
        return replace(self, topics=[topic], partitions=max(1, self.partitions // len(self.topics)))

    def read_stream(self, spark: SparkSession) -> DataFrame:
        """Streaming messages; needs the Kafka connector on the class path."""
        return kafka_columns(spark.readStream.format("kafka").options(**self.options()).load())

    def read_batch(self, spark: SparkSession) -> DataFrame:
        """All messages now in the topics, for a back-fill."""
        options = {k: v for k, v in self.options().items() if k != "maxOffsetsPerTrigger"}
        options["startingOffsets"] = "earliest"
        return kafka_columns(spark.read.format("kafka").options(**options).load())


def kafka_columns(raw: DataFrame) -> DataFrame:
    """Kafka's binary key and value as text."""
    return raw.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def land_messages(messages: DataFrame, folder: str, rows_per_file: int, mode: str = "append") -> None:
    """Write messages as files of at most `rows_per_file` rows, which a stream can then admit by rows."""
    messages.select(*MESSAGE_COLUMNS).write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(folder)


def files_for(rows: int, rows_per_file: int) -> int:
    """How many files of at most `rows_per_file` rows hold no more than `rows`."""
    if rows < rows_per_file:
        raise ValueError(f"a file of {rows_per_file} rows does not fit {rows} rows")
    return rows // rows_per_file


def stream_message_files(
    spark: SparkSession,
    folders: str | Iterable[str],
    max_files: int | None = None,
    *,
    max_rows: int | None = None,
    rows_per_file: int | None = None,
    after_read: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Stream of parquet message files from one folder per topic.

    `max_rows` caps a batch by messages, as rate x interval x partitions does for Kafka; it needs
    `rows_per_file`, the most that `land_messages` put in a file. With several folders each is a source
    and gets an equal share of the cap. `after_read` is `delete` or `archive` (to the folder `archive`) for files
    that a finished batch has read. Files that expire before they are read are left out; `Places` counts them.
    """
    paths = [folders] if isinstance(folders, str) else list(folders)
    if max_rows is not None:
        if rows_per_file is None:
            raise ValueError("max_rows needs rows_per_file")
        max_files = min(files_for(max_rows // len(paths), rows_per_file), max_files or max_rows)

    def one(folder: str) -> DataFrame:
        reader = spark.readStream.schema(MESSAGE_SCHEMA)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        if after_read:
            reader = reader.option("cleanSource", after_read)
        if archive:
            reader = reader.option("sourceArchiveDir", archive)
        return reader.option("ignoreMissingFiles", True).parquet(folder)

    return reduce(DataFrame.unionByName, [one(path) for path in paths])


def read_message_files(spark: SparkSession, folders: str | Iterable[str]) -> DataFrame:
    """Batch read of parquet message files from any number of folders."""
    paths = [folders] if isinstance(folders, str) else list(folders)
    return spark.read.schema(MESSAGE_SCHEMA).parquet(*paths)


def from_lines(lines: DataFrame, topic: str) -> DataFrame:
    """Messages of a DataFrame with one JSON text per row in `value`.

    Offsets follow the order inside each partition of the read.
    """
    position = F.monotonically_increasing_id()
    return lines.select(
        F.lit(None).cast("string").alias("key"),
        F.col("value"),
        F.lit(topic).alias("topic"),
        F.spark_partition_id().alias("partition"),
        position.bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


def read_text_messages(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Messages of text files, one JSON object per line."""
    return from_lines(spark.read.text(path), topic)


def stream_text(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of the lines of new text files in a folder."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def from_rows(spark: SparkSession, values: Iterable[str], topic: str = "rows") -> DataFrame:
    """Messages of a few values held in memory."""
    rows = [(None, value, topic, 0, i, None) for i, value in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)
