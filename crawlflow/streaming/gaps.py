"""Source data that expired before a stream could read it.

A message has a place: its topic, partition and offset. Each batch records the last place of every partition
beside the checkpoint, once and for good, so that a batch that runs again is compared with the same places.
Where a batch starts later than the batches before it ended, what lies between is gone at the source.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlflow.sources.shared_files import SharedFiles

MAX_PARTITIONS = 100_000


@dataclass(frozen=True)
class Gap:
    """Offsets `first` to `last` of a partition that no batch has read."""

    batch_id: int
    topic: str
    partition: int
    first: int
    last: int

    @property
    def messages(self) -> int:
        return self.last - self.first + 1


class LostDataError(RuntimeError):
    """A strict stream met a gap."""


@dataclass(frozen=True)
class Places:
    """Last offsets by batch, in a folder of the stream; `strict` streams fail at a gap, before they write.

    The places of all partitions pass through the driver, one row a partition of the source; their number is checked.
    """

    spark: SparkSession
    folder: str
    strict: bool = False

    def check(self, messages: DataFrame, batch_id: int) -> list[Gap]:
        """Compare a batch with the places before it and record its own; the gaps in front of it."""
        seen = (
            messages.groupBy("topic", "partition")
            .agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
            .limit(MAX_PARTITIONS + 1)
            .collect()
        )
        if len(seen) > MAX_PARTITIONS:
            raise ValueError(f"more than {MAX_PARTITIONS} partitions; these are no topics")
        before = self._before(batch_id)
        gaps = [
            Gap(batch_id, r["topic"], r["partition"], before[r["topic"], r["partition"]] + 1, r["first"] - 1)
            for r in sorted(seen, key=lambda r: (r["topic"], r["partition"]))
            if before.get((r["topic"], r["partition"]), r["first"]) + 1 < r["first"]
        ]
        if gaps and self.strict:
            raise LostDataError(f"{sum(g.messages for g in gaps)} messages are gone: {gaps[:10]}")
        after = before | {(r["topic"], r["partition"]): max(r["last"], before.get((r["topic"], r["partition"]), -1)) for r in seen}
        self._record(batch_id, after, gaps)
        return gaps

    def gaps(self) -> DataFrame:
        """topic, partition, first, last and messages of every gap so far."""
        gap = "batch_id long, topic string, partition int, first long, last long"
        if not self._files().exists(f"{self.folder}/places"):
            found = self.spark.createDataFrame([], gap)
        else:
            schema = "gaps array<struct<" + ", ".join(part.replace(" ", ": ") for part in gap.split(", ")) + ">>"
            found = self.spark.read.schema(schema).json(f"{self.folder}/places").select(F.inline("gaps"))
        return found.withColumn("messages", F.col("last") - F.col("first") + 1)

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/places/{batch_id:020d}.json"

    def _files(self) -> SharedFiles:
        return SharedFiles(self.spark, self.folder)

    def _batches(self) -> list[int]:
        return sorted(int(path.rpartition("/")[2].removesuffix(".json")) for path in self._files().glob(f"{self.folder}/places/*.json"))

    def _read(self, batch_id: int) -> dict:
        return json.loads(self.spark.read.text(self._path(batch_id), wholetext=True).first()["value"])

    def _before(self, batch_id: int) -> dict[tuple[str, int], int]:
        near = range(batch_id - 1, max(-1, batch_id - 9), -1)
        newest = next((n for n in near if self._files().exists(self._path(n))), None)
        if newest is None:  # the first batch, or one after many without messages
            newest = max((n for n in self._batches() if n < batch_id), default=None)
        return {} if newest is None else {(t, p): last for t, p, last in self._read(newest)["last"]}

    def _record(self, batch_id: int, last: dict[tuple[str, int], int], gaps: list[Gap]) -> None:
        files = self._files()
        if files.exists(self._path(batch_id)):
            return
        aside = f"{self.folder}/places-aside/{batch_id}.json"
        files.delete(aside)
        files.write_new(aside, json.dumps({"last": [[*k, v] for k, v in last.items()], "gaps": [asdict(g) for g in gaps]}))
        files.move_new(aside, self._path(batch_id))
