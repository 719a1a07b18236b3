"""Dimension tables that change while a stream runs.

A dimension is kept as numbered versions. A batch takes the newest version when it first runs and records that choice once
and for good, so that a batch that runs again joins the same rows, whatever has been published since.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlflow.sources.shared_files import SharedFiles


@dataclass(frozen=True)
class VersionedDimension:
    """Versions `<root>/rows/<attempt>` of one schema, named by `<root>/versions/<n>.json`."""

    spark: SparkSession
    root: str
    schema: str

    def publish(self, rows: DataFrame) -> int:
        """Store rows as the next version, unless they are those of the newest; the version's number.

        Rows are compared by their number and two sums of their hashes, so nothing is collected or sorted.
        """
        attempt = uuid.uuid4().hex
        names = self.spark.createDataFrame([], self.schema).columns
        rows.select(*names).write.parquet(f"{self.root}/rows/{attempt}")
        digest = self._digest(attempt)
        newest = self.newest()
        if newest is not None and self._told(newest)["digest"] == digest:
            self._files().delete(f"{self.root}/rows/{attempt}")
            return newest
        aside = f"{self.root}/aside/{attempt}.json"
        self._files().write_new(aside, json.dumps({"rows": attempt, "digest": digest}))
        number = 0 if newest is None else newest + 1
        while not self._files().move_new(aside, self._path(number)):
            number += 1  # another publisher took it
        return number

    def newest(self) -> int | None:
        numbers = [int(path.rpartition("/")[2].removesuffix(".json")) for path in self._files().glob(f"{self.root}/versions/*.json")]
        return max(numbers, default=None)

    def version(self, number: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/rows/{self._told(number)['rows']}")

    def of_batch(self, run: str, batch_id: int) -> DataFrame:
        """The version that a batch of a run joins: the newest when it first asked."""
        path = f"{self.root}/batches/{run}/{batch_id}.json"
        if not self._files().exists(path):
            newest = self.newest()
            if newest is None:
                raise ValueError(f"{self.root} has no version yet")
            aside = f"{self.root}/aside/{uuid.uuid4().hex}.json"
            self._files().write_new(aside, json.dumps({"version": newest}))
            self._files().move_new(aside, path)
        return self.version(self._json(path)["version"])

    def _digest(self, attempt: str) -> list[int]:
        stored = self.spark.read.schema(self.schema).parquet(f"{self.root}/rows/{attempt}")
        value = F.struct(*stored.columns)
        sums = [F.coalesce(F.sum(F.xxhash64(F.lit(salt), value).cast("decimal(38,0)")), F.lit(0)) for salt in ("a", "b")]
        return [int(v) for v in stored.agg(F.count(F.lit(1)), *sums).first()]

    def _path(self, number: int) -> str:
        return f"{self.root}/versions/{number}.json"

    def _files(self) -> SharedFiles:
        return SharedFiles(self.spark, self.root)

    def _json(self, path: str) -> dict:
        return json.loads(self.spark.read.text(path, wholetext=True).first()["value"])

    def _told(self, number: int) -> dict:
        return self._json(self._path(number))
