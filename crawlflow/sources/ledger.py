"""Plain tables that take each batch exactly once, rejects beside the rows.

Layout: `<root>/staged/run=<r>/batch_id=<n>/attempt=<a>/rejected=<b>/*.parquet` for the rows and
`<root>/ledger/run=<r>/batch_id=<n>.json` for the record that makes them visible.

* A batch is staged under a new attempt by one job, good rows and rejects in one pass; its counts come
  from that job.
* The record of the batch names the attempt. It is written aside and moved to its place, which fails where
  a record lies already: of two writers of a batch one is seen, whatever the other has staged.
* A batch that runs again finds its record and stages nothing. One that failed between stage and record is
  staged anew; what the failed attempt left is never read, and `vacuum` removes it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crawlflow.operators.judged import REASON, RECORD
from crawlflow.sources.keyed_store import folder_name
from crawlflow.sources.shared_files import SharedFiles

_PLACE = "run string, batch_id long, attempt string"
_LEDGER = f"{_PLACE}, n_read long, n_good long, n_rejected long"


@dataclass(frozen=True)
class BatchRecord:
    """A batch in the ledger; `n_read` counts what went into the plan, the others what came out."""

    run: str
    batch_id: int
    attempt: str
    n_read: int
    n_good: int
    n_rejected: int


@dataclass(frozen=True)
class LedgerTable:
    """A folder of rows of one schema (a DDL text), inserted batch by batch."""

    spark: SparkSession
    root: str
    schema: str

    def insert(self, judged: DataFrame, run: str, batch_id: int, source: Observation | None = None) -> BatchRecord | None:
        """Insert judged rows as a batch of a run; None where the batch is in the ledger already.

        `source` observed the rows that went into the plan as `n_read`, so that lost or multiplied rows show:
        good and rejected rows must be as many.
        """
        if self.record(run, batch_id) is not None:
            return None
        attempt = uuid.uuid4().hex
        self._stage(judged, run, batch_id, attempt, told := Observation())
        counts = {name: int(value or 0) for name, value in told.get.items()}
        n_read = int(source.get["n_read"]) if source is not None else sum(counts.values())
        record = BatchRecord(run, batch_id, attempt, n_read, **counts)
        if record.n_good + record.n_rejected != record.n_read:
            raise ValueError(f"batch {batch_id} of {run}: read {record.n_read} rows, {record.n_good} good and {record.n_rejected} rejected")
        return record if self._commit(record) else None

    def _stage(self, judged: DataFrame, run: str, batch_id: int, attempt: str, told: Observation) -> None:
        good = F.col(REASON).isNull()
        observed = judged.observe(told, F.count_if(good).alias("n_good"), F.count_if(~good).alias("n_rejected"))
        place = f"{self.root}/staged/run={folder_name(run)}/batch_id={batch_id}/attempt={attempt}"
        observed.withColumn("rejected", ~good).write.partitionBy("rejected").parquet(place)

    def _commit(self, record: BatchRecord) -> bool:
        """Move the record to its place; False where another writer's lies there."""
        aside = f"{self.root}/aside/{record.attempt}.json"
        self._files.write_new(aside, json.dumps(asdict(record)))
        if self._files.move_new(aside, self._ledger_path(record.run, record.batch_id)):
            return True
        self._files.delete(aside)
        return False

    def record(self, run: str, batch_id: int) -> BatchRecord | None:
        """The batch's record, if it is visible."""
        path = self._ledger_path(run, batch_id)
        if not self._files.exists(path):
            return None
        return BatchRecord(**json.loads(self.spark.read.text(path, wholetext=True).first()["value"]))

    def records(self) -> DataFrame:
        """run, batch_id, attempt, n_read, n_good and n_rejected of every visible batch."""
        if not self._exists("ledger"):
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).option("recursiveFileLookup", True).json(f"{self.root}/ledger")

    def rows(self) -> DataFrame:
        """All good rows of the visible batches."""
        return self._visible(False).select(*self._names())

    def rejects(self) -> DataFrame:
        """reason and record of all rejected rows of the visible batches."""
        return self._visible(True).select(F.col(REASON).alias("reason"), F.col(RECORD).alias("record"))

    def vacuum(self) -> int:
        """Remove what attempts without a record have left; how many there were. Only while nothing is inserted."""
        seen = {r["attempt"] for r in self.records().select("attempt").collect()}
        left = [path for path in self._files.glob(f"{self.root}/staged/run=*/batch_id=*/attempt=*") if path.rpartition("=")[2] not in seen]
        for path in left:
            self._files.delete(path)
        return len(left)

    def _visible(self, rejected: bool) -> DataFrame:
        whole = f"{self.schema}, {REASON} string, {RECORD} string, {_PLACE}, rejected boolean"
        if not self._exists("staged"):
            return self.spark.createDataFrame([], whole)
        staged = self.spark.read.schema(whole).option("basePath", f"{self.root}/staged").parquet(f"{self.root}/staged")
        place = ["run", "batch_id", "attempt"]
        return staged.where(F.col("rejected") == rejected).join(self.records().select(*place), place, "left_semi")

    def _names(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns

    def _ledger_path(self, run: str, batch_id: int) -> str:
        return f"{self.root}/ledger/run={folder_name(run)}/batch_id={batch_id}.json"

    @property
    def _files(self) -> SharedFiles:
        return SharedFiles(self.spark, self.root)

    def _exists(self, part: str) -> bool:
        return self._files.exists(f"{self.root}/{part}")
