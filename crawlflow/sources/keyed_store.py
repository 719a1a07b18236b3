"""Keyed tables on plain parquet: appended cells, merged when read.

Layout: `<root>/log/writer=<w>/run=<r>/batch_id=<n>/table=<t>/family=<f>/*.parquet`
for written batches and `<root>/base/writer=<t>/...` for a compacted table.

* A batch is written by one job, without a shuffle, for all tables at once.
* A run names a stream's checkpoint or one back-fill, so runs never share folders.
  A batch whose folder is taken is refused; as a replay it replaces that folder,
  so a replayed batch changes nothing.
* Column families lie in separate folders, so a read of the fields never touches
  the page snapshots, and row-key ranges and columns are pushed to parquet.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlflow.operators.cells import CELL_KEY, latest_cells, order_of, rows_of, rows_with_columns
from crawlflow.operators.judged import DEAD_LETTERS
from crawlflow.sources.shared_files import SharedFiles

_FILE_SCHEMA = (
    "rowkey string, qualifier string, value string, put_ms long, "
    "src_partition int, src_offset long, src_topic string, "
    "writer string, run string, batch_id long, table string, family string"
)


# Characters that a partition folder name holds as %XX.
_ESCAPED = set("\"#%'*/:=?\\{[]^")


def folder_name(table: str) -> str:
    """Table name as it reads in a folder name."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in table)


def _stored_key(writer: str, run: str, batch_id: int) -> Column:
    """Row key as stored: a dead letter's position is its own only within its batch."""
    dead = F.concat_ws("/", F.lit(writer), F.lit(run), F.lit(str(batch_id)), "rowkey")
    return F.when(F.col("table") == DEAD_LETTERS, dead).otherwise(F.col("rowkey"))


def epoch_ms(instant: datetime) -> int:
    if instant.tzinfo is None:
        instant = instant.replace(tzinfo=timezone.utc)
    return int(instant.timestamp() * 1000)


@dataclass(frozen=True)
class KeyedStore:
    """A folder of keyed tables."""

    spark: SparkSession
    root: str

    def append(
        self,
        cells: DataFrame,
        writer: str,
        batch_id: int,
        put_ms: int,
        *,
        run: str,
        replay: bool = False,
        max_records_per_file: int | None = None,
        even_files: bool = False,
    ) -> None:
        """Write the cells of one batch of a run.

        A batch that was written before is refused, unless it is a `replay`: then
        it replaces the first one. Streams always replay, as the checkpoint tells
        their batches apart; a back-fill that failed half way is run again as one.
        Dead letters get the writer, run and batch in their row key.
        `even_files` adds one shuffle that gathers the small files of a small
        batch and splits large ones, whatever the skew between tables.
        """
        positions = {"src_partition": "int", "src_offset": "long", "src_topic": "string"}
        for name, kind in positions.items():
            if name not in cells.columns:
                cells = cells.withColumn(name, F.lit("" if kind == "string" else 0).cast(kind))
        out = cells.select(
            _stored_key(writer, run, batch_id).alias("rowkey"),
            "qualifier",
            "value",
            F.lit(put_ms).cast("long").alias("put_ms"),
            *[F.col(name).cast(kind).alias(name) for name, kind in positions.items()],
            "table",
            "family",
        )
        if even_files:
            out = out.hint("rebalance", "table", "family")
        write = out.write.mode("overwrite" if replay else "errorifexists").partitionBy("table", "family")
        if max_records_per_file:
            write = write.option("maxRecordsPerFile", max_records_per_file)
        write.parquet(self._batch_folder(writer, run, batch_id))

    def has_batch(self, writer: str, run: str, batch_id: int) -> bool:
        """Whether the batch has a folder, finished or not."""
        return SharedFiles(self.spark, self.root).exists(self._batch_folder(writer, run, batch_id))

    def _batch_folder(self, writer: str, run: str, batch_id: int) -> str:
        return f"{self.root}/log/writer={folder_name(writer)}/run={folder_name(run)}/batch_id={batch_id}"

    def cells(
        self,
        table: str,
        columns: Iterable[str] | None = None,
        families: Iterable[str] | None = None,
        start: str | None = None,
        stop: str | None = None,
    ) -> DataFrame:
        """Stored cells of a table, every write of them.

        Only the folders of the table (and of the asked families) are listed and
        read; columns and the row-key range [start, stop) become parquet filters.
        """
        limits = {"columns": columns, "families": families, "start": start, "stop": stop}
        parts = [self._scan(part, table, **limits) for part in self._parts(table)]
        return reduce(DataFrame.unionByName, parts)

    def _parts(self, table: str) -> list[str]:
        """Folders that hold cells of a table; the log where there are none yet."""
        return [p for p in ("base", "log") if self._readable(p, table)] or ["log"]

    def _read(self, part: str, table: str, family: str = "*") -> DataFrame:
        pattern = f"{self.root}/{part}/writer=*/run=*/batch_id=*/table={folder_name(table)}/family={family}"
        reader = self.spark.read.schema(_FILE_SCHEMA).option("basePath", f"{self.root}/{part}")
        return reader.parquet(pattern)

    def _readable(self, part: str, table: str, family: str = "*") -> bool:
        """Whether any batch wrote to the families: one listing of folders, no read."""
        pattern = f"{self.root}/{part}/writer=*/run=*/batch_id=*/table={folder_name(table)}/family={family}"
        return bool(SharedFiles(self.spark, self.root).glob(pattern))

    def _scan(
        self,
        part: str,
        table: str,
        columns: Iterable[str] | None = None,
        families: Iterable[str] | None = None,
        start: str | None = None,
        stop: str | None = None,
    ) -> DataFrame:
        family = "{" + ",".join(families) + "}" if families else "*"
        if family == "*" or self._readable(part, table, family):
            found = self._read(part, table, family)
        else:  # none of the families is there
            found = self._read(part, table).where(F.lit(False))
        if columns is not None:
            found = found.where(F.col("qualifier").isin(list(columns)))
        if start is not None:
            found = found.where(F.col("rowkey") >= start)
        if stop is not None:
            found = found.where(F.col("rowkey") < stop)
        return found

    def exists(self, table: str) -> bool:
        """True when some batch wrote to the table."""
        return any(self._readable(part, table) for part in ("base", "log"))

    def latest(self, table: str, **scan) -> DataFrame:
        """Current value of every cell; takes the same limits as `cells`.

        A compacted table has one row per cell already. Only the cells written
        since are merged then, together with the compacted cells they meet; the
        rest passes through without a shuffle while the log's measured size lets
        Spark broadcast its keys, and through a sort-merge join beyond that.
        """
        parts = self._parts(table)
        if len(parts) == 1 and parts[0] == "log":
            return latest_cells(self._scan("log", table, **scan))
        base = self._scan("base", table, **scan)
        if "log" not in parts:
            return base.select(*CELL_KEY, "value")
        added = self._scan("log", table, **scan)
        keys = added.select(*CELL_KEY).distinct()
        met = base.join(keys, list(CELL_KEY), "left_semi")
        untouched = base.join(keys, list(CELL_KEY), "left_anti").select(*CELL_KEY, "value")
        return untouched.unionByName(latest_cells(added.unionByName(met)))

    def rows(self, table: str, **scan) -> DataFrame:
        """Current rows: the maps `c1` and `c2`, and a map of maps with all other families."""
        return rows_of(self.latest(table, **scan))

    def columns(self, table: str, names: Iterable[str], **scan) -> DataFrame:
        """Current values of a few columns, side by side."""
        picked = list(names)
        return rows_with_columns(self.cells(table, columns=picked, **scan), picked)

    def compact(self, target: KeyedStore, table: str, partitions: int | None = None) -> None:
        """Write the current cells of a table into another store, sorted by row key.

        The files of the target hold disjoint row-key ranges, so a range read
        opens only the files it needs. Repeated writes are merged before the
        range shuffle, and a very wide row may span files, so neither a key with
        many writes nor one with many columns fills one task.
        """
        stored = self.cells(table)
        merged = stored.withColumn("order", order_of(stored)).groupBy("table", "rowkey", "family", "qualifier").agg(
            F.max_by("value", "order").alias("value"),
            F.max("put_ms").alias("last_put_ms"),
        )
        by = [F.col("rowkey"), F.col("qualifier")]
        ranged = (
            merged.repartitionByRange(partitions, *by) if partitions else merged.repartitionByRange(*by)
        )
        out = ranged.sortWithinPartitions("table", "family", "rowkey", "qualifier").select(
            "rowkey",
            "qualifier",
            "value",
            F.col("last_put_ms").alias("put_ms"),
            F.lit(0).cast("int").alias("src_partition"),
            F.lit(0).cast("long").alias("src_offset"),
            F.lit("").alias("src_topic"),
            "table",
            "family",
        )
        out.write.mode("overwrite").partitionBy("table", "family").parquet(
            f"{target.root}/base/writer={folder_name(table)}/run=compacted/batch_id=0"
        )
