"""Re-key a stored table: new row keys and a fixed set of columns.

Reads the rows of one keyed table and writes them under URL-hash keys into
another, as cells, so the result goes through the same store.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlflow.fixed_values import REKEY_FIELDS, SNAPSHOT
from crawlflow.functions.groups import site_group, whole_number
from crawlflow.functions.hashing import xxh64
from crawlflow.functions.keys import row_key
from crawlflow.functions.times import dashed_millis, millis_text
from crawlflow.operators.cells import family_of
from crawlflow.operators.judged import REASON, RECORD, good_rows, judged_cells, judged_columns
from crawlflow.operators.records import held, text_map
from crawlflow.sources.keyed_store import KeyedStore, epoch_ms

SOURCE_COLUMNS = (*REKEY_FIELDS, "publishdate", "publishtime", SNAPSHOT)


def judged_rekeyed_rows(
    rows: DataFrame, default_group: str = "5", zone: str | None = None, source_key: str | None = None
) -> DataFrame:
    """A row per stored row: the new key and columns, or why it gets none.

    `rows` has one column per source column, null where nothing is stored. Rows
    without a URL or a publish time are rejected, with the source's columns (but
    for the snapshot) as their record; other missing columns become ''. A gather
    time that cannot be read gives time '0' in the key. `source_key` names the column
    kept as `src_topic`, which orders rows that get the same new key.
    """
    staged = held(
        rows.withColumns(
            {
                "_hash": xxh64(F.col("url")),
                "_site": whole_number(F.col("site_id")),
                "_ms": millis_text(dashed_millis(F.col("gathertime"), zone), "0"),
                "_publish": F.coalesce("publishdate", "publishtime"),
            }
        )
    )
    reason = F.when(F.col("_hash") == 0, "no_url").when(F.col("_publish").isNull(), "no_publish_time")
    told = [c for c in rows.columns if c != SNAPSHOT]
    return staged.select(
        row_key(F.col("_hash"), F.col("_ms")).alias("rowkey"),
        *[F.coalesce(name, F.lit("")).alias(name) for name in REKEY_FIELDS],
        F.col("_hash").cast("string").alias("urlhash"),
        F.col("_publish").alias("publishtime"),
        site_group(F.col("_site"), F.col("url"), default_group).alias("group_id"),
        F.coalesce(SNAPSHOT, F.lit("")).alias(SNAPSHOT),
        F.lit("").alias("author"),
        F.lit("").alias("sim_id"),
        *([F.col(source_key).alias("src_topic")] if source_key else []),
        *judged_columns(reason, F.to_json(F.struct(*told))),
    )


def rekeyed_rows(
    rows: DataFrame, default_group: str = "5", zone: str | None = None, source_key: str | None = None
) -> DataFrame:
    """The stored rows that get a new key, with it and their columns."""
    return good_rows(judged_rekeyed_rows(rows, default_group, zone, source_key))


def cells_of_rows(judged: DataFrame, table: str, source: str, time: datetime) -> DataFrame:
    """Cells of judged rows with a `rowkey` and one column per field; rejects become dead letters."""
    names = [c for c in judged.columns if c not in ("rowkey", "src_topic", REASON, RECORD)]
    fields = text_map({name: F.col(name) for name in names})
    return judged_cells(judged, table, fields, family_of(F.col("qualifier")), source, time)


def rekey_table(
    source: KeyedStore,
    target: KeyedStore,
    put_time: datetime,
    in_table: str = "newspaper",
    out_table: str = "paper",
    max_records_per_file: int | None = None,
    zone: str | None = None,
    *,
    run: str,
    replay: bool = False,
) -> None:
    """Re-key a whole table in one job, as the run `run` of the target.

    Of source rows that get the same new key, the one with the largest source key wins. Rows
    that get none go to the target's dead letters in the same job.
    """
    rows = source.columns(in_table, SOURCE_COLUMNS)
    target.append(
        cells_of_rows(judged_rekeyed_rows(rows, zone=zone, source_key="rowkey"), out_table, in_table, put_time),
        writer=f"rekey-{in_table}-{out_table}",
        batch_id=0,
        put_ms=epoch_ms(put_time),
        run=run,
        replay=replay,
        max_records_per_file=max_records_per_file,
    )
