"""Declarative ingest specs and their one Spark plan.

A spec says which fields a message must have, how its row key is built, which
columns are derived and to which table it goes. `IngestSpec.cells` turns messages
into cells in a single narrow stage: parse, derive, pad, explode. There is no
shuffle, no second parse and no Python per row, in batch and in streaming alike.
Messages that cannot be stored become cells of the dead-letter table in the same
pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.fixed_values import SNAPSHOT
from crawlflow.functions.domains import host
from crawlflow.functions.groups import whole_number
from crawlflow.functions.keys import row_key
from crawlflow.functions.texts import is_blank
from crawlflow.operators.cells import clean_value, explode_fields, family_of
from crawlflow.operators.explode import explode_replies, floor_url
from crawlflow.operators.records import (
    empty_map,
    field as map_field,
    has_field,
    held,
    padded,
    text_map,
    with_records,
)
from crawlflow.sources.keyed_store import DEAD_LETTERS, epoch_ms


class Record:
    """The fields of one message and the processing time, as columns.

    Every value a rule asks for becomes a column of its own before the rules
    run, so a field that ten rules read is looked up once.
    """

    def __init__(self, zone: str | None = None):
        self.fields = F.col("fields")
        self.ingest_ms = F.col("_ingest_ms")
        self.ingest_time = F.col("_ingest_time")
        self.zone = zone
        self.found: dict[str, Column] = {}
        self.computed: dict[str, Column] = {}

    def get(self, name: str) -> Column:
        """'' for JSON null, null for a missing field."""
        self.found[f"_f_{name}"] = map_field(self.fields, name)
        return F.col(f"`_f_{name}`")

    def has(self, name: str) -> Column:
        self.found[f"_h_{name}"] = F.coalesce(has_field(self.fields, name), F.lit(False))
        return F.col(f"`_h_{name}`")

    def number(self, name: str) -> Column:
        """The field as a whole number, null when it is none."""
        self.computed[f"_n_{name}"] = whole_number(self.get(name))
        return F.col(f"`_n_{name}`")

    def host(self, name: str) -> Column:
        """Host of a URL field."""
        self.computed[f"_o_{name}"] = host(self.get(name))
        return F.col(f"`_o_{name}`")

    def staged(self, df: DataFrame) -> DataFrame:
        """`df` with the values the rules asked for."""
        for columns in (self.found, self.computed):
            if columns:
                df = df.withColumns(columns)
        return df


Rule = Callable[[Record], Column]


@dataclass(frozen=True)
class Derived:
    """A computed field. It replaces a field of the same name in the message."""

    name: str
    value: Rule
    only_if: Rule | None = None


@dataclass(frozen=True)
class IngestSpec:
    """One ingest job.

    key:           base of the row key; null drops the message
    key_time:      time after the key; null drops the message
    fields:        declared fields, padded with '' when missing
    repairs:       misspelt field names and their right names
    required:      fields without which a message is dropped; with
                   `required_values` a JSON null counts as missing
    table:         target table, or a rule giving it (null: no table)
    snapshot:      family of the page snapshot: 'apart', 'together', or
                   'apart_if_padded' (apart only where it was missing)
    blanks:        white-space values become ''
    reject_nulls:  a JSON null makes the message unreadable
    blank_key_ok:  an empty base key is accepted when a time follows it
    pad_if:        pad only where this holds
    only_fields:   store these fields only, with `optional` ones when not blank
    """

    name: str
    topics: tuple[str, ...]
    table: str | Rule
    key: Rule
    key_time: Rule | None = None
    fields: tuple[str, ...] = ()
    derived: tuple[Derived, ...] = ()
    repairs: Mapping[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    required_values: bool = False
    snapshot: str = "together"
    blanks: bool = False
    keep_blank: tuple[str, ...] = ()
    reject_nulls: bool = False
    blank_key_ok: bool = False
    pad_if: Rule | None = None
    only_fields: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    rate: int | None = None
    interval: int | None = None
    start: str = "earliest"
    max_message_bytes: int = 10485760

    def with_options(self, **changes) -> IngestSpec:
        """Same job with other settings, such as rate, interval, table or key_time."""
        return replace(self, **changes)

    def cells(self, messages: DataFrame, ingest_time: datetime, zone: str | None = None) -> DataFrame:
        """Cells of the messages, dead letters included."""
        judged, stored, had_snapshot = self._judged(messages, ingest_time, zone)
        good = F.col("_reason").isNull()
        key = row_key(F.col("_key"), F.col("_time")) if self.key_time else F.col("_key")
        out = judged.select(
            F.when(good, F.col("_table")).otherwise(DEAD_LETTERS).alias("table"),
            F.when(good, key).otherwise(_dead_key()).alias("rowkey"),
            good.alias("_good"),
            had_snapshot.alias("_had_snapshot"),
            F.when(good, stored).otherwise(_dead_fields()).alias("fields"),
            F.col("partition").alias("src_partition"),
            F.col("offset").alias("src_offset"),
            F.col("topic").alias("src_topic"),
        )
        return self._finish(explode_fields(held(out), drop=self.repairs))

    def reject_reasons(self, messages: DataFrame, ingest_time: datetime, zone: str | None = None) -> DataFrame:
        """`reason` of every message that cannot be stored, without making its cells."""
        judged = self._judged(messages, ingest_time, zone)[0]
        return held(judged.select(F.col("_reason").alias("reason"))).where(F.col("reason").isNotNull())

    def _judged(self, messages: DataFrame, ingest_time: datetime, zone: str | None) -> tuple[DataFrame, Column, Column]:
        """Messages with `_key`, `_time`, `_table`, `_reason` and the derived fields; the map of what is
        stored, and whether the message had a snapshot."""
        record = Record(zone)
        keys = {
            "_key": self.key(record),
            "_time": self.key_time(record) if self.key_time else F.lit(""),
            **{f"_d_{d.name}": d.value(record) for d in self.derived},
        }
        stored = self._stored_fields(record)
        reason = self._reason(record)
        route = self.table(_RoutedRecord(record, self.derived)) if callable(self.table) else F.lit(self.table)
        had_snapshot = record.has(SNAPSHOT) if self.snapshot == "apart_if_padded" else F.lit(False)

        stamped = _with_ingest_time(with_records(messages, self.repairs), ingest_time, zone)
        judged = (
            record.staged(stamped)
            .withColumns(keys)
            .withColumn("_table", route)
            .withColumn("_reason", reason)
        )
        return judged, stored, had_snapshot

    def _reason(self, record: Record) -> Column:
        """Why a message cannot be stored; null when it can."""
        checks = F.when(record.fields.isNull(), "unreadable")
        if self.reject_nulls:
            has_null = F.exists(F.map_values(record.fields), lambda v: v.isNull())
            checks = checks.when(has_null, "null_value")
        for name in self.required:
            given = F.element_at(record.fields, F.lit(name)).isNotNull()
            checks = checks.when(~(given if self.required_values else record.has(name)), f"no_{name}")
        checks = checks.when(F.col("_key").isNull(), "no_key")
        if not self.blank_key_ok:
            checks = checks.when(is_blank(F.col("_key")), "blank_key")
        if self.key_time:
            checks = checks.when(F.col("_time").isNull(), "bad_time")
        if callable(self.table):
            checks = checks.when(F.col("_table").isNull(), "unrouted")
        return checks

    def _stored_fields(self, record: Record) -> Column:
        """Message fields, padding and derived fields as one map."""
        if self.only_fields:
            names = (*self.only_fields, *self.optional)
            base = text_map({n: F.element_at(record.fields, F.lit(n)) for n in names})
        elif self.pad_if is not None:
            base = F.when(self.pad_if(record), padded(record.fields, self.fields)).otherwise(record.fields)
        elif self.fields:
            base = padded(record.fields, self.fields)
        else:
            base = record.fields
        always = {d.name: F.col(f"_d_{d.name}") for d in self.derived if d.only_if is None}
        parts = [text_map(always)] if always else []
        for d in self.derived:
            if d.only_if is not None:
                one = text_map({d.name: F.col(f"_d_{d.name}")})
                parts.append(F.when(d.only_if(record), one).otherwise(empty_map()))
        return F.map_concat(base, *parts) if parts else base

    def _finish(self, cells: DataFrame) -> DataFrame:
        qualifier, value = F.col("qualifier"), F.col("value")
        if self.snapshot == "apart":
            family = family_of(qualifier)
        elif self.snapshot == "apart_if_padded":
            family = F.when(~F.col("_had_snapshot"), family_of(qualifier)).otherwise("c1")
        else:
            family = family_of(qualifier, split=False)
        if self.optional:
            cells = cells.where(
                ~(F.col("_good") & qualifier.isin(list(self.optional)) & is_blank(value))
            )
        return cells.select(
            "table",
            "rowkey",
            F.when(F.col("_good"), family).otherwise("c1").alias("family"),
            "qualifier",
            F.when(F.col("_good"), clean_value(qualifier, value, self.blanks, self.keep_blank))
            .otherwise(value)
            .alias("value"),
            "src_partition",
            "src_offset",
            "src_topic",
        )


@dataclass(frozen=True)
class ReplySpec:
    """Ingest of reply threads: one stored row per reply."""

    name: str
    topics: tuple[str, ...]
    table: str
    time_field: str | None = "kafkatime"
    stored_time: str = "kafkatime"
    keep_empty: bool = False
    floor_in_key: bool = True
    rate: int | None = None
    interval: int | None = None
    start: str = "earliest"
    max_message_bytes: int = 10485760

    def with_options(self, **changes) -> ReplySpec:
        return replace(self, **changes)

    def replies(
        self, messages: DataFrame, ingest_time: datetime, zone: str | None = None
    ) -> DataFrame:
        """One row per reply, and one per message that cannot be stored (`_reason` set)."""
        fields = F.col("fields")

        def text(name: str) -> Column:
            return F.element_at(fields, F.lit(name))

        needed = ["replycontent", "urlhash", *([self.time_field] if self.time_field else [])]
        reason = F.when(fields.isNull(), "unreadable")
        for name in needed:
            reason = reason.when(text(name).isNull(), f"no_{name}")
        reason = reason.when(is_blank(text("urlhash")), "blank_key")
        judged = (
            _with_ingest_time(with_records(messages), ingest_time, zone)
            .withColumn("_reason", reason)
            .select(
                "_reason",
                "topic",
                "partition",
                "offset",
                F.when(F.col("_reason").isNotNull(), F.col("value")).alias("value"),
                "_ingest_time",
                text("url").alias("url"),
                text("urlhash").alias("urlhash"),
                (text(self.time_field) if self.time_field else F.lit(None)).alias("_seen"),
                F.when(F.col("_reason").isNull(), text("replycontent")).alias("replycontent"),
            )
        )
        floors = explode_replies(held(judged), keep_empty=self.keep_empty)
        return floors.where(F.col("_reason").isNotNull() | F.col("floorid").isNotNull())

    def cells(self, messages: DataFrame, ingest_time: datetime, zone: str | None = None) -> DataFrame:
        """Cells of the replies, dead letters included."""
        replies = self.replies(messages, ingest_time, zone)
        good = F.col("_reason").isNull()
        floor = F.col("floorid").cast("string")
        stored = {
            "url": floor_url(F.col("url"), F.col("floorid")),
            "floorid": floor,
            "urlhash": F.col("urlhash"),
            "replycontent": F.col("replycontent"),
        }
        if self.time_field:
            stored[self.stored_time] = F.col("_seen")
        key = row_key(F.col("urlhash"), floor) if self.floor_in_key else F.col("urlhash")
        out = replies.select(
            F.when(good, F.lit(self.table)).otherwise(DEAD_LETTERS).alias("table"),
            F.when(good, key).otherwise(_dead_key()).alias("rowkey"),
            F.when(good, text_map(stored)).otherwise(_dead_fields()).alias("fields"),
            F.col("partition").alias("src_partition"),
            F.col("offset").alias("src_offset"),
            F.col("topic").alias("src_topic"),
        )
        return explode_fields(out).select(
            "table",
            "rowkey",
            F.lit("c1").alias("family"),
            "qualifier",
            "value",
            "src_partition",
            "src_offset",
            "src_topic",
        )


Spec = IngestSpec | ReplySpec


def _with_ingest_time(df: DataFrame, ingest_time: datetime, zone: str | None) -> DataFrame:
    """One processing time for the whole batch, its text in the given or session zone."""
    zone_name = zone or df.sparkSession.conf.get("spark.sql.session.timeZone")
    if ingest_time.tzinfo is None:
        ingest_time = ingest_time.replace(tzinfo=timezone.utc)
    local = ingest_time.astimezone(ZoneInfo(zone_name))
    return df.withColumns(
        {
            "_ingest_ms": F.lit(epoch_ms(ingest_time)).cast("long"),
            "_ingest_time": F.lit(local.strftime("%Y-%m-%d %H:%M:%S")),
        }
    )


class _RoutedRecord:
    """Record as the routing rule sees it: derived fields hide the message's own."""

    def __init__(self, record: Record, derived: Iterable[Derived]):
        self.record = record
        self.derived = {d.name: d for d in derived}

    def get(self, name: str) -> Column:
        d = self.derived.get(name)
        if d is None:
            return self.record.get(name)
        value = F.col(f"_d_{name}")
        if d.only_if is None:
            return value
        return F.when(d.only_if(self.record), value).otherwise(self.record.get(name))

    def number(self, name: str) -> Column:
        return self.record.number(name)


def _dead_key() -> Column:
    """Row key of a dead letter: its place in the source."""
    return F.concat_ws("_", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))


def _dead_fields() -> Column:
    return text_map(
        {
            "time": F.col("_ingest_time"),
            "topic": F.col("topic"),
            "record": F.coalesce(F.col("value"), F.lit("")),
            "errmsg": F.col("_reason"),
        }
    )
