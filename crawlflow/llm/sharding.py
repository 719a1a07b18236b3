"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has 2^`ring_bits` cells; a row falls on the cell its hash names, and virtual nodes own the
cells up to the next node clockwise. A shard takes rows up to its capacity; rows that find it full
go on clockwise to the next shard. Capacities differ by one row at most and add up to the number of
rows, so every shard ends full: law `rows`. With `slack` over 0 capacities are larger, loads stay
below (1 + slack) times the mean, and a changed number of shards moves fewer rows.

Only the counts of the cells (2^`ring_bits` numbers, whatever the table) reach the driver, which
walks the ring; the walk comes back as spans of ranks within cells, 2^`ring_bits` rows joined by
broadcast. Rows are ranked within their cell: even parts, by a hash of the whole key, so that equal
texts, however many, spread over all cells.

Defined results: a null text has no bytes (size 1, crc32 of nothing); null doc_ids are hashed like
values; rows that repeat a key share a cell and lie beside each other. Further columns pass unchanged
where asked for. An empty table gives an empty table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlflow.llm.shared import text_of


def ring_orders(spark, shards: int, virtual_nodes: int, ring_bits: int) -> list[list[int]]:
    """For each cell, the shards in the order in which its rows meet them, clockwise."""
    point = F.shiftrightunsigned(F.xxhash64(F.lit("node"), "shard", "replica"), 64 - ring_bits)
    nodes = (
        spark.range(shards * virtual_nodes)
        .select((F.col("id") % shards).alias("shard"), F.floor(F.col("id") / shards).alias("replica"))
        .select("shard", "replica", point.alias("point"))
        .collect()
    )
    cells = 1 << ring_bits
    at: list[list[int]] = [[] for _ in range(cells)]
    for node in sorted(nodes):
        at[node["point"]].append(node["shard"])
    orders: list[list[int]] = [[]] * cells
    order: list[int] = []
    for step in range(2 * cells - 1, -1, -1):  # anticlockwise, twice round: the second time is complete
        for shard in reversed(at[step % cells]):
            order = [shard] + [s for s in order if s != shard]
        orders[step % cells] = order
    return [order + [s for s in range(shards) if s not in order] for order in orders]


def walk(counts: dict[int, int], orders: list[list[int]], capacities: list[int]) -> list[dict]:
    """Spans (cell, from_rank, to_rank, shard, slot of the first) after all overflow went on clockwise."""
    free, used = list(capacities), [0] * len(capacities)
    waiting = dict(sorted(counts.items()))
    spans: list[dict] = []
    for turn in range(len(capacities)):
        for cell in list(waiting):
            shard = orders[cell][turn]
            taken = min(waiting[cell], free[shard])
            if taken:
                first = counts[cell] - waiting[cell]
                spans.append({"cell": cell, "first": first, "end": first + taken, "shard": shard, "slot0": used[shard]})
                free[shard] -= taken
                used[shard] += taken
                waiting[cell] -= taken
                if not waiting[cell]:
                    del waiting[cell]
    return spans


def sharded(
    docs: DataFrame,
    shards: int = 8,
    *carry: Column,
    virtual_nodes: int = 64,
    ring_bits: int = 12,
    slack: float = 0.0,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row, then the columns `carry`."""
    spark = docs.sparkSession
    binary = text_of(F.col("text")).cast("binary")
    keys = docs.select(
        "doc_id",
        (F.octet_length(binary) + 1).cast("long").alias("size"),
        F.crc32(binary).alias("text_crc32"),
        F.xxhash64(F.lit("row"), "doc_id").alias("point"),
        F.struct(*carry, F.lit(0).alias("_last")).alias("carried"),
    ).withColumn("cell", F.shiftrightunsigned("point", 64 - ring_bits))
    counts = {r["cell"]: r["n"] for r in _cells(docs, ring_bits).collect()}
    rows = sum(counts.values())
    if slack:
        capacities = [int((1 + slack) * rows / shards) + 1] * shards
    else:
        capacities = [rows // shards + (s < rows % shards) for s in range(shards)]
    spans = walk(counts, ring_orders(spark, shards, virtual_nodes, ring_bits), capacities)
    ranked = keys.withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("cell").orderBy("point", "doc_id", "size", "text_crc32")) - 1,
    )
    spans_of = {}
    for span in spans:
        spans_of.setdefault(span.pop("cell"), []).append(span)
    literal = F.from_json(
        F.lit(json.dumps([{"cell": cell, "spans": of} for cell, of in spans_of.items()])),
        "array<struct<cell bigint, spans array<struct<first bigint, end bigint, shard int, slot0 bigint>>>>",
    )
    table = spark.range(1).select(F.explode(literal).alias("s")).select(F.col("s.cell").alias("of_cell"), "s.spans")
    span = F.filter("spans", lambda s: (s["first"] <= F.col("rank")) & (F.col("rank") < s["end"]))[0]
    return (
        ranked.join(F.broadcast(table), F.col("cell") == F.col("of_cell"))
        .withColumn("span", span)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            F.col("span.shard").alias("shard"),
            (F.col("span.slot0") + F.col("rank") - F.col("span.first")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            *[F.col(f"carried.`{c}`") for c in keys.schema["carried"].dataType.names if c != "_last"],
        )
    )


def _cells(docs: DataFrame, ring_bits: int) -> DataFrame:
    cell = F.shiftrightunsigned(F.xxhash64(F.lit("row"), "doc_id"), 64 - ring_bits)
    return docs.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"))
