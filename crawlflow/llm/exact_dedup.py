"""Exact dedup: a two-pass Bloom filter lets rows without a copy pass; only the others shuffle.

Pass 1 counts, for each filter position, the rows whose text hash falls on it (two positions a
row, summed on the map side); positions of one row only are dropped, the rest become bitmaps.
Pass 2 tests each row against the bitmaps: a row with a position that no other row hit has no
copy and passes straight through. The others are grouped by the full SHA-256, which decides.

The filter takes at least 16 bits a row, whatever the number of rows: one that would be larger than
`max_filter_bytes`, the proven bound of what is broadcast, is cut into ranges of the hashes. Equal texts
lie in one range, so each range is a table of its own, done after the one before. The share of lone rows that
shuffle is the same at every size.

Defined results: a null text counts as empty; equal means identical after lower-casing A-Z. Of
equal texts the row with the largest doc_id stays; a null doc_id is below all others. Rows that
repeat a doc_id with an equal text are one document: `memberships` marks each of them alike,
`exact_dedup` keeps one. Further columns, whatever their names, pass unchanged. An empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.llm.shared import pinned, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKET_BITS = 32768  # bits of one bitmap row, as bitmap_construct_agg lays them out


def text_hash(text: Column) -> Column:
    return F.unhex(F.sha2(F.translate(text_of(text), UPPER, LOWER).cast("binary"), 256))


def _positions(digest: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), digest), F.lit(bits)) for seed in (1, 2)]


def _bits(rows: int) -> int:
    """Bits of the filter of so many rows: a power of two, at least 16 a row."""
    return max(BUCKET_BITS, 1 << (16 * rows - 1).bit_length() if rows else 0)


def hash_ranges(rows: int, max_filter_bytes: int) -> int:
    """Ranges of the hashes such that each one's filter is at most `max_filter_bytes`, a power of two of at least 4 kB.

    The margin of a quarter covers ranges with more rows than the mean.
    """
    return max(1, -(-16 * rows * 5 // (4 * 8 * max_filter_bytes))) if _bits(rows) > 8 * max_filter_bytes else 1


def in_range(df: DataFrame, number: int, ranges: int) -> DataFrame:
    """The rows whose digest is in one of `ranges` ranges."""
    return df.filter(F.pmod(F.xxhash64(F.lit(3), "digest"), F.lit(ranges)) == number) if ranges > 1 else df


def repeat_filter(hashes: DataFrame, max_filter_bytes: int = 64 << 20) -> tuple[DataFrame, int]:
    """Pass 1: bitmaps (bucket, bitmap) of the positions that two rows or more hit, and the bits in all.

    A range with more rows than its share, as a text of very many copies is, has no more distinct hashes
    for it: the bits stay within the bound.
    """
    bits = min(_bits(hashes.count()), max(BUCKET_BITS, 8 * max_filter_bytes))
    hit = hashes.select(F.explode(F.array_distinct(F.array(*_positions(F.col("digest"), bits)))).alias("position"))
    again = hit.groupBy("position").agg(F.count("*").alias("n")).filter("n > 1")
    bitmaps = again.groupBy(F.floor(F.col("position") / BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("position") % BUCKET_BITS).alias("bitmap")
    )
    return pinned(bitmaps), bits


def possibly_repeated(df: DataFrame, filter_: DataFrame, bits: int) -> DataFrame:
    """Pass 2: `df` with the column `maybe`, false where the digest surely stands alone."""
    for i, position in enumerate(_positions(F.col("digest"), bits)):
        side = F.broadcast(filter_.select(F.col("bucket").alias(f"b{i}"), F.col("bitmap").alias(f"m{i}")))
        df = df.withColumn(f"p{i}", position).join(side, F.floor(F.col(f"p{i}") / BUCKET_BITS) == F.col(f"b{i}"), "left")
    tests = []
    for i in (0, 1):
        within = F.col(f"p{i}") % BUCKET_BITS
        byte = F.conv(F.hex(F.substring(F.col(f"m{i}"), F.floor(within / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        tests.append(F.coalesce(F.getbit(byte, (within % 8).cast("int")) == 1, F.lit(False)))
    return df.withColumn("maybe", tests[0] & tests[1]).drop("p0", "p1", "b0", "b1", "m0", "m1")


def _groups(candidates: DataFrame) -> DataFrame:
    """Of each digest that several rows have: the doc_id that stays and the number of rows."""
    return pinned(
        candidates.groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )


def _by_range(hashes: DataFrame, max_filter_bytes: int, told: Callable[[int, int], DataFrame]) -> DataFrame:
    """The results of all ranges; with several, each is written before the next, so that one filter is held at a time."""
    ranges = hash_ranges(hashes.count(), max_filter_bytes)
    parts = [told(number, ranges) if ranges == 1 else pinned(told(number, ranges)) for number in range(ranges)]
    return reduce(DataFrame.unionByName, parts)


def memberships(docs: DataFrame, max_filter_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row, dropped ones too."""
    hashes = pinned(docs.select("doc_id", text_hash(F.col("text")).alias("digest")))

    def told(number: int, ranges: int) -> DataFrame:
        mine = in_range(hashes, number, ranges)
        flagged = possibly_repeated(mine, *repeat_filter(mine, max_filter_bytes))
        candidates = flagged.filter("maybe").drop("maybe")
        joined = candidates.join(_groups(candidates), "digest", "left")
        alone = flagged.filter("not maybe").select(
            "digest", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
        )
        repeated = joined.select(
            "digest",
            "doc_id",
            F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        )
        return alone.unionByName(repeated)

    return _by_range(hashes, max_filter_bytes, told).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, max_filter_bytes: int = 64 << 20) -> DataFrame:
    """`docs` with one row of each group of equal texts; texts without a copy do not shuffle.

    Which rows go is told by hash and doc_id, from narrow rows. The texts that may have copies are dealt
    by both, so a text of very many copies is spread over tasks.
    """
    hashes = pinned(docs.select("doc_id", text_hash(F.col("text")).alias("digest")))
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), text_hash(F.col("text")).alias("digest"))

    def told(number: int, ranges: int) -> DataFrame:
        mine = in_range(hashes, number, ranges)
        found = repeat_filter(mine, max_filter_bytes)
        candidates = possibly_repeated(mine, *found).filter("maybe")
        named = candidates.groupBy("digest", "doc_id").agg(F.count("*").alias("times"))
        keeps = F.col("doc_id").eqNullSafe(F.col("keep_id"))
        # `again` are kept ids that come more than once, the others go.
        marks = pinned(
            named.join(_groups(candidates), "digest")
            .filter(~keeps | (F.col("times") > 1))
            .select(F.col("digest").alias("of_digest"), F.col("doc_id").alias("of_id"), keeps.alias("again"))
        )
        flagged = possibly_repeated(in_range(packed, number, ranges), *found)
        same = (F.col("digest") == F.col("of_digest")) & F.col("doc_id").eqNullSafe(F.col("of_id"))
        marked = flagged.filter("maybe").join(marks, same, "left")
        once = marked.filter("again").dropDuplicates(["doc_id", "digest"])
        staying = marked.filter("again is null").select("row").unionByName(once.select("row"))
        return flagged.filter("not maybe").select("row").unionByName(staying)

    return _by_range(hashes, max_filter_bytes, told).select("row.*")
