"""Line dedup over overlapping windows of three lines.

Lines that are not blank, trimmed, form windows of three that follow one another; the 128-bit hash
of a window is counted over all documents. Its first occurrence (smallest doc_id, then position)
stays; the lines of every later occurrence are covered, and covered lines are removed after merging
the positions of all windows of a document. Windows that occur once leave at the first aggregation;
the hashes found repeatedly, with their first place, are joined back.

Defined results: a null text counts as empty; blank lines belong to no window and stay; a text of
fewer than three lines with words stays whole. A null doc_id is before all others. Rows that repeat
a doc_id and text are one document and lose the same lines. Further columns pass unchanged, but for input
columns `n_lines` and `n_removed`: the results take their names. An empty table gives an empty table. The
window of three lines does not see repeats of one or two lines, nor any in a text with fewer than three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.llm.shared import SPACE, bind, pinned, text_of


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(text: Column) -> Column:
    """Structs (digest, at, covers): the hash of each window, its number, and its three line positions."""
    numbered = F.transform(_lines(text), lambda line, i: F.struct(F.trim(line, F.lit(SPACE)).alias("line"), i.alias("i")))

    def windows(rows: Column) -> Column:
        def window(row: Column, k: Column) -> Column:
            three = [row, F.get(rows, k + 1), F.get(rows, k + 2)]
            return F.struct(
                F.unhex(F.md5(F.concat_ws("\n", *[r["line"] for r in three]))).alias("digest"),
                k.alias("at"),
                F.array(*[r["i"] for r in three]).alias("covers"),
            )

        return F.transform(F.slice(rows, F.lit(1), F.greatest(F.size(rows) - 2, F.lit(0))), window)

    return bind(F.filter(numbered, lambda row: row["line"] != ""), windows)


def covered_lines(docs: DataFrame) -> DataFrame:
    """of_id, of_text (md5) and `covered`, the positions to remove, of the documents that lose lines."""
    text = text_of(F.col("text"))
    windows = docs.select(
        F.col("doc_id").alias("of_id"),
        F.unhex(F.md5(text.cast("binary"))).alias("of_text"),
        F.explode(_windows(text)).alias("w"),
    ).select("of_id", "of_text", "w.*")
    place = F.struct("of_id", "at")
    repeated = pinned(
        windows.groupBy("digest")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("of_digest"), "first")
    )
    later = windows.join(repeated, F.col("digest") == F.col("of_digest")).filter(~place.eqNullSafe(F.col("first")))
    return later.groupBy("of_id", "of_text").agg(
        F.array_distinct(F.flatten(F.collect_set("covers"))).alias("covered")
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """`docs` with the remaining lines as text, n_lines and n_removed."""
    text = text_of(F.col("text"))
    packed = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").alias("id"),
        F.unhex(F.md5(text.cast("binary"))).alias("text_md5"),
    )
    covered = covered_lines(docs)
    joined = packed.join(
        covered, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_md5") == F.col("of_text")), "left"
    )
    whole = text_of(F.col("row.text"))

    def left(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    remaining = F.when(F.col("covered").isNull(), F.col("row.text")).otherwise(bind(_lines(whole), left))
    names = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    return joined.select(
        *[F.col(f"row.`{c}`") for c in names],
        remaining.alias("text"),
        F.size(_lines(whole)).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
    )
