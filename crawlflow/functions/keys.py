"""Row keys: a base id, optionally followed by '_' and a time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlflow.functions.hashing import xxh64


def row_key(*parts: Column) -> Column:
    """Parts joined with '_'; null when any part is null."""
    joined = parts[0].cast("string")
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("_"), part.cast("string"))
    return joined


def url_hash_key(url: Column) -> Column:
    """Decimal text of the URL hash; null for a missing URL."""
    hashed = xxh64(url)
    return F.when(hashed != 0, hashed.cast("string"))
