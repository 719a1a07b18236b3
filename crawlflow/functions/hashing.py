"""Hash functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# xxhash64 chains its arguments: the hash of one is the seed of the next, and
# the first seed is 42. This long hashes to 0 under seed 42, so it turns the
# following argument into plain XXH64 with seed 0.
_SEED_ZERO = -365884300664092260


def xxh64(text: Column) -> Column:
    """XXH64 with seed 0 over the UTF-8 bytes; 0 for null."""
    return F.xxhash64(F.lit(_SEED_ZERO).cast("long"), text.cast("string"))
