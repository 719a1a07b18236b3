"""Column expressions. Nothing here runs Python per row."""

from crawlflow.functions.domains import domain_of_host, first_level_domain, host, second_level_domain
from crawlflow.functions.groups import site_group, site_group_intended, whole_number
from crawlflow.functions.hashing import xxh64
from crawlflow.functions.keys import row_key, url_hash_key
from crawlflow.functions.texts import (
    blank_to_empty,
    is_blank,
    log_item,
    log_type,
    marked_title,
    marker_to_empty,
    rehash_id,
    reverse_text,
    split_parts,
    without_trailing_empty,
)
from crawlflow.functions.times import (
    dashed_millis,
    dual_millis,
    millis_text,
    normalise_time,
    with_repaired_publish_time,
)

__all__ = [name for name in dir() if not name.startswith("_")]
