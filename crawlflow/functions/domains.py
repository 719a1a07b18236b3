"""Host and domain extraction from URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlflow.fixed_values import DOMAIN_BAD_URL, DOMAIN_ENDINGS, DOMAIN_NOT_FOUND

# Schemes a JVM can open without extra handlers. parse_url is not used: it
# accepts every scheme and gives no host for names with an underscore.
_KNOWN_SCHEME = r"^\s*(?i:url:)?(?i:https?|ftp|file|mailto):"
_BAD_PORT = r"^\s*(?i:url:)?(?i:https?|ftp|file)://(?:[^/?#@]*@)?+[^/?#:\[\]]*:(?!\d*(?:[/?#]|\s*$))"
_HOST = r"^\s*(?i:url:)?(?i:https?|ftp|file)://(?:[^/?#@]*@)?([^/?#:\s]*)"


def host(url: Column) -> Column:
    """Lower-case host; '' when the URL has none, null when it is not a URL."""
    valid = url.rlike(_KNOWN_SCHEME) & ~url.rlike(_BAD_PORT)
    return F.when(valid, F.lower(F.regexp_extract(url, _HOST, 1)))


def domain_of_host(host_name: Column, labels: int, endings: str = DOMAIN_ENDINGS) -> Column:
    """`labels` labels before a known ending, or one of the two marker texts."""
    # The array form gives null for no match, so the pattern runs once per host.
    pattern = F.lit(rf"(\w*\.?){{{labels}}}\.({endings})$")
    found = F.get(F.regexp_extract_all(host_name, pattern, 0), F.lit(0))
    return F.when(host_name.isNull(), DOMAIN_BAD_URL).otherwise(
        F.coalesce(found, F.lit(DOMAIN_NOT_FOUND))
    )


def first_level_domain(url: Column, endings: str = DOMAIN_ENDINGS) -> Column:
    """One label before the ending, or one of the two marker texts."""
    return domain_of_host(host(url), 1, endings)


def second_level_domain(url: Column, endings: str = DOMAIN_ENDINGS) -> Column:
    """Two labels before the ending, or one of the two marker texts."""
    return domain_of_host(host(url), 2, endings)
