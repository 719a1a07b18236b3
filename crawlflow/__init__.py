"""crawlflow: crawl-message ingestion and query jobs written as Spark plans."""

from crawlflow.session import configure

__all__ = ["configure"]
