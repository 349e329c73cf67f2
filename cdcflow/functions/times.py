"""Event-time parsing and the text forms times take in published changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the feed and of the published changes.
FEED_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
SECOND_PATTERN = "yyyy-MM-dd HH:mm:ss"
MICRO_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def parse_feed_time(text) -> Column:
    """Feed text to timestamp; bad text gives NULL instead of failing the job."""
    return F.try_to_timestamp(text, F.lit(FEED_PATTERN))


def time_text(name: str, digits: int = 6) -> Column:
    """Text of a time column with the declared fraction digits, 6 or 0."""
    pattern = MICRO_PATTERN if digits else SECOND_PATTERN
    return F.date_format(F.col(name), pattern)
