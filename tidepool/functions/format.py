"""Output shaping shared by the query catalogue: stable text for timestamps and arrays
so results compare equal across engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_text(c) -> Column:
    """Timestamp as 'yyyy-MM-dd HH:mm:ss' text (session time zone is UTC)."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def ts_text_us(c) -> Column:
    """Timestamp with microseconds as text."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def arr_text(c, sort: bool = True, sep: str = ",") -> Column:
    """Array as joined text (sorted unless the order is the point)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.array_sort(c) if sort else c, sep)
