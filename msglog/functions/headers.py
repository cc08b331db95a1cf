"""Multi-valued message headers, ``map<string, array<string>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from msglog.schema import HEADERS

EVENT_TIME_HEADER = "event.timestamp"


def empty() -> Column:
    return F.create_map().cast(HEADERS)


def readable(headers: Column) -> Column:
    """Headers as a reader sees them: never NULL."""
    return F.coalesce(headers, empty())


def writable(headers: Column) -> Column:
    """Headers as they are stored: values keep their order, a key without values vanishes."""
    return F.map_filter(readable(headers), lambda _, v: F.coalesce(F.size(v), F.lit(0)) > 0)


def first_value(headers: Column, key: str) -> Column:
    """The first value under ``key``; NULL when the key is missing."""
    return F.get(F.try_element_at(headers, F.lit(key)), F.lit(0))


def with_event_time(headers: Column, event_time: Column, key: str = EVENT_TIME_HEADER) -> Column:
    """Add the event time in epoch milliseconds; it replaces an earlier value of the key."""
    rest = F.map_filter(readable(headers), lambda k, _: k != F.lit(key))
    millis = F.unix_millis(event_time.cast("timestamp")).cast("string")
    stamp = F.create_map(F.lit(key), F.array(millis)).cast(HEADERS)
    return F.map_concat(rest, stamp)
