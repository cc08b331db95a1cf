"""Metadata columns of a read, appended after the payload columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msglog.functions import headers as H
from msglog.schema import READABLE


def check_metadata(keys: Sequence[str]) -> None:
    unknown = [k for k in keys if k not in READABLE]
    if unknown:
        raise ValueError(f"unknown metadata field {unknown[0]!r}; readable: {sorted(READABLE)}")


def event_time(timestamp: Column) -> Column:
    """Event time of a message: its timestamp in whole milliseconds."""
    return F.date_trunc("millisecond", timestamp.cast("timestamp"))


def local_time(timestamp: Column, timezone: Column) -> Column:
    """Wall-clock time in the zone the message came from."""
    return F.from_utc_timestamp(timestamp.cast("timestamp"), timezone)


def project(log: DataFrame, physical: Sequence[Column | str], metadata: Sequence[str] = (),
            names: Mapping[str, str] | None = None) -> DataFrame:
    """Payload columns, then the chosen metadata under their public (or given) names."""
    check_metadata(metadata)
    names = names or {}
    tail = []
    for key in metadata:
        column = READABLE[key]
        if column not in log.columns:
            raise ValueError(f"metadata field {key!r} is not available: this read has no {column!r}")
        value = H.readable(F.col(column)) if key == "headers" else F.col(column)
        tail.append(value.alias(names.get(key, key)))
    return log.select(*physical, *tail)
