"""Small logs in the envelope schema."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from msglog.schema import ENVELOPE

START = datetime(2024, 1, 1)


def message(seq: int, subject: str, data: bytes = b"", stream: str = "s", headers: dict | None = None,
            at: datetime | None = None, msg_id: str | None = None):
    return (subject, headers, bytearray(data), seq, at or START + timedelta(seconds=seq), "UTC", None, msg_id, stream)


def log_of(spark, rows):
    return spark.createDataFrame(rows, ENVELOPE)


def people(spark, bad: bool = False):
    """Ten well-formed messages and, if asked for, a malformed one published last."""
    rows = [message(i + 1, f"s.standard.{i}",
                    json.dumps({"id": i, "name": chr(ord("a") + i), "age": i * 10}).encode(),
                    headers={"one": ["foo", "bar"], "two": ["blue"]}) for i in range(10)]
    if bad:
        rows.append(message(11, "s.bad", b"\x01"))
    return log_of(spark, rows)


def column(df, name: str) -> list:
    return [row[name] for row in df.select(name).collect()]
