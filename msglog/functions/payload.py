"""Payload bytes to columns and back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Codec = str | Callable[[Column], Column]

_CORRUPT = "_corrupt"


def text(data: Column) -> Column:
    return F.decode(data, "UTF-8")


def parsed(data: Column, format: Codec, schema: T.StructType | str | None = None,
           mode: str = "FAILFAST") -> Column:
    """The payload as a struct (``json``, ``csv``, ``avro``), a string, or whatever a
    custom decoder returns. ``mode`` is Spark's parse mode: FAILFAST ends the job on a
    bad payload, PERMISSIVE yields NULLs."""
    if callable(format):
        return format(data)
    if format == "string":
        return text(data)
    if schema is None:
        raise ValueError(f"format {format!r} needs a declared schema")
    if format == "json":
        return F.from_json(text(data), schema, {"mode": mode})
    if format == "csv":
        ddl = schema if isinstance(schema, str) else ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        return F.from_csv(text(data), ddl, {"mode": mode})
    if format == "avro":
        from pyspark.sql.avro.functions import from_avro  # needs the spark-avro package on the classpath

        if not isinstance(schema, str):
            raise ValueError("format 'avro' needs the Avro schema as a JSON string")
        return from_avro(data, schema, {"mode": mode})
    raise ValueError(f"unknown payload format {format!r}")


def split_bad(log: DataFrame, schema: T.StructType, format: str = "json",
              data: str = "data") -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: good rows gain a ``payload`` struct, bad rows keep the raw bytes."""
    if format not in ("json", "csv"):
        raise ValueError("bad payloads can be told apart for json and csv only")
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    content = text(F.col(data))
    if format == "json":
        struct = F.from_json(content, wide, options)
    else:
        struct = F.from_csv(content, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide), options)
    # Behind a generator each payload is parsed once, not once per use.
    tried = log.withColumn("payload", F.explode(F.array(struct)))
    is_bad = F.coalesce(F.col(f"payload.{_CORRUPT}").isNotNull() | F.col("payload").isNull(), F.lit(True))
    good = tried.where(~is_bad).withColumn("payload", F.col("payload").dropFields(_CORRUPT))
    return good, tried.where(is_bad).drop("payload")


def encoded(format: Codec, columns: Sequence[str] | Column) -> Column:
    """Binary payload from physical columns (or from one given expression)."""
    if callable(format):
        source = columns if isinstance(columns, Column) else F.struct(*columns)
        return format(source)
    if format == "string":
        source = columns if isinstance(columns, Column) else F.col(_only(columns))
        return F.encode(source.cast("string"), "UTF-8")
    source = columns if isinstance(columns, Column) else F.struct(*columns)
    if format == "json":
        # Null fields stay in the document: Spark would drop them by default.
        return F.encode(F.to_json(source, {"ignoreNullFields": "false"}), "UTF-8")
    if format == "csv":
        return F.encode(F.to_csv(source), "UTF-8")
    if format == "avro":
        from pyspark.sql.avro.functions import to_avro

        return to_avro(source)
    raise ValueError(f"unknown payload format {format!r}")


def _only(columns: Sequence[str]) -> str:
    if len(columns) != 1:
        raise ValueError(f"format 'string' encodes one column, got {list(columns)}")
    return columns[0]
