"""JSON text <-> records as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

CORRUPT = "_corrupt_record"


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value",
               keep: tuple[str, ...] = (), keep_raw: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parse a JSON text column with a fixed schema.

    Returns ``(good, bad)``: good rows flattened to the schema's columns (plus ``keep`` columns),
    malformed rows (text that is not a JSON object) with their raw text, so one bad message does not
    fail the batch. Both are lazy views of the same scan. ``keep_raw``: good rows also carry their text.
    """
    wide = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = df.select(*keep, F.col(value).alias("__raw"),
                       F.from_json(F.col(value), wide,
                                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
                       .alias("__rec"))
    ok = F.col("__rec").isNotNull() & F.col(f"__rec.{CORRUPT}").isNull() & F.col("__raw").isNotNull()
    raw = [F.col("__raw").alias(value)] if keep_raw else []
    good = parsed.where(ok).select(*keep, *raw, *[F.col(f"__rec.{f.name}").alias(f.name) for f in schema.fields])
    bad = parsed.where(~ok | ok.isNull()).select(*keep, F.col("__raw").alias(value))
    return good, bad


def as_string_map(value) -> Column:
    """JSON object text -> MAP<STRING,STRING>; numbers/booleans keep their text, bad input -> null."""
    c = F.col(value) if isinstance(value, str) else value
    return F.from_json(c, T.MapType(T.StringType(), T.StringType()))


def to_json_record(*cols) -> Column:
    """Serialise columns to one JSON object text."""
    return F.to_json(F.struct(*cols))
