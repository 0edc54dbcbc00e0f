"""martpulse: e-commerce activity analytics as Spark DataFrame / Structured Streaming operators.

Layout
------
sources/    table and topic readers/writers, shop stand-ins derived from the shared tables
functions/  column-expression helpers (time parts, masking, JSON, tokens, age)
operators/  DataFrame -> DataFrame operators (routing, dedup, widening, alerts, upsert, search)
plans/      composite dashboard queries and the query catalog used by ``__spark_entry__``
streaming/  Structured Streaming jobs built from the same operators
"""

from martpulse.session import get_spark, checkpoint_root  # noqa: F401

__all__ = ["get_spark", "checkpoint_root"]
