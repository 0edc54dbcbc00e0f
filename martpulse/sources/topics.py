"""Topic sources and sinks: one JSON text per message in a ``value`` column.

``fmt="kafka"`` uses Spark's Kafka connector (needs its jar on the cluster); the file forms
(``json`` = one message per line, ``parquet`` = a ``value`` column) run anywhere. Offsets of a
stream live in its checkpoint folder, not in consumer auto-commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Default topic names (deployment configuration, not data).
STARTUP_TOPIC = "startup"
EVENT_TOPIC = "event"
ORDER_TOPIC = "order_info"
DETAIL_TOPIC = "order_detail"
USER_TOPIC = "user_info"

_VALUE = T.StructType([T.StructField("value", T.StringType())])


def read_topic(spark: SparkSession, topic_or_path: str, fmt: str = "json", streaming: bool = False,
               bootstrap_servers: str | None = None, group_id: str | None = None,
               starting_offsets: str = "latest", pattern: bool = False,
               min_partitions: int | None = None) -> DataFrame:
    """Messages of one topic (or topic pattern) as ``value STRING`` rows."""
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        r = reader.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers or "")
        r = r.option("subscribePattern" if pattern else "subscribe", topic_or_path)
        r = r.option("startingOffsets", starting_offsets)
        if group_id:
            r = r.option("kafka.group.id", group_id)
        if min_partitions:
            r = r.option("minPartitions", min_partitions)
        return r.load().select(F.col("value").cast("string").alias("value"))
    if fmt == "json":
        return reader.text(topic_or_path).select("value")
    if fmt == "parquet":
        return (reader.schema(_VALUE).parquet(topic_or_path) if streaming
                else reader.parquet(topic_or_path)).select(F.col("value").cast("string"))
    raise ValueError(f"unknown topic format {fmt!r}")


def write_topics(df: DataFrame, path_or_servers: str, fmt: str = "parquet", mode: str = "append"):
    """Batch-write ``(topic, value)`` rows: one folder per topic, or one Kafka record per row."""
    if fmt == "kafka":
        (df.select("topic", "value").write.format("kafka")
           .option("kafka.bootstrap.servers", path_or_servers).save())
        return
    writer = df.select("topic", "value").write.mode(mode).partitionBy("topic")
    if fmt == "parquet":
        writer.parquet(path_or_servers)
    elif fmt == "json":
        writer.text(path_or_servers)      # JSON lines: the message text itself, one per line
    else:
        raise ValueError(f"unknown topic format {fmt!r}")
