"""Topic sources/sinks and scans: file forms round-trip; the parallelism guard leaves streams alone."""

from pyspark.sql import functions as F

from martpulse.sources import topics as TP
from martpulse.sources.tables import read_table, stream_table

SF = "/root/testdata/sf0.001"


def test_write_and_read_topics_round_trip(spark, scratch):
    df = spark.createDataFrame([("startup", '{"a":1}'), ("event", '{"b":2}'), ("event", '{"c":3}')],
                               "topic string, value string")
    for fmt in ("parquet", "json"):
        TP.write_topics(df, f"{scratch}/{fmt}", fmt)
    got = sorted(r.value for r in TP.read_topic(spark, f"{scratch}/parquet/topic=event", "parquet").collect())
    assert got == ['{"b":2}', '{"c":3}']
    lines = TP.read_topic(spark, f"{scratch}/json/topic=startup", "json").collect()
    assert [r.value for r in lines] == ['{"a":1}']            # JSON lines: one message per line


def test_stream_topic_reader(spark, scratch):
    s = TP.read_topic(spark, f"{scratch}", "parquet", streaming=True)
    assert s.isStreaming and s.columns == ["value"]
    ev = stream_table(spark, SF, "events")
    assert ev.isStreaming


def test_read_table_prunes(spark):
    df = read_table(spark, SF, "events", ["event_id", "ts"])
    assert df.columns == ["event_id", "ts"]
    assert df.count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_scans_read_only_used_columns(spark):
    from martpulse.plans.catalog import QUERIES

    plan = QUERIES["sale_search_total"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.splitlines() if "lineitem.parquet" in line]
    assert schemas and all("l_extendedprice" not in line and "l_linenumber" not in line for line in schemas)
    assert any("GreaterThanOrEqual(o_orderdate" in line for line in plan.splitlines())


def test_shuffle_count_follows_the_input(spark, monkeypatch):
    from martpulse import session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, f"{SF}/events.parquet") == 200
        monkeypatch.setattr(session, "SHUFFLE_BYTES", 100)
        assert session.size_shuffles(spark, f"{SF}/events.parquet", least=1) > 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
