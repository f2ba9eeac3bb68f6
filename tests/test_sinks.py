"""JDBC sink wiring (no database is started) and the generated name list."""

import pytest

from reelscope.sinks import jdbc
from reelscope.sinks.jdbc import as_sink, count_written, write_jdbc
from reelscope.sources.memory import numbered_names


class RecordingWriter:
    def __init__(self):
        self.calls = []

    def mode(self, m):
        self.calls.append(("mode", m))
        return self

    def option(self, k, v):
        self.calls.append(("option", k, v))
        return self

    def jdbc(self, url, table, properties=None):
        self.calls.append(("jdbc", url, table, properties))


class FakeFrame:
    def __init__(self):
        self.write = RecordingWriter()


def test_write_jdbc_options(monkeypatch):
    df = FakeFrame()

    def recorded(rows, write):
        write(rows)
        return 7

    monkeypatch.setattr(jdbc, "count_written", recorded)
    out = write_jdbc(
        df,
        "jdbc:example://db/analytics",
        "result",
        properties={"user": "u", "password": "p"},
        batch_size=500,
        max_connections=4,
    )
    assert out == 7
    calls = df.write.calls
    assert ("mode", "append") in calls
    assert ("option", "batchsize", "500") in calls
    assert ("option", "isolationLevel", "READ_COMMITTED") in calls
    assert ("option", "numPartitions", "4") in calls
    assert calls[-1] == ("jdbc", "jdbc:example://db/analytics", "result", {"user": "u", "password": "p"})


def test_write_jdbc_rejects_bad_arguments():
    with pytest.raises(ValueError):
        write_jdbc(FakeFrame(), "jdbc:x", "t", mode="upsert")
    with pytest.raises(ValueError):
        write_jdbc(FakeFrame(), "jdbc:x", "t", batch_size=0)


def test_numbered_names(spark):
    df = numbered_names(spark)
    names = [r.name for r in df.collect()]
    assert len(names) == 101 and len(set(names)) == 101
    assert names[0] == "张0" and names[-1] == "张100"


def test_write_jdbc_reaches_spark_jdbc_writer(spark):
    # No database is started: a URL no driver accepts fails inside Spark's
    # JDBC writer, which shows the call goes through the real write path.
    df = numbered_names(spark, count=3)
    with pytest.raises(Exception, match="(?i)no suitable driver|driver"):
        write_jdbc(df, "jdbc:reelscope-none://nowhere/db", "person", mode="append")


def test_write_numbered_names_reaches_spark_jdbc_writer(spark):
    from reelscope.sinks import write_numbered_names

    with pytest.raises(Exception, match="(?i)no suitable driver|driver"):
        write_numbered_names(spark, "jdbc:reelscope-none://nowhere/db", count=5, batch_size=2)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def test_count_is_observed_in_the_write(spark):
    from pyspark.sql import functions as F

    df = spark.range(1000).where("id % 3 = 0")
    assert count_written(df, noop) == 334
    assert count_written(df.where("false"), noop) == 0
    # one evaluation: an accumulator-like side effect is not needed, the rows are random
    rows = []
    random = spark.range(500).withColumn("r", F.rand())
    assert count_written(random.where("r < 2"), lambda d: rows.extend(d.collect())) == len(rows) == 500


def test_failed_write_reports_nothing(spark):
    from pyspark.sql import functions as F

    bad = spark.range(10).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        count_written(bad, noop)


def test_sink_columns_have_the_sinks_types(spark):
    from reelscope.sources.schema import RESULT_SINK

    df = spark.sql("SELECT 3 AS nums, 'x' AS extra, 'o' AS occ, 'g' AS mtype")
    assert [(f.name, f.dataType) for f in as_sink(df, RESULT_SINK).schema] == [(f.name, f.dataType) for f in RESULT_SINK]
    with pytest.raises(Exception):
        as_sink(df.drop("occ"), RESULT_SINK)
