import os
import shutil
import tempfile

from pyspark.sql import functions as F

from tillroll.operators.funnel import search_funnel
from tillroll.sources import fixtures as fx
from tillroll.sources.tables import Tables
from tillroll.streaming.funnel import daily_funnel_stream


def test_daily_funnel_stream_equals_batch_for_closed_days(spark, sf001):
    t = Tables(spark, sf001)
    schema = t.events.schema
    src = tempfile.mkdtemp(prefix="funnel-src-")  # a file stream reads a directory
    shutil.copy(os.path.join(sf001, "events.parquet"), os.path.join(src, "part-0.parquet"))
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)

    class _T:
        events = raw

    stream = daily_funnel_stream(fx.search_events(_T))
    name = "funnel_stream_test"
    q = stream.writeStream.outputMode("append").format("memory").queryName(name) \
        .option("checkpointLocation", tempfile.mkdtemp(prefix="funnel-ckpt-")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.table(name)
    batch = search_funnel(fx.search_events(t), period="day")
    last_day = batch.agg(F.max("event_date")).first()[0]
    assert got.count() > 0
    closed = batch.where(F.col("event_date") < last_day)
    assert got.where(F.col("event_date") < last_day).exceptAll(closed).count() == 0
    assert closed.exceptAll(got).count() == 0


def test_daily_funnel_stream_survives_restart(spark, sf001):
    """Stop after the first file, restart from the checkpoint: the file sink holds each closed day exactly once."""
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    table = pq.read_table(os.path.join(sf001, "events.parquet"))
    cut = pc.less(table["ts"], pc.strptime("2024-01-15", format="%Y-%m-%d", unit="us"))
    src = tempfile.mkdtemp(prefix="funnel-src2-")
    sink = tempfile.mkdtemp(prefix="funnel-sink-")
    ckpt = tempfile.mkdtemp(prefix="funnel-ckpt2-")
    t = Tables(spark, sf001)
    schema = t.events.schema

    def run_once():
        raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)

        class _T:
            events = raw

        q = (daily_funnel_stream(fx.search_events(_T)).writeStream.outputMode("append").format("parquet")
             .option("path", sink).option("checkpointLocation", ckpt).start())
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    pq.write_table(table.filter(cut), os.path.join(src, "part-0.parquet"))
    run_once()
    pq.write_table(table.filter(pc.invert(cut)), os.path.join(src, "part-1.parquet"))
    run_once()
    got = spark.read.parquet(sink)
    batch = search_funnel(fx.search_events(t), period="day")
    last_day = batch.agg(F.max("event_date")).first()[0]
    closed = batch.where(F.col("event_date") < last_day)
    assert got.groupBy("event_date").count().where("count > 1").count() == 0
    assert got.where(F.col("event_date") < last_day).exceptAll(closed).count() == 0
    assert closed.exceptAll(got).count() == 0
