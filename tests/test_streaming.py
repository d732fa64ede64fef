import os

from tidemark.operators.checks import RangeRule, TableRules
from tidemark.streaming import check_stream


def test_checks_per_micro_batch(spark, scratch_dir):
    src = os.path.join(scratch_dir, "in")
    spark.createDataFrame([(1, 0.5), (2, None), (None, 7.0)], "id int, v double").write.parquet(src)
    stream = spark.readStream.schema("id int, v double").parquet(src)
    out = os.path.join(scratch_dir, "out")
    q = check_stream(stream, TableRules("s", ("id",), (RangeRule("v", 0.0, 1.0),)), out,
                     os.path.join(scratch_dir, "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = {(r.check_name, r.observed) for r in spark.read.parquet(out).collect()}
    assert got == {("row_count", 3), ("null_key", 1), ("range [0, 1]", 1)}


def test_running_counters(spark, scratch_dir):
    from tidemark.streaming import stream_counters
    src = os.path.join(scratch_dir, "in2")
    spark.createDataFrame([(1, 0.5), (None, 2.0)], "id int, v double").write.parquet(src)
    stream = spark.readStream.schema("id int, v double").parquet(src)
    q = (stream_counters(stream, TableRules("s", ("id",), (RangeRule("v", 0.0, 1.0),)))
         .writeStream.outputMode("complete").format("memory").queryName("tidemark_counters")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {(r.check_name, r.observed) for r in spark.table("tidemark_counters").collect()}
    assert got == {("row_count", 2), ("null_key", 1), ("range [0, 1]", 1)}
