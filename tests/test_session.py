import pytest

from tidemark.session import checkpoint_dir, local_frame, materialize


def test_checkpoint_dir_is_read_from_session(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured and checkpoint_dir(spark) == configured
    df = materialize(spark.range(10).selectExpr("id * 2 AS x"))
    assert df.count() == 10 and "LogicalRDD" in df._jdf.queryExecution().optimizedPlan().toString()


def test_checkpoint_dir_has_no_default():
    class Unset:
        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Unset)


def test_local_frame_types_escaping_and_size(spark):
    rows = [("it's", 1, True, 1.5), ("back\\slash", None, None, None), ("", -2, False, float("inf"))]
    df = local_frame(spark, rows, "s string, n bigint, b boolean, d double")
    assert [tuple(r) for r in df.collect()] == rows
    assert "LocalRelation" in df._jdf.queryExecution().optimizedPlan().toString()
    assert local_frame(spark, [], "s string").count() == 0
