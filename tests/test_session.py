"""Checkpoint folder resolution: taken from the session, never invented."""

import pytest

from strata.session import checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, current=None):
        self.current = current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, d):
        self.current = d


class _Session:
    def __init__(self, configured, context):
        self.conf = _Conf(configured)
        self._context = context

    @property
    def sparkContext(self):
        if self._context is None:
            raise RuntimeError("no SparkContext (Spark Connect)")
        return self._context


def test_uses_the_sessions_setting():
    ctx = _Context()
    assert checkpoint_dir(_Session("hdfs://shared/ckpt", ctx)) == "hdfs://shared/ckpt"
    assert ctx.current == "hdfs://shared/ckpt"


def test_existing_context_folder_wins():
    assert checkpoint_dir(_Session(None, _Context("s3://bucket/ckpt"))) == "s3://bucket/ckpt"


def test_connect_session_uses_setting():
    assert checkpoint_dir(_Session("s3://bucket/ckpt", None)) == "s3://bucket/ckpt"


def test_unset_raises_instead_of_local_fallback():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session(None, _Context()))
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session(None, None))


def test_test_session_names_a_folder(spark):
    assert checkpoint_dir(spark)


def test_use_measured_broadcast(spark):
    from strata.session import use_measured_broadcast

    use_measured_broadcast(spark, "16m")
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "16m"
    use_measured_broadcast(spark)  # back to the test session's setting
