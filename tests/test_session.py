import pytest

from lakeops.session import checkpoint_dir, shared_path


def test_shared_folder_follows_the_session_setting(spark):
    d = checkpoint_dir(spark)
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        assert d == conf
    assert shared_path(spark, "a", "/b/") == d.rstrip("/") + "/a/b"
    assert spark.sparkContext.getCheckpointDir()


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_snapshot_versions_and_pruning(spark, tmp):
    from lakeops.sinks import snapshot
    base = tmp + "/snap"
    assert snapshot.read_snapshot(spark, base, "a int").count() == 0
    for i in range(4):
        v = snapshot.write_snapshot(spark.range(i + 1).selectExpr("cast(id as int) as a"), base, keep=2)
        assert v == i
    assert snapshot.committed_versions(spark, base) == [2, 3]          # one old version kept
    assert snapshot.read_snapshot(spark, base, "a int").count() == 4
    assert snapshot.read_snapshot(spark, base, "a int", version=2).count() == 3
