from layerforge import configure
from layerforge.context import cluster_conf, new_run_dir, work_root


def test_cluster_conf_bounds():
    assert cluster_conf(10 * 2 ** 30)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(1000 * 2 ** 30)["spark.sql.shuffle.partitions"] == "1000"
    assert cluster_conf(100 * 2 ** 40)["spark.sql.shuffle.partitions"] == "50000"


def test_configure_and_work_root_use_session_settings(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        configure(spark, input_bytes=1000 * 2 ** 30)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1000"
        assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    root = work_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    assert new_run_dir(spark, "x").startswith(root + "/x-")


def test_only_a_one_process_session_may_use_a_local_folder(monkeypatch):
    import pytest

    from layerforge import context

    class Fake:
        master = "spark://host:7077"
        sparkContext = conf = None

        def getCheckpointDir(self):
            return None

        def get(self, key, default=None):
            return default

    fake = Fake()
    fake.sparkContext = fake.conf = fake
    with pytest.raises(RuntimeError):
        context.work_root(fake)
    assert context.is_one_process("local[8]") and context.is_one_process("local")
    assert not context.is_one_process("local-cluster[3,2,1024]")
