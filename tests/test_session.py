import pytest

from riskpanel.session import checkpoint_dir


class _Conf:
    def get(self, key, default=None):
        return default


class _SC:
    master = "yarn"

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return _Conf()


class _Session:
    sparkContext = _SC()
    conf = _Conf()


def test_no_local_checkpoint_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session())


def test_configured_folder_is_used(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_cluster_conf_sizes_shuffle_partitions():
    from riskpanel.session import cluster_conf
    c = cluster_conf(100 * (1 << 40))           # a 100 TB shuffle
    assert int(c["spark.sql.shuffle.partitions"]) == 819200
    assert "RocksDB" in c["spark.sql.streaming.stateStore.providerClass"]
    assert "spark.sql.shuffle.partitions" not in cluster_conf()
