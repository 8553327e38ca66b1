import pytest

from reelrank import session


def test_sized_settings_scale_with_input():
    small = session.sized_settings(10 << 20, total_cores=8)
    big = session.sized_settings(100 * (1 << 40), total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # two waves of cores
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    master = "spark://cluster:7077"

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return _Conf()


class _Session:
    sparkContext = _Context()
    conf = _Conf()


def test_cluster_without_shared_checkpoint_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session())
