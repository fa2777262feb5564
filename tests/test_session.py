"""The shared folder and the session settings."""

import pytest
from pyspark.sql import functions as F

from baleflow import session


class FakeSpark:
    """A session on some master, with or without the folder a cluster names."""

    def __init__(self, master, conf=None, checkpoint=None):
        self.sparkContext = self
        self.conf = self
        self.master = master
        self._conf = conf
        self._checkpoint = checkpoint

    def get(self, key, default):
        return self._conf or default

    def getCheckpointDir(self):
        return self._checkpoint


def test_cluster_must_name_the_folder():
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        session.shared_dir(FakeSpark("yarn"))
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        session.shared_dir(FakeSpark("local-cluster[3,2,1024]"))


def test_named_folder_is_used():
    assert session.shared_dir(FakeSpark("yarn", conf="hdfs:///shared/")) == "hdfs:///shared"
    assert session.shared_dir(FakeSpark("yarn", checkpoint="s3a://b/c")) == "s3a://b/c"


def test_new_folders_differ(spark):
    first, second = session.new_dir(spark, "x"), session.new_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_settings_can_be_set_at_run_time(spark):
    session.tune(spark)
    for key, value in session.SETTINGS.items():
        assert spark.conf.get(key) == value


def test_written_table_is_evaluated_once(spark):
    random = session.written(spark.range(5).withColumn("r", F.rand()), "random")
    assert random.collect() == random.collect()
    assert "rand(" not in random._jdf.queryExecution().toString()


def test_broadcast_only_below_the_bound(spark):
    table = session.written(spark.range(10), "ten")
    hinted = session.broadcast_if_small(table, 10)._jdf.queryExecution().analyzed().toString()
    plain = session.broadcast_if_small(table, 9)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted and "broadcast" not in plain
