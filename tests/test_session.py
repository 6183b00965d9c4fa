"""Session helpers: checkpoint folder policy, stored tables and their release."""

import pytest

from strata.plans import catalog
from strata.session import Scratch, checkpoint_dir


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Context:
    def __init__(self, master, configured=None):
        self.master = master
        self._conf = _Conf({"spark.checkpoint.dir": configured} if configured else {})
        self._dir = None

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self._dir = path


class _Session:
    def __init__(self, master, configured=None):
        self.sparkContext = _Context(master, configured)
        self.conf = _Conf()


def test_cluster_without_checkpoint_folder_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn"))


def test_checkpoint_folder_is_read_from_the_session():
    assert checkpoint_dir(_Session("yarn", "hdfs:///shared/ckpt")) == "hdfs:///shared/ckpt"


def test_local_session_without_folder_gets_a_temporary_one():
    assert checkpoint_dir(_Session("local[2]")).startswith("/")


def test_stored_tables_go_on_release(spark):
    scratch = Scratch(spark)
    table = scratch.table(spark.range(5), bucket_by="id")
    assert table.count() == 5 and checkpoint_dir(spark).removeprefix("file:") in table.inputFiles()[0]
    name = scratch.names[0]
    scratch.release()
    assert not spark.catalog.tableExists(name)


@pytest.mark.parametrize("name", ["knn_vote_documents", "term_frequency", "vocab_lookup", "logreg_history", "confusion_matrix"])
def test_queries_leave_nothing_behind(spark, name):
    catalog.release()
    catalog.QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    catalog.release()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    database = Scratch(spark).database
    assert spark.sql(f"SHOW TABLES IN {database}").where("not isTemporary").count() == 0
