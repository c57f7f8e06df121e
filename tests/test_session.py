from types import SimpleNamespace

import pytest

from tidemark.session import shared_folder


class Conf(dict):
    def set(self, key, value):
        self[key] = value


def session(master, **conf):
    return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,3000]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(master))


def test_the_named_folder_wins_and_a_local_session_gets_its_own():
    named = session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_folder(named) == "hdfs:///shared"
    local = session("local[8]")
    assert shared_folder(local) == shared_folder(local)


def test_scan_tasks_stay_small(spark, tmp_path):
    """A scan task sorts what it decodes before a shuffle, so large files are read in pieces, however few cores there are."""
    from tidemark.session import prepare

    path = tmp_path / "t.txt"
    path.write_text(("x" * 99 + "\n") * 400_000)
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert prepare(spark).read.text(str(path)).rdd.getNumPartitions() >= 3
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum") if before is None else spark.conf.set("spark.sql.files.minPartitionNum", before)
