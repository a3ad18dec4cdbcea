from __future__ import annotations

from pathlib import Path

import pytest

from derlem import session


def test_materialize_and_release(spark):
    session.release(spark)
    df = session.materialize(spark.range(5).selectExpr("id", "id * 2 AS b"), "x")
    folder = Path(session.shared_folder(spark).removeprefix("file://"))
    assert sorted(map(tuple, df.collect())) == [(i, 2 * i) for i in range(5)]
    assert len(list(folder.glob("x-*"))) == 1
    assert session.release(spark) == 1 and not list(folder.glob("x-*"))


class Conf:
    def __init__(self, folder, master):
        self.folder, self.master, self.sparkContext, self.conf = folder, master, self, self

    def get(self, key, default=None):
        return self.folder if key == session.CHECKPOINT_KEY else default


def test_the_cluster_folder_is_used_and_never_a_local_one_there():
    assert session.shared_folder(Conf("hdfs:///x/", "spark://m:7077")) == "hdfs:///x"
    assert session.shared_folder(Conf("file:///y", "local[2]")) == "file:///y"
    own = session.shared_folder(Conf(None, "local[2]"))
    assert own.startswith("file://") and session.shared_folder(Conf(None, "local[2]")) == own
    with pytest.raises(ValueError, match="share"):
        session.shared_folder(Conf(None, "spark://m:7077"))
    with pytest.raises(ValueError, match="share"):
        session.shared_folder(Conf(None, "local-cluster[2,1,1024]"))


def test_workers_are_told_where_the_package_is(spark):
    session.share_package(spark)
    session.share_package(spark)
    assert spark.sparkContext.environment["PYTHONPATH"].split(":").count(str(Path(session.__file__).resolve().parent.parent)) == 1
