"""The shared folder: taken from the session, made only where driver and executors are one."""

from types import SimpleNamespace

import pytest

from marginloom.staging import NoSharedFolder, shared_folder, staged, staged_together


class Conf(dict):
    def set(self, key, value):
        self[key] = value


def session(master, **conf):
    return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(NoSharedFolder, match="spark.checkpoint.dir"):
        shared_folder(session(master))
    assert shared_folder(session(master, **{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[2,3]"])
def test_a_local_session_gets_one(master):
    spark = session(master)
    folder = shared_folder(spark)
    assert folder.startswith("file:///") and shared_folder(spark) == folder


def test_staged_tables_keep_rows_and_types(spark):
    df = spark.sql("SELECT 1 AS a, CAST(2 AS DECIMAL(18,4)) AS b, CAST(NULL AS DATE) AS c")
    kept = staged(df, "few")
    assert kept.dtypes == df.dtypes and kept.collect() == df.collect()


def test_tables_staged_together(spark):
    a, b = staged_together({"a": spark.range(3), "b": spark.range(5).selectExpr("id * 2 AS twice")})
    assert (a.columns, a.count(), b.columns, b.count()) == (["id"], 3, ["twice"], 5)
    with pytest.raises(Exception, match="lost"):
        staged_together({"a": spark.range(3), "b": spark.range(5).selectExpr("raise_error('lost') AS x")})
