"""Where intermediate tables go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from asterline import session


class Context:
    def __init__(self, master, directory=None):
        self.master, self.directory = master, directory

    def getCheckpointDir(self):
        return self.directory

    def setCheckpointDir(self, directory):
        self.directory = f"{directory}/some-uuid"


def fake(master, configured=None):
    conf = SimpleNamespace(get=lambda key, default: configured if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(sparkContext=Context(master), conf=conf)


def test_the_cluster_names_the_folder():
    spark = fake("yarn", "hdfs:///shared")
    assert session.shared_dir(spark) == "hdfs:///shared"
    assert session.scratch(spark, "x").startswith("hdfs:///shared/asterline/x-")
    assert session.scratch(spark, "x") != session.scratch(spark, "x")


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("spark://host:7077"))


def test_only_a_local_master_falls_back_on_its_warehouse():
    spark = fake("local[4]")
    first = session.shared_dir(spark)
    assert first == "spark-warehouse/_asterline-shared" and session.shared_dir(spark) == first


def test_stored_and_cut_keep_the_rows(spark):
    df = spark.range(5).select((F.col("id") * 2).alias("n"))
    assert session.stored(df, "t").count() == session.cut(df).count() == 5
