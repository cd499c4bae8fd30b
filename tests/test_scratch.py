import pytest

from tidemark import scratch


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value or default


class Session:
    def __init__(self, value, app, master="local[2]"):
        self.conf = Conf(value)
        self.sparkContext = type("Context", (), {"applicationId": app, "master": master})


def test_shared_folder_is_the_one_named():
    assert scratch.shared_dir(Session("hdfs://x/y/", "a")) == "hdfs://x/y"
    own = scratch.shared_dir(Session(None, "b"))
    assert own.startswith("file:///") and scratch.shared_dir(Session(None, "b")) == own != scratch.shared_dir(Session(None, "c"))
    with pytest.raises(ValueError):
        scratch.shared_dir(Session(None, "d", "spark://host:7077"))
    assert scratch.new_path(Session("s3://k", "d"), "n") != scratch.new_path(Session("s3://k", "d"), "n")


def test_written_tables_keep_their_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    assert sorted(map(tuple, scratch.written(df, "t").collect())) == sorted(map(tuple, df.collect())) and scratch.written(df.limit(0), "t").schema.names == ["a", "b"]
    assert scratch.spread(df).count() == 2
