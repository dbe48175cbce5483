"""The shared folder, and what is left in it."""

import types
from pathlib import Path

import pytest

from tidelog import runtime


def test_shared_folder(spark):
    conf = lambda said: types.SimpleNamespace(get=lambda name, other=None: said)
    on = lambda master, said=None: types.SimpleNamespace(conf=conf(said), sparkContext=types.SimpleNamespace(master=master))
    assert runtime.shared_dir(on("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    for master in ("yarn", "local-cluster[3,2,1024]", "spark://host:7077"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            runtime.shared_dir(on(master))
    for master in ("local", "local[4]", "local[*]"):
        assert Path(runtime.shared_dir(on(master))).is_dir()


def test_swept(spark):
    df = runtime.settled(spark.range(5), "five")
    folder = Path(df.inputFiles()[0].removeprefix("file://")).parent
    assert df.count() == 5 and folder.is_dir()
    assert runtime.swept(spark) >= 1 and not folder.exists() and runtime.swept(spark) == 0


def test_spread(spark):
    few = spark.range(100, numPartitions=1)
    assert runtime.spread(few).rdd.getNumPartitions() == 4 and runtime.spread(spark.range(100, numPartitions=9)).rdd.getNumPartitions() == 9
    assert runtime.spread(few).count() == 100
