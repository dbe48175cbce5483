"""Session helpers: the shared folder, lineage cuts, and rows spread over cores."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Folders that this process has settled.
_SETTLED: list[str] = []


def session(name: str = "tidelog", master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for; ``conf`` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | conf
    return SparkSession.builder.appName(name).master(master).config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach (``spark.checkpoint.dir``); where that is unset a local one, if master is local, and else an error."""
    said = spark.conf.get("spark.checkpoint.dir", None)
    if said:
        return said.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local(\[|\Z)", master):
        raise RuntimeError(f"on {master} executors share no local folder: set spark.checkpoint.dir")
    if not hasattr(spark, "_tidelog_dir"):
        spark._tidelog_dir = tempfile.mkdtemp(prefix="tidelog-")
        atexit.register(shutil.rmtree, spark._tidelog_dir, ignore_errors=True)
    return spark._tidelog_dir


def settled(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors, and is stored compressed."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    _SETTLED.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def swept(spark: SparkSession) -> int:
    """Delete what :func:`settled` has written in this process; frames that read it must not be used any more. Returns how many folders."""
    gone = 0
    while _SETTLED:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SETTLED.pop())
        gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return gone


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, if its input has fewer splits than there are: for rows that cost far more to work on than to move. A
    table of more splits stays where it lies."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def shipped(spark: SparkSession) -> SparkSession:
    """``spark``, once this package is on its way to the Python workers, wherever the executors were started."""
    context = spark.sparkContext
    if not hasattr(context, "_tidelog_shipped"):
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="tidelog-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        with zipfile.ZipFile(f"{folder}/tidelog.zip", "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(f"{folder}/tidelog.zip")
        context._tidelog_shipped = True
    return spark


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
