"""Indexes made of immutable runs: folders of Parquet that are never changed, and a list that names those in force.

The list is a small document with a version; a change writes new runs beside the old ones and then the next version of the list, which
fails if another has written it meanwhile. So a job that is lost leaves the index as it was. Runs of a level are merged as soon as there
are ``FAN`` of them: a record is rewritten as often as the logarithm of the number of runs. The file system must create a file only if
it is not there (local ones and HDFS do; plain object stores need a committer of their own).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.store import Files

#: Runs of a level that are merged into one of the next.
FAN = 8
#: Deliveries that are taken in together when several wait.
WAITING = 10


class RunList:
    """The runs under ``path``: each has a ``name`` (its folder), a ``level`` and whatever else the index notes of it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)

    def head(self) -> dict:
        """The list in force: ``version``, ``runs``, and what else was noted."""
        names = [s.getPath().getName() for s in self.files.list("head")]
        versions = [int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
        return json.loads(self.files.read(f"head/{max(versions):012d}.json")) if versions else {"version": 0, "runs": []}

    def publish(self, base: dict, **changes) -> dict:
        """The next version after ``base``; a conflict if there is one already."""
        new = base | changes | {"version": base["version"] + 1}
        self.files.create(f"head/{new['version']:012d}.json", json.dumps(new))
        return new

    def fresh(self) -> tuple[str, str]:
        """The name and the folder of a run to be written."""
        name = f"run-{uuid.uuid4().hex}"
        return name, f"{self.path}/{name}"

    def read(self, runs: list[dict], schema: str) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{r['name']}" for r in runs])

    @staticmethod
    def due(head: dict) -> list[dict]:
        """The runs that are to be merged next, if any: those of the lowest level that has ``FAN``."""
        for level in sorted({r["level"] for r in head["runs"]}):
            same = [r for r in head["runs"] if r["level"] == level]
            if len(same) >= FAN:
                return same
        return []

    def vacuum(self) -> list[str]:
        """Delete the folders that no list names any more and all lists but the last. Readers of older versions must have ended."""
        head = self.head()
        named = {r["name"] for r in head["runs"]}
        gone = [s.getPath().getName() for s in self.files.list(".") if s.isDirectory() and s.getPath().getName().startswith("run-") and s.getPath().getName() not in named]
        for name in gone:
            self.files.delete(name, True)
        for s in self.files.list("head"):
            n = s.getPath().getName()
            if n.endswith(".json") and not n.startswith(".") and int(n.split(".")[0]) < head["version"]:
                self.files.delete(f"head/{n}")
        return gone


def within(column: str, values: list[int], ranges: int = 100) -> Column:
    """A filter that holds for sorted ``values``, as at most so many ranges, so that it reaches the scan."""
    step = -(-len(values) // ranges) or 1
    out = F.lit(False)
    for i in range(0, len(values), step):
        out = out | F.col(column).between(values[i], values[min(i + step, len(values)) - 1])
    return out


def waiting(rows: DataFrame, together: int = WAITING) -> list[DataFrame]:
    """The deliveries of ``rows`` in the order of ``batch_id``, a null one first, so many of them at a time."""
    ids = sorted((r[0] for r in rows.select("batch_id").distinct().collect()), key=lambda b: (b is not None, b))  # the driver knows each delivery anyway
    out = []
    for i in range(0, len(ids), together):
        some = [b for b in ids[i : i + together] if b is not None]
        mine = F.col("batch_id").between(min(some), max(some)) if some else F.lit(False)
        out.append(rows.where(mine | F.col("batch_id").isNull() if ids[i] is None else mine))
    return out
