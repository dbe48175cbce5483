"""Whole jobs as documents: captures into log tables, messages into market events. ``kind`` names the job."""

from __future__ import annotations

import dataclasses
import time
from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import tables
from tidelog.functions import classify, codes, ident, tags
from tidelog.functions import values as V
from tidelog.operators import events as E
from tidelog.runtime import settled
from tidelog.shapes import read_document
from tidelog.sources import logs
from tidelog.sources.store import Table


@dataclass
class Report:
    job: str
    rows: int = 0
    written: dict[str, int] = field(default_factory=dict)
    seconds: float = 0.0

    @property
    def skipped(self) -> int:
        return self.rows - sum(self.written.values())


@dataclass
class Job:
    kinds: ClassVar[dict[str, type]] = {}

    def __init_subclass__(cls, kind: str = "", **more):
        super().__init_subclass__(**more)
        Job.kinds[kind] = cls

    @classmethod
    def from_dict(cls, doc: dict) -> "Job":
        """Unknown keys are ignored, an unknown kind is refused."""
        kind = doc.get("kind")
        if kind not in Job.kinds:
            raise ValueError(f"no job is of kind {kind}: there are {', '.join(sorted(Job.kinds))}")
        job = Job.kinds[kind]
        names = {f.name for f in dataclasses.fields(job)}
        return job(**{k: v for k, v in doc.items() if k in names})

    @classmethod
    def read(cls, path: str) -> "Job":
        return cls.from_dict(read_document(path))

    def run(self, spark: SparkSession) -> Report:
        raise NotImplementedError


@dataclass
class ParseLogs(Job, kind="parse_logs"):
    """Captures under ``source`` into ``target``, or into one table per event type with ``split``; rows that are stored already are left."""

    source: list[str] | str
    target: str
    zone: str | None = None
    pattern: str = "*"
    merge: bool = True
    split: bool = False
    limit: int | None = None
    message_layer: bool = True
    rules: list[dict] | None = None

    def rows(self, spark: SparkSession) -> DataFrame:
        df = logs.read_logs(spark, self.source, self.zone, self.pattern, message_layer=self.message_layer)
        if self.rules:
            df = df.withColumn("etype", classify.event_type(F.col("message"), tuple(classify.EventRule(**r) for r in self.rules)))
        return df.orderBy("url", "block", "pos").limit(self.limit) if self.limit else df

    def run(self, spark: SparkSession) -> Report:
        began = time.time()
        df = settled(self.rows(spark), "logs")
        report = Report("parse_logs", df.count())
        parts = {"": df}
        if self.split:
            found = [r[0] for r in df.select("etype").distinct().orderBy("etype").collect()]  # as many as there are event types
            parts = {f"/{c}": df.where(F.col("etype") == c) for c in found}
        for name, part in parts.items():
            table = Table(spark, self.target + name, tables.LOG)
            report.written[name.strip("/") or "all"] = table.insert_new(part, order=["runix"]) if self.merge else table.append(part)
        report.seconds = time.time() - began
        return report


def instrument_hash(i: Column) -> Column:
    """The identity of an instrument by the strongest key it has: identifier and its scheme, ISIN, exchange and symbol; 0 if it has none."""
    some = lambda name: F.nullif(i[name], F.lit(""))
    registered = some("security_id").isNotNull() & some("security_id_source").isNotNull()
    key = F.when(registered, F.struct(F.lit("id").alias("by"), i["security_id_source"].alias("scope"), i["security_id"].alias("name")))
    key = key.when(some("isin_code").isNotNull(), F.struct(F.lit("id").alias("by"), F.lit("4").alias("scope"), i["isin_code"].alias("name")))
    key = key.when(some("symbol").isNotNull(), F.struct(F.lit("symbol").alias("by"), F.coalesce(i["exchange"], F.lit("")).alias("scope"), i["symbol"].alias("name")))
    return F.when(key.isNull(), ident.NIL).otherwise(ident.ident(key["by"], key["scope"], key["name"], kinds=("string", "string", "string"))).cast("long")


def market_events(df: DataFrame, message: str = "message", venue: str | None = None, recorded: str | None = "unix") -> DataFrame:
    """The market events of messages, identified: ``df`` has ``message`` and perhaps the instant it was ``recorded``."""
    proto = classify.protocol(F.col(message))
    spoken = df.withColumn("_p", proto).where("_p <> 'OTHER'").withColumn("_id", F.monotonically_increasing_id())
    spoken = spoken.select("_id", F.col(message).alias("_m"), "_p", *([F.col(recorded).alias("_at")] if recorded and recorded in df.columns else [F.lit(None).cast("long").alias("_at")]))
    paired = tags.parse(spoken, "_m", "_raw", F.col("_p") == "UL").withColumn("pairs", tags.from_pairs(F.col("_raw"))).select("_id", "_at", "pairs")
    rows = E.events(paired.withColumnsRenamed({"_id": "source_id", "_at": "recorded"}), "pairs", venue)
    inst = rows.withColumn("instrument_hash", instrument_hash(F.col("instrument")))
    own = F.coalesce("order_id", "prev_client_order_id", "client_order_id")
    life = F.when(F.col("etype") == 110, own).otherwise(F.coalesce("exec_id", "trade_id"))
    named = F.when(F.col("etype") == 110, "Order").otherwise("Execution")
    inst = inst.withColumn("xhash", ident.ident(named, F.col("instrument_hash"), F.coalesce("venue", F.lit("")), life, kinds=("string", "long", "string", "string")))
    inst = inst.withColumn("version", F.lit(0).cast("long"))
    parts = [named, *map(F.col, ("xhash", "version", "unix", "state", "side", "px", "qty", "client_order_id", "filled_qty"))]
    inst = inst.withColumn("hash", ident.ident(*parts, kinds=("string", "long", "long", "long", "long", "long", "double", "double", "string", "double")))
    return inst.withColumns(
        {"notional": V.notional(F.col("px"), F.col("qty"), F.col("instrument.multiplier"), F.col("instrument.kind")), "cunix": F.col("unix"), "runix": F.coalesce("recorded", "unix"), "sunix": F.lit(None).cast("long"),
         "prev_hash": F.lit(None).cast("long"), "prev_state": F.lit(0), "prev_unix": F.lit(None).cast("long"), "parent_hash": F.lit(None).cast("array<long>")}
    )


@dataclass
class ParseMarket(Job, kind="parse_market"):
    """Messages of a log table (or of captures) into ``<target>/orders`` and ``<target>/executions``."""

    source: list[str] | str
    target: str
    venue: str | None = None
    merge: bool = True
    table: bool = False

    def run(self, spark: SparkSession) -> Report:
        began = time.time()
        lines = Table(spark, self.source).read(columns=["message", "unix"]) if self.table else logs.read_logs(spark, self.source, message_layer=False)
        df = settled(market_events(lines, venue=self.venue), "events")
        report = Report("parse_market", df.count())
        for name, code in (("orders", codes.EventType.ORDER), ("executions", codes.EventType.EXECUTION)):
            table = Table(spark, f"{self.target}/{name}", tables.EVENT)
            part = df.where(F.col("etype") == int(code))
            report.written[name] = table.insert_new(part, order=["runix"]) if self.merge else table.append(part)
        report.seconds = time.time() - began
        return report
