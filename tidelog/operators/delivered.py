"""Exactly one copy of each message that was delivered at least once.

An identifier is a pair of 64-bit hashes. Accepted identifiers are kept on disk as sorted arrays ("runs"), cut by hash prefix into blocks
of bounded size; each incoming batch is deduplicated in itself, its identifiers are looked up in the blocks of their prefix by binary
search, and what is novel becomes a run of its own. Runs are never changed; runs of a level are merged into one of the next. The
copies of an identifier within a batch are combined before anything is shuffled, so a message that makes up a third of all rows
costs one entry per batch and task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.runtime import settled, shared_dir
from tidelog.sources.runs import WAITING, RunList, waiting, within

#: Identifiers that a block is made for (24 bytes each); if blocks get four times as long, the next merge takes longer prefixes.
BLOCK_IDS = 65_536
#: Prefixes from which on it is worth asking which of them a batch touches.
MANY_PREFIXES = 4_096


class Runs:
    """Sorted runs of identifiers ``(hi, lo)`` with the representative row of each."""

    def __init__(self, runs: list[np.ndarray]):
        self.runs = runs

    KIND = np.dtype([("hi", "<i8"), ("lo", "<i8"), ("row", "<i8")])

    @classmethod
    def run(cls, hi: np.ndarray, lo: np.ndarray, row: np.ndarray) -> np.ndarray:
        """A sorted run, each identifier once, with its smallest row."""
        order = np.lexsort((row, lo, hi))
        out = np.empty(len(hi), cls.KIND)
        out["hi"], out["lo"], out["row"] = hi[order], lo[order], row[order]
        if len(out) > 1:
            out = out[np.concatenate([[True], (out["hi"][1:] != out["hi"][:-1]) | (out["lo"][1:] != out["lo"][:-1])])]
        return out

    @staticmethod
    def _find(run: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Positions in ``run``, -1 where it hasn't the identifier."""
        at = np.searchsorted(run["hi"], hi)
        found = np.full(len(hi), -1, np.int64)
        open_ = np.arange(len(hi))
        while len(open_):  # more than one step only where 64-bit hashes collide
            ok = at[open_] < len(run)
            open_ = open_[ok]
            same = run["hi"][at[open_]] == hi[open_]
            open_ = open_[same]
            hit = run["lo"][at[open_]] == lo[open_]
            found[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
        return found

    def look_up(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each identifier of a run its representative row, and whether one of these runs has it."""
        rep, known = batch["row"].copy(), np.zeros(len(batch), bool)
        for run in self.runs:
            at = self._find(run, batch["hi"], batch["lo"])
            rep[at >= 0] = np.where(known[at >= 0], np.minimum(rep[at >= 0], run["row"][at[at >= 0]]), run["row"][at[at >= 0]])
            known |= at >= 0
        return rep, known

    @classmethod
    def merged(cls, runs: list[np.ndarray]) -> np.ndarray:
        one = np.concatenate(runs)
        return cls.run(one["hi"], one["lo"], one["row"])


def identity(*parts: Column) -> tuple[Column, Column]:
    """``hi, lo`` of the parts, both null if any part is."""
    text = F.concat_ws("\x1f", *[F.concat(F.octet_length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")) for p in parts])
    whole = parts[0].isNotNull()
    for p in parts[1:]:
        whole = whole & p.isNotNull()
    return F.when(whole, F.xxhash64(text, F.lit(1))), F.when(whole, F.xxhash64(text, F.lit(2)))


_RUN = "prefix int, ids binary, many int, hi long, lo long, rep long, known boolean"


class DeliveredIndex:
    """The identifiers accepted so far, as runs under ``path``.

    A run has a row per prefix with its sorted identifiers (``ids``), and beside these, for the batch it came from, a row for each
    identifier that was there before (``known``) or more than once in the batch: ``hi, lo, rep``. Rows without an identifier are copies of
    nothing.
    """

    def __init__(self, spark, path: str, bits: int = 4):
        """``bits``: of the prefix, in the beginning."""
        self.list, self.bits = RunList(spark, path), bits

    @staticmethod
    def _prefix(bits: int) -> Column:
        return (F.shiftrightunsigned("hi", 64 - bits) if bits else F.lit(0)).cast("int")

    def accept_ids(self, ids: DataFrame) -> DataFrame:
        """Take in a batch (``hi, lo, row_id``), or several that wait (then with ``batch_id``): ``hi, lo, rep, known`` of the identifiers that were
        there before or come more than once; ``rep`` is the row that is kept."""
        head = self.list.head()
        bits = head.get("bits", self.bits)
        first = F.min(F.struct("batch_id", "row_id"))["row_id"] if "batch_id" in ids.columns else F.min("row_id")
        entries = ids.where(F.col("hi").isNotNull()).groupBy("hi", "lo").agg(first.alias("row_id"), F.count("*").alias("n")).withColumn("prefix", self._prefix(bits))
        stored = self.list.read(head["runs"], _RUN).where(F.col("ids").isNotNull()).select("prefix", "ids")
        if 1 << bits >= MANY_PREFIXES:
            entries = settled(entries, "batch-ids")
            stored = stored.where(within("prefix", [r[0] for r in entries.select("prefix").distinct().orderBy("prefix").collect()]))  # fewer than blocks in the index

        def look_up(batch: pa.Table, blocks: pa.Table) -> pa.Table:
            if not batch.num_rows:
                return pa.Table.from_pylist([], _RUN_ARROW)
            runs = Runs([np.frombuffer(b.as_buffer(), Runs.KIND) for b in blocks.column("ids")])
            hi, lo, row, n = (batch.column(c).to_numpy() for c in ("hi", "lo", "row_id", "n"))
            order = np.lexsort((lo, hi))
            ours = Runs.run(hi, lo, row)
            rep, known = runs.look_up(ours)
            novel, told = ours[~known], known | (n[order] > 1)
            p = batch.column("prefix")[0].as_py()
            size = int(told.sum())
            out = pa.table([pa.array([p] * size, pa.int32()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.int32()), ours["hi"][told], ours["lo"][told], rep[told], known[told]], schema=_RUN_ARROW)
            block = pa.Table.from_pylist([{"prefix": p, "ids": novel.tobytes(), "many": len(novel)}] if len(novel) else [], _RUN_ARROW)
            return pa.concat_tables([out, block])

        name, folder = self.list.fresh()
        entries.groupBy("prefix").cogroup(stored.groupBy("prefix")).applyInArrow(look_up, _RUN).write.option("compression", "zstd").parquet(folder)
        run = {"name": name, "level": 0}
        self.list.publish(head, bits=bits, runs=[*head["runs"], run])
        return self.list.read([run], _RUN).where(F.col("ids").isNull()).select("hi", "lo", "rep", "known")

    def accept(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` (``hi, lo, row_id`` and any other columns) to be kept: without an identifier, or of a novel one the smallest ``row_id``."""
        told = self.accept_ids(batch.select("hi", "lo", "row_id"))
        rows = batch.join(told, ["hi", "lo"], "left").where(F.col("rep").isNull() | (~F.col("known") & (F.col("row_id") == F.col("rep"))))
        return rows.select(*batch.columns)

    def merge(self, everything: bool = False) -> bool:
        """Merge the runs of a level that has enough of them, or ``everything``; whether there was anything to do. New runs are written beside the
        old ones, which stay in force until then; :meth:`RunList.vacuum` deletes them."""
        head = self.list.head()
        runs = head["runs"] if everything else self.list.due(head)
        if len(runs) < 2:
            return False
        bits = head["bits"]
        blocks = self.list.read(head["runs"], _RUN).where(F.col("ids").isNotNull())
        total = blocks.agg(F.sum("many")).first()[0] or 0
        if total > 4 * BLOCK_IDS << bits:  # blocks of all runs are cut anew, so all are merged
            bits, runs = max(bits, (total // BLOCK_IDS).bit_length()), head["runs"]

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for ids in b.column("ids"):
                    run = np.frombuffer(ids.as_buffer(), Runs.KIND)
                    prefix = (run["hi"].view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(run), np.int64)
                    found = np.unique(prefix)
                    parts = [run[prefix == p].tobytes() for p in found]
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(parts, pa.binary())], ["prefix", "ids"])

        def merged(group: pa.Table) -> pa.Table:
            run = Runs.merged([np.frombuffer(b.as_buffer(), Runs.KIND) for b in group.column("ids")])
            return pa.Table.from_pylist([{"prefix": group.column("prefix")[0].as_py(), "ids": run.tobytes(), "many": len(run)}], _RUN_ARROW)

        name, folder = self.list.fresh()
        parts = self.list.read(runs, _RUN).where(F.col("ids").isNotNull()).select("ids").mapInArrow(cut, "prefix int, ids binary")
        parts.groupBy("prefix").applyInArrow(merged, _RUN).write.option("compression", "zstd").parquet(folder)
        gone = {r["name"] for r in runs}
        kept = [r for r in head["runs"] if r["name"] not in gone]
        self.list.publish(head, bits=bits, runs=[*kept, {"name": name, "level": max(r["level"] for r in runs) + 1}])
        return True


_RUN_ARROW = pa.schema([("prefix", pa.int32()), ("ids", pa.binary()), ("many", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64()), ("rep", pa.int64()), ("known", pa.bool_())])


def representatives(ids: DataFrame, path: str | None = None, together: int = WAITING) -> DataFrame:
    """``hi, lo, rep`` of every identifier that has more than one row in ``ids`` (``batch_id, hi, lo, row_id``), taken in by a
    :class:`DeliveredIndex` under ``path`` (else in the shared folder), so many deliveries at a time.

    ``rep`` is the smallest row of the first batch that brought it. Rows with a null identifier are no copies of
    anything; a null batch comes before all others.
    """
    index = DeliveredIndex(ids.sparkSession, path or f"{shared_dir(ids.sparkSession)}/delivered-{uuid.uuid4().hex}")
    told = [ids.sparkSession.createDataFrame([], "hi long, lo long, rep long, known boolean")]
    for some in waiting(ids, together):
        told.append(index.accept_ids(some))
        while index.merge():
            pass
    return reduce(DataFrame.union, told).groupBy("hi", "lo").agg(F.min("rep").alias("rep"))


def linked(edges: DataFrame) -> DataFrame:
    """``rep, label``: of the components that ``edges`` (``link, rep``) make, the smallest ``rep`` for each ``rep``.

    Smallest labels are handed along the links, both directions combined before each shuffle, until none changes.
    """
    edges = settled(edges.distinct(), "edges")
    labels = edges.select("rep").distinct().withColumn("label", F.col("rep"))
    while True:
        of_link = edges.join(labels, "rep").groupBy("link").agg(F.min("label").alias("label"))
        handed = edges.join(of_link, "link").groupBy("rep").agg(F.min("label").alias("least"))
        # a label that is itself labelled lower takes that one: halves the way
        step = labels.join(handed, "rep").withColumn("next", F.least("label", "least"))
        step = settled(step.select("rep", F.col("next").alias("label"), (F.col("next") < F.col("label")).alias("moved")), "labels")
        changed = not step.where("moved").isEmpty()
        labels = step.select("rep", "label")
        if not changed:
            return labels
        jump = labels.select(F.col("rep").alias("label"), F.col("label").alias("further"))
        labels = labels.join(jump, "label", "left").select("rep", F.coalesce("further", "label").alias("label"))


def message_copies(log: DataFrame) -> DataFrame:
    """``row_id`` of every row of ``log`` that is a further copy of a message: all but the smallest of each message.

    Only rows with ``seq`` are messages. Sender (whatever its case and blanks around it), target, ``seq`` and the UTC day of first
    sending make the identity; a row that lacks one of them is a message of its own. A row with true ``poss_resend`` also
    links all rows of like sender, target, ``msg_type``, ``cl_ord_id`` (not null) and ``exec_id`` (null equals null).
    """
    sender = F.upper(F.regexp_replace("sender_comp_id", r"(?U)\A\s+|\s+\z", ""))
    day = F.expr("(coalesce(orig_sending_unix, sending_unix) - pmod(coalesce(orig_sending_unix, sending_unix), 86400000000000L)) div 86400000000000L")
    hi, lo = identity(sender, F.col("target_comp_id"), F.col("seq"), day)
    hi2, lo2 = identity(sender, F.col("target_comp_id"), F.coalesce("msg_type", F.lit("")), F.col("cl_ord_id"), F.coalesce(F.concat(F.lit("="), "exec_id"), F.lit("")))
    rows = log.where(F.col("seq").isNotNull())
    ids = rows.select("batch_id", "row_id", hi.alias("hi"), lo.alias("lo"))
    reps = settled(representatives(ids), "reps")
    copies = ids.join(reps, ["hi", "lo"]).where(F.col("row_id") != F.col("rep")).select("row_id")
    # resends: all rows that share the second identity with one, as links between representatives
    seconds = rows.select("row_id", "poss_resend", hi.alias("hi"), lo.alias("lo"), hi2.alias("hi2"), lo2.alias("lo2")).where(F.col("hi2").isNotNull())
    resent = seconds.where(F.col("poss_resend")).select("hi2", "lo2").distinct()
    edges = seconds.join(resent, ["hi2", "lo2"]).join(reps, ["hi", "lo"], "left").select(F.struct("hi2", "lo2").alias("link"), F.coalesce("rep", "row_id").alias("rep"))
    labels = linked(edges)
    return copies.union(labels.where(F.col("label") < F.col("rep")).select(F.col("rep").alias("row_id")))
