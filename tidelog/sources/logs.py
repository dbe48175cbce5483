"""Log captures on disk: folders of plain or compressed files into the fixed columns of a log line, and back."""

from __future__ import annotations

import fnmatch
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions import classify, tags
from tidelog.functions import values as V
from tidelog.functions.ident import digest

# fixed value: what a line that begins a record looks like: stamp, thread, driver, level, message
HEADER = r"(?s)^[ \t]*(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}[.,]\d{3}(?:[._,]?\d{3})?)[ \t]+\[([^\]]*)\][ \t]+\[([^\]]*)\][ \t]*(?:\(([A-Za-z]{1,12})\)[ \t]*)?(.*)\z"


def natural(path: str) -> tuple:
    """A sort key by which digits compare as numbers and come after text."""
    return tuple((1, int(x), x) if x.isdigit() else (0, 0, x) for x in re.findall(r"\d+|\D+", path))


def walk(roots: list[str], pattern: str = "*", recursive: bool = True, reverse: bool = False) -> list[str]:
    """The files under ``roots`` in the given order of roots, in natural order within; a root that isn't there is an error.

    Local paths are listed here; other stores are listed by Spark, give their files as roots.
    """
    out, seen = [], set()

    def into(folder: str) -> None:
        real = os.path.realpath(folder)
        if real in seen:
            return
        seen.add(real)
        entries = sorted(os.listdir(folder), key=natural, reverse=reverse)
        for e in entries:
            p = os.path.join(folder, e)
            if os.path.isfile(p) and fnmatch.fnmatchcase(e, pattern):
                out.append(p)
        if recursive:
            for e in entries:
                if os.path.isdir(os.path.join(folder, e)):
                    into(os.path.join(folder, e))

    for root in roots:
        if "://" in root:
            out.append(root)
        elif os.path.isfile(root):
            out.append(root)
        elif os.path.isdir(root):
            into(root)
        else:
            raise FileNotFoundError(root)
    return out


def lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """``url, block, pos, raw`` of every physical line: cut at newlines, one carriage return at the end dropped. ``(block, pos)`` orders
    the lines of a file; a block is what one task read, so a large plain file has many. Bytes that are no UTF-8 become U+FFFD."""
    df = spark.read.option("lineSep", "\n").text(files)
    return df.select(F.col("_metadata.file_path").alias("url"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), F.regexp_replace(F.make_valid_utf8("value"), r"\r\z", "").alias("raw"))


def folded(rows: DataFrame, head: Column) -> DataFrame:
    """``url, block, pos, raw, tail`` per line for which ``head`` is true; ``tail`` is the lines up to the next such line of the file, joined
    by newlines (null if none). Lines before the first are dropped. Blocks are looked at apart; only their last heads travel on."""
    at = F.when(F.col("head"), F.struct("block", "pos"))
    here = Window.partitionBy("url", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("head", F.coalesce(head, F.lit(False))).withColumn("start", F.max(at).over(here))
    carried = rows.groupBy("url", "block").agg(F.max("start").alias("last")).select("url", "block", F.max("last").over(before).alias("carried"))
    rows = rows.join(carried, ["url", "block"]).withColumn("start", F.coalesce("start", "carried")).where(F.col("start").isNotNull())
    further = F.array_sort(F.collect_list(F.when(~F.col("head"), F.struct("block", "pos", "raw"))))
    out = rows.groupBy("url", "start").agg(F.max(F.when(F.col("head"), F.col("raw"))).alias("raw"), F.transform(further, lambda x: x["raw"]).alias("further"))
    return out.select("url", "start.block", "start.pos", "raw", F.when(F.size("further") > 0, F.array_join("further", "\n")).alias("tail"))


def header_nanos(stamp: Column, zone: str | None = None) -> Column:
    """A header's stamp as nanoseconds: millis, and micros if it has any, whatever stands between."""
    digits = F.regexp_replace(F.substring(stamp, 21, 20), r"\D", "")
    second = F.concat(F.substring(stamp, 1, 10), F.lit(" "), F.substring(stamp, 12, 8))
    micros = F.rpad(digits, 6, "0").cast("long")
    return V.local_to_nanos(second, zone) + micros * 1000


def header_of(pattern: str, **groups: int) -> tuple[str, dict[str, int]]:
    """A header of one's own: a pattern that tells a first line, and which of its groups are the ``stamp``, ``thread``, ``driver`` and ``message`` (those
    that are not named are empty; stamp and message have to be)."""
    count, known = re.compile(pattern.replace(r"\z", r"\Z")).groups, ("stamp", "thread", "driver", "message")
    if {"stamp", "message"} - set(groups) or set(groups) - set(known) or not all(1 <= g <= count for g in groups.values()):
        raise ValueError(f"a header names groups from 1 to {count} as stamp and message, perhaps as thread and driver, not {groups}")
    return pattern, groups


def parsed(rows: DataFrame, zone: str | None = None, fold: bool = True, message_layer: bool = True, header: tuple[str, dict[str, int]] | None = None) -> DataFrame:
    """Physical lines (see :func:`lines`) as log rows: envelope, line columns, ``fix_tags``, ``keyval`` and the lifted columns. ``header``: see
    :func:`header_of`; a stamp is read as one of the usual header."""
    pattern, groups = header or (HEADER, {"stamp": 1, "thread": 2, "driver": 3, "message": 5})
    head = F.col("raw").rlike(pattern)
    found = folded(rows, head) if fold else rows.where(head).withColumn("tail", F.lit(None).cast("string"))
    part = lambda name: F.regexp_extract("raw", pattern, groups[name]) if name in groups else F.lit("")
    unix = header_nanos(part("stamp"), zone)
    df = found.select(
        "url", "block", "pos", unix.alias("unix"), part("thread").alias("thread_name"), part("driver").alias("driver_name"), F.concat_ws("\n", part("message"), "tail").alias("message"), digest(F.col("raw")).alias("hash")
    )
    df = df.withColumns({"unix_hour": V.hour_of(F.col("unix")), "etype": classify.event_type(F.col("message")), "protocol": classify.protocol(F.col("message"), F.col("driver_name"))})
    if message_layer:
        spoken = F.when(F.col("protocol") != "OTHER", F.col("message"))
        df = tags.lift(tags.parse(df.withColumn("_m", spoken), "_m", "_pairs", F.col("protocol") == "UL"), "_pairs").drop("_m", "_pairs")
        df = df.withColumn("symbol", F.coalesce("symbol", F.lit("")))
    else:
        df = df.withColumn("symbol", F.lit("")).withColumn("seq", F.lit(None).cast("long"))
    null = lambda t: F.lit(None).cast(t)
    return df.withColumns(
        {"cunix": F.col("unix"), "runix": F.col("unix"), "eunix": null("long"), "sunix": null("long"), "xhash": F.col("hash"), "version": F.lit(0).cast("long"), "state": F.lit(0),
         "prev_hash": null("long"), "prev_state": F.lit(0), "prev_unix": null("long"), "parent_hash": null("array<long>")}
    )


def read_logs(spark: SparkSession, roots: list[str] | str, zone: str | None = None, pattern: str = "*", recursive: bool = True, fold: bool = True, message_layer: bool = True, static: dict | None = None, header: tuple[str, dict[str, int]] | None = None) -> DataFrame:
    """The log rows of all files under ``roots``. ``static`` adds constant columns; a name that is taken is refused, as is a bare None."""
    files = walk([roots] if isinstance(roots, str) else list(roots), pattern, recursive)
    if not files:
        raise FileNotFoundError(f"no file under {roots} is called {pattern}")
    df = parsed(lines(spark, files), zone, fold, message_layer, header)
    for name, value in (static or {}).items():
        if name in df.columns:
            raise ValueError(f"{name} is a column already")
        if value is None:
            raise ValueError(f"{name}: None has no type; give a typed literal")
        df = df.withColumn(name, value if isinstance(value, Column) else F.lit(value))
    return df


def rendered(rows: DataFrame) -> DataFrame:
    """``value``: log rows as header lines, to the microsecond."""
    at = F.date_format(F.timestamp_micros(V.micros(F.col("unix"))), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return rows.select(F.concat(F.substring(at, 1, 23), F.lit("_"), F.substring(at, 24, 3), F.lit(" ["), F.coalesce("thread_name", F.lit("")), F.lit("] ["), F.coalesce("driver_name", F.lit("")), F.lit("] "), F.coalesce("message", F.lit(""))).alias("value"))


def write_logs(rows: DataFrame, path: str, compression: str | None = None) -> None:
    """Append log rows as text, in their order of time within each part. Merging is for tables, not for text."""
    out = rendered(rows.sortWithinPartitions("unix")).write.mode("append").option("lineSep", "\n")
    (out.option("compression", compression) if compression else out).text(path)


def ship(spark: SparkSession, roots: list[str], path: str, compression: str = "zstd") -> None:
    """The decoded lines of all files, re-compressed."""
    spark.read.option("lineSep", "\n").text(walk(roots)).write.option("compression", compression).text(path)
