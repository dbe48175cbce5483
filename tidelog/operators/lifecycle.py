"""Versions of a lifecycle: chains, what is carried from the version before, learnt reference data, pictures on a grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def version_chain(df: DataFrame, life: str = "xhash", order: tuple[str, ...] = ("unix", "hash"), hash_: str = "hash") -> DataFrame:
    """``df`` with ``version`` from 0 on and ``prev_hash`` (0 is none), ``prev_state``, ``prev_unix`` of the version before. Order by columns that leave no ties.
    A row without a lifecycle is a first version."""
    w = Window.partitionBy(life).orderBy(*order)
    lone = F.col(life).isNull()
    before = lambda c: F.when(~lone, F.lag(c).over(w))
    return df.withColumns(
        {"version": F.when(lone, 0).otherwise(F.row_number().over(w) - 1).cast("long"), "prev_hash": F.nullif(before(hash_), F.lit(0).cast("long")), "prev_state": F.coalesce(before("state"), F.lit(0)), "prev_unix": before("unix")}
    )


def carried(df: DataFrame, columns: list[str], life: str = "xhash", order: tuple[str, ...] = ("unix", "hash")) -> DataFrame:
    """Nulls of ``columns`` filled with the last value known in the lifecycle; ``cunix`` becomes its first instant."""
    w = Window.partitionBy(life).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = {c: F.when(F.col(life).isNull(), F.col(c)).otherwise(F.last(c, ignorenulls=True).over(w)) for c in columns}
    if "cunix" in df.columns:
        out["cunix"] = F.when(F.col(life).isNull(), F.col("cunix")).otherwise(F.first("unix", ignorenulls=True).over(w))
    return df.withColumns(out)


def fills(df: DataFrame, life: str = "order_xhash", order: tuple[str, ...] = ("unix", "hash"), ordered: str | None = None) -> DataFrame:
    """Running figures of trades: ``filled_qty``, ``avg_px`` (by quantity), and ``leaves_qty`` of the quantity in ``ordered``, not below 0."""
    w = Window.partitionBy(life).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    have = F.col("px").isNotNull() & F.col("qty").isNotNull()
    done = F.coalesce(F.sum(F.when(have, F.col("qty"))).over(w), F.lit(0.0))
    worth = F.sum(F.when(have, F.col("px") * F.col("qty"))).over(w)
    out = {"filled_qty": done, "avg_px": F.when(done != 0, worth / done)}
    if ordered:
        out["leaves_qty"] = F.greatest(F.col(ordered) - done, F.lit(0.0))
    return df.withColumns(out)


def learnt(df: DataFrame, by: str, fields: list[str], order: tuple[str, ...] = ("unix",)) -> DataFrame:
    """A row each time something new is learnt of ``by``: a field is filled once and never corrected. ``by``, the order columns, ``version``, fields.

    For each field its first value is found by a combining aggregation, so a hot key isn't gathered; only these firsts are put in order."""
    at = F.struct(*order)
    firsts = df.groupBy(by).agg(*[F.min_by(F.struct(at.alias("at"), F.col(f).alias("v")), F.when(F.col(f).isNotNull(), at)).alias(f) for f in fields])
    firsts = firsts.select(by, *[F.when(F.col(f"{f}.v").isNotNull(), F.col(f)).alias(f) for f in fields])
    moments = firsts.select(by, F.explode(F.array_distinct(F.array_compact(F.array(*[F.col(f"{f}.at") for f in fields])))).alias("at"), *fields)
    w = Window.partitionBy(by).orderBy("at")
    return moments.select(by, "at.*", (F.row_number().over(w) - 1).cast("long").alias("version"), *[F.when(F.col(f"{f}.at") <= F.col("at"), F.col(f"{f}.v")).alias(f) for f in fields])


def grid(df: DataFrame, by: list[str], every: int = 3_600_000_000_000, order: tuple[str, ...] = (), until: str = "clock") -> DataFrame:
    """A picture of the last row of each key at every boundary strictly between it and the key's next row; after a key's last row up to the
    last boundary before the latest instant of all rows. Columns of ``df``, ``unix`` at the boundary, ``sunix`` the instant of what it shows.

    Of several rows of a key at one instant the last by ``order`` counts."""
    end = df.agg(F.max("unix").alias("end"))
    w = Window.partitionBy(*by).orderBy("unix", *order)
    nxt = F.coalesce(F.lead("unix").over(w), F.col("end"))
    rows = df.withColumn("_one", F.lit(1)).join(F.broadcast(end.withColumn("_one", F.lit(1))), "_one").drop("_one").withColumn("_next", nxt)
    first = F.col("unix") - F.pmod("unix", F.lit(every)) + every
    last = F.col("_next") - 1 - F.pmod(F.col("_next") - 1, F.lit(every))
    rows = rows.withColumn("_at", F.when(first <= last, F.sequence(first, last, F.lit(every).cast("long"))))
    keep = [c for c in df.columns if c not in ("unix", "sunix")]
    return rows.select(*keep, F.col("unix").alias("sunix"), F.explode("_at").alias("unix")).select(*by, "unix", "sunix", *[c for c in keep if c not in by])
