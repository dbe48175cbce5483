"""Order books: summaries of sides and books, and price levels from order versions without a fold over one instrument in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import codes
from tidelog.functions import values as V


def side_summary(alive: Column) -> dict[str, Column]:
    """``px, qty`` of the best level, ``depth`` and ``total_qty``; an empty side has no price, depth 0 and total 0.0; of a null one all are null."""
    best = F.get(alive, F.lit(0))
    return {"px": best["px"], "qty": best["qty"], "depth": F.when(alive.isNotNull(), F.size(alive)), "total_qty": F.aggregate(alive, F.lit(0.0), lambda a, x: a + F.coalesce(x["qty"], F.lit(0.0)))}


def summarise_side(df: DataFrame) -> DataFrame:
    """A null ``alive`` keeps what is there."""
    new = side_summary(F.col("alive"))
    return df.withColumns({k: F.when(F.col("alive").isNull(), F.col(k)).otherwise(v) for k, v in new.items()})


def book_summary(bid: dict[str, Column], ask: dict[str, Column]) -> dict[str, Column]:
    """Middle price, spread, size-weighted price and imbalance of two sides; the last two are null unless there is size."""
    size = bid["qty"] + ask["qty"]
    return {
        "px": (bid["px"] + ask["px"]) / 2, "qty": size, "spread": ask["px"] - bid["px"],
        "micro_px": F.when(size > 0, (bid["px"] * ask["qty"] + ask["px"] * bid["qty"]) / size), "imbalance": F.when(size > 0, (bid["qty"] - ask["qty"]) / size),
    }


def level_changes(orders: DataFrame, instrument: str = "instrument_hash", order: tuple[str, ...] = ("version", "row_id")) -> DataFrame:
    """What each order version does to the levels of its book: ``instrument, unix, side (1 bid, -1 ask), px, delta``.

    A version withdraws what the one before it had resting and puts its own there, nothing if it is terminal. Versions without a lifecycle, side or
    instant do nothing; without a price nothing rests."""
    w = Window.partitionBy("xhash").orderBy("unix", *order)
    rests = F.when((codes.sign(F.col("side")) != 0) & ~codes.is_terminal(F.col("state")) & F.col("px").isNotNull(), V.resting(F.col("display_qty"), F.col("leaves_qty"), F.col("qty"))).otherwise(0.0)
    now = F.struct(codes.sign(F.col("side")).alias("side"), F.col("px").alias("px"), rests.alias("qty"))
    rows = orders.where("xhash is not null and unix is not null").withColumn("_now", now).withColumn("_before", F.lag("_now").over(w))
    both = F.array(
        F.struct(F.col("_before.side").alias("side"), F.col("_before.px").alias("px"), (-F.col("_before.qty")).alias("delta")),
        F.struct(F.col("_now.side").alias("side"), F.col("_now.px").alias("px"), F.col("_now.qty").alias("delta")),
    )
    moved = rows.select(instrument, "unix", F.inline(both)).where("px is not null and delta <> 0")
    return moved.groupBy(instrument, "unix", "side", "px").agg(F.sum("delta").alias("delta")).where("delta <> 0")


def levels(changes: DataFrame, instrument: str = "instrument_hash") -> DataFrame:
    """The quantity of each price level after each instant that changed it. The window is per level, so an instrument is spread over as many tasks as it has levels."""
    w = Window.partitionBy(instrument, "side", "px").orderBy("unix").rowsBetween(Window.unboundedPreceding, 0)
    return changes.select(instrument, "side", "px", "unix", F.round(F.sum("delta").over(w), 9).alias("qty"))


def best_at_hours(level_rows: DataFrame, instrument: str = "instrument_hash", every: int = V.HOUR) -> DataFrame:
    """The best bid and ask of each instrument at the end of each hour in which one of its levels changed, from the last state of each level.

    ``instrument, unix, bid_px, bid_qty, bid_depth, ask_px, ask_qty, ask_depth``. Levels are carried over hours as intervals, so no book is gathered."""
    hour = F.col("unix") - F.pmod("unix", F.lit(every)) + every
    last = level_rows.withColumn("hour", hour).groupBy(instrument, "side", "px", "hour").agg(F.max_by("qty", "unix").alias("qty"))
    hours = last.select(instrument, "hour").distinct()
    nth = hours.withColumn("n", F.row_number().over(Window.partitionBy(instrument).orderBy("hour")))
    placed = last.join(nth, [instrument, "hour"])
    total = nth.groupBy(instrument).agg(F.max("n").alias("total"))
    w = Window.partitionBy(instrument, "side", "px").orderBy("n")
    spans = placed.join(total, instrument).withColumn("upto", F.coalesce(F.lead("n").over(w) - 1, F.col("total"))).where("qty > 0")
    at = spans.select(instrument, "side", "px", "qty", F.explode(F.sequence("n", "upto")).alias("n"))
    buy, sell = F.col("side") == 1, F.col("side") == -1
    best = at.groupBy(instrument, "n").agg(
        F.max(F.when(buy, F.struct("px", "qty"))).alias("bid"), F.min(F.when(sell, F.struct("px", "qty"))).alias("ask"), F.count_if(buy).alias("bid_depth"), F.count_if(sell).alias("ask_depth")
    )
    out = nth.join(best, [instrument, "n"], "left")
    return out.select(
        instrument, F.col("hour").alias("unix"), F.col("bid.px").alias("bid_px"), F.col("bid.qty").alias("bid_qty"), F.coalesce("bid_depth", F.lit(0)).alias("bid_depth"),
        F.col("ask.px").alias("ask_px"), F.col("ask.qty").alias("ask_qty"), F.coalesce("ask_depth", F.lit(0)).alias("ask_depth"),
    )
