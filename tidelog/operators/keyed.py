"""Per-key totals when a few keys hold most rows.

Every input split is reduced by the task that reads it: keys are dictionary-encoded, measures are added up in dense
arrays by ``bincount``, and the task hands on one block of at most ``BLOCK`` keys at a time. So a key costs at most one
entry per task however many rows it has, and the blocks are then added up by an ordinary partial aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 4096


class DenseTotals:
    """Keys of one split and their accumulators: row count, and for each measure its sum and its count of non-null values."""

    def __init__(self, measures: int):
        self.codes: dict = {}
        self.rows = np.zeros(64, np.int64)
        self.sums = [np.zeros(64) for _ in range(measures)]
        self.known = [np.zeros(64, np.int64) for _ in range(measures)]

    def add(self, keys: pa.Array, values: list[pa.Array]) -> None:
        if isinstance(keys, pa.ChunkedArray):
            keys = keys.combine_chunks()
        coded = pc.dictionary_encode(keys, null_encoding="encode")
        here = np.fromiter((self.codes.setdefault(k, len(self.codes)) for k in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        at = here[coded.indices.to_numpy(zero_copy_only=False)]
        n = len(self.codes)
        if n > len(self.rows):
            more = 2 * n
            self.rows, *rest = (np.concatenate([a, np.zeros(more - len(a), a.dtype)]) for a in (self.rows, *self.sums, *self.known))
            self.sums, self.known = rest[: len(self.sums)], rest[len(self.sums) :]
        self.rows[:n] += np.bincount(at, minlength=n)
        for i, v in enumerate(values):
            ok = v.is_valid().to_numpy(zero_copy_only=False)
            x = pc.fill_null(v, 0.0).to_numpy(zero_copy_only=False)
            self.sums[i][:n] += np.bincount(at, weights=x, minlength=n)
            self.known[i][:n] += np.bincount(at[ok], minlength=n)

    def blocks(self, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        keys = list(self.codes)
        for i in range(0, len(keys), BLOCK):
            end = min(i + BLOCK, len(keys))
            cols = {"key": pa.array(keys[i:end], key_type), "n": pa.array(self.rows[i:end])}
            for j in range(len(self.sums)):
                cols[f"s{j}"] = pa.array(self.sums[j][i:end])
                cols[f"k{j}"] = pa.array(self.known[j][i:end])
            yield pa.RecordBatch.from_pydict(cols)


def keyed_totals(df: DataFrame, key: str, measures: list[str] = ()) -> DataFrame:
    """``key, n`` and for each measure ``<m>_sum`` and ``<m>_known`` (how many values were not null).

    A null key is a key of its own; a measure without any value sums to null; NaN makes the sum NaN. An empty input
    gives no rows. Other columns of ``df`` are never read.
    """
    measures = list(measures)
    kind = df.schema[key].dataType
    ready = df.select(F.col(key).alias("key"), *[F.col(m).cast("double").alias(f"m{i}") for i, m in enumerate(measures)])
    out = T.StructType([T.StructField("key", kind), T.StructField("n", T.LongType())])
    for i in range(len(measures)):
        out = out.add(f"s{i}", T.DoubleType()).add(f"k{i}", T.LongType())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, key_type = DenseTotals(len(measures)), None
        for b in batches:
            key_type = b.schema.field("key").type
            totals.add(b.column("key"), [b.column(f"m{i}") for i in range(len(measures))])
        if key_type is not None:
            yield from totals.blocks(key_type)

    added = ready.mapInArrow(split, out).groupBy("key").agg(
        F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(measures))], *[F.sum(f"k{i}").alias(f"k{i}") for i in range(len(measures))]
    )
    return added.select(
        F.col("key").alias(key), "n",
        *[c for i, m in enumerate(measures) for c in (F.when(F.col(f"k{i}") > 0, F.col(f"s{i}")).alias(f"{m}_sum"), F.col(f"k{i}").alias(f"{m}_known"))],
    )


def heavy_keys(df: DataFrame, key: str, percent: int = 3) -> DataFrame:
    """``key, n`` of every key (null is none) that holds at least ``percent`` in a hundred of all rows of ``df``, rows without a key counting as rows."""
    totals = keyed_totals(df, key)
    rows = totals.agg(F.sum("n").alias("total"))
    # one row against the keys: a scalar, carried by a join on a constant
    whole = F.broadcast(rows.withColumn("one", F.lit(1)))
    return (
        totals.withColumn("one", F.lit(1)).join(whole, "one")
        .where(F.col(key).isNotNull() & (F.col("n") * 100 >= F.col("total") * percent)).select(key, "n")
    )
