"""Key joins and keyed first rows as the tables need them: keys normalised, null and NaN keys refused, order kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


class BadKey(ValueError):
    pass


def _floating(df: DataFrame, keys: list[str]) -> list[str]:
    return [k for k in keys if isinstance(df.schema[k].dataType, (T.DoubleType, T.FloatType))]


def normalised(df: DataFrame, keys: list[str]) -> DataFrame:
    """Floating keys without a negative zero, for joins and as they are stored."""
    return df.withColumns({k: F.when(F.col(k) == 0, F.lit(0.0).cast(df.schema[k].dataType)).otherwise(F.col(k)) for k in _floating(df, keys)}) if _floating(df, keys) else df


def refuse_bad_keys(df: DataFrame, keys: list[str]) -> None:
    """Raises if a key is null or NaN, naming the column. Looks at the keys only."""
    floating = _floating(df, keys)
    bad = [F.count_if(F.col(k).isNull() | (F.isnan(k) if k in floating else F.lit(False))).alias(k) for k in keys]
    counts = df.agg(*bad).first()
    for k in keys:
        if counts[k]:
            raise BadKey(f"{k}: {counts[k]} rows with a null or NaN key")


def aligned(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """``b`` with its keys in the types of ``a``'s."""
    return b.withColumns({k: F.col(k).cast(a.schema[k].dataType) for k in keys})


def semi_join(stored: DataFrame, chunk: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``stored`` that ``chunk`` refers to."""
    return normalised(stored, keys).join(normalised(aligned(stored, chunk, keys), keys).select(*keys), keys, "left_semi")


def anti_join(chunk: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``chunk`` whose keys are new."""
    return normalised(chunk, keys).join(normalised(aligned(chunk, stored, keys), keys).select(*keys), keys, "left_anti")


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, then by all columns. A hot key's rows are reduced before they are shuffled."""
    rest = [c for c in df.columns if c not in keys]
    ties = [comparable(F.col(c), df.schema[c].dataType).alias(c) for c in rest if c not in order]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order, *ties)).alias("_first"))
    return best.select(*keys, "_first.*").select(*df.columns)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def comparable(c: Column, kind: T.DataType) -> Column:
    """``c`` with its maps, at any depth, as sorted entries, for maps have no equality."""
    if not _has_map(kind):
        return c
    if isinstance(kind, T.MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(e["key"], comparable(e["value"], kind.valueType))))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: comparable(x, kind.elementType))
    return F.when(c.isNotNull(), F.struct(*[comparable(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]))


def differs(a: str, b: str, schema: T.StructType, columns: list[str]) -> Column:
    """Whether any of the columns differs, null against null being equal, as is NaN against NaN."""
    out = F.lit(False)
    for c in columns:
        out = out | ~comparable(F.col(f"{a}.{c}"), schema[c].dataType).eqNullSafe(comparable(F.col(f"{b}.{c}"), schema[c].dataType))
    return out


def changed(chunk: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``chunk`` whose key is stored with other content."""
    rest = [c for c in chunk.columns if c not in keys]
    a, b = normalised(chunk, keys).alias("a"), normalised(aligned(chunk, stored, keys), keys).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    return a.join(b, on).where(differs("a", "b", chunk.schema, rest)).select("a.*")


def distinct_under(df: DataFrame, column: str, limit: int) -> list | None:
    """The distinct values if there are at most ``limit``, else None."""
    rows = df.select(column).distinct().limit(limit + 1).collect()
    return sorted((r[0] for r in rows), key=lambda x: (x is None, x)) if len(rows) <= limit else None


def as_of(left: DataFrame, right: DataFrame, by: list[str], at: str, prefix: str = "prev_", slice_nanos: int | None = None) -> DataFrame:
    """Each row of ``left`` with the last row of ``right`` at or before its instant and with the same ``by``; the columns of ``right`` get ``prefix``.

    Both sides go into one sorted window, never into pairs. With ``slice_nanos`` time is cut into slices, so that a hot key is spread over
    many tasks: the last row of each slice travels on to the next ones.
    """
    values = [c for c in right.columns if c not in (*by, at)]
    payload = F.struct(F.col(at).alias(at), *values)
    l = left.select(*by, F.col(at), F.struct(*[c for c in left.columns if c not in (*by, at)]).alias("_l"), F.lit(None).cast(right.select(payload).schema[0].dataType).alias("_r"), F.lit(1).alias("_side"))
    r = right.select(*by, F.col(at), F.lit(None).cast(l.schema["_l"].dataType).alias("_l"), payload.alias("_r"), F.lit(0).alias("_side"))
    both = l.unionByName(r)
    slot = F.col(at) - F.pmod(at, F.lit(slice_nanos)) if slice_nanos else F.lit(0)
    both = both.withColumn("_slot", slot)
    here = Window.partitionBy(*by, "_slot").orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_last", F.last("_r", ignorenulls=True).over(here))
    if slice_nanos:
        ends = both.where("_side = 0").groupBy(*by, "_slot").agg(F.max_by("_r", at).alias("_end"))
        slots = both.select(*by, "_slot").distinct().join(ends, [*by, "_slot"], "left")
        before = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        carried = slots.select(*by, "_slot", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
        both = both.join(carried, [*by, "_slot"]).withColumn("_last", F.coalesce("_last", "_carried"))
    out = both.where("_side = 1").select(*by, at, "_l.*", *[F.col(f"_last.{c}").alias(f"{prefix}{c}") for c in (at, *values)])
    return out
