"""Queries of the problems on text, with their SQL where SQL can express them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import history, leak, reading, tokens
from tidelog.runtime import scan


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    tables = {"log_lines": (history.log_rows, "line"), "market_order": (history.order_rows, "row")}
    scans = {t: scan(spark, d, t) for t in tables}
    # the tables know nothing of each other: while one waits for its next delivery the other is worked on
    with ThreadPoolExecutor(len(tables)) as pool:
        found = dict(zip(tables, pool.map(lambda t: history.repeats(tables[t][0](scans[t]), tables[t][1]), tables)))
    return reduce(DataFrame.union, [rows.select(F.lit(t).alias("tbl"), "row_id") for t, rows in found.items()])


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encoded(scan(spark, d, "documents"), tokens.ranks())


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaks(scan(spark, d, "documents"), scan(spark, d, "eval_items"))


def p9_exchanged(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaks(scan(spark, d, "documents"), scan(spark, d, "eval_items"), exchanged=True)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs = scan(spark, d, "documents").where("genre is null or genre <> 'capture'")
    return reading.leveled(docs, scan(spark, d, "reading_labels"))


QUERIES = {f.__name__: f for f in (p2_found, p8_ids, p9_found, p9_exchanged, p10_found)}

SQL: dict[str, str] = {}
