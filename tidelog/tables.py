"""The shapes that jobs land in."""

from __future__ import annotations

from pyspark.sql import types as T

from tidelog.functions.tags import LIFTED
from tidelog.shapes import DERIVED, PARTITION, PRIMARY, SORT, Shape

L, I, S, D, B = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.BooleanType()


def _f(name: str, kind: T.DataType, null: bool = False, **meta) -> T.StructField:
    return T.StructField(name, kind, null, meta)


ENVELOPE = [
    _f("unix", L, **{PRIMARY: True, SORT: 0}), _f("unix_hour", L, **{PARTITION: "identity", DERIVED: "unix"}), _f("etype", I), _f("cunix", L), _f("runix", L), _f("eunix", L, True), _f("sunix", L, True),
    _f("hash", L, **{PRIMARY: True}), _f("xhash", L), _f("version", L), _f("state", I), _f("symbol", S), _f("seq", L, True), _f("prev_hash", L, True), _f("prev_state", I), _f("prev_unix", L, True), _f("parent_hash", T.ArrayType(L), True),
]

_KIND = {"S": S, "L": L, "D": D, "B": B, "X": T.BinaryType(), "N": L}
PAIR = T.ArrayType(T.StructType([T.StructField("key", S), T.StructField("value", S)]))
TAGS = T.ArrayType(T.StructType([T.StructField("tag", I), T.StructField("value", S)]))

LOG = Shape("Log", T.StructType([
    *ENVELOPE, _f("url", S), _f("thread_name", S), _f("driver_name", S), _f("message", S), _f("protocol", S), _f("fix_tags", TAGS, True), _f("keyval", PAIR, True),
    *[_f(n, _KIND[k], True, tag=t) for t, n, k in LIFTED if n not in ("symbol", "seq")],
]))

INSTRUMENT = T.StructType([
    _f("symbol", S), _f("kind", I), _f("security_id", S, True), _f("security_id_source", S, True), _f("isin_code", S, True), _f("alt_ids", T.MapType(S, S), True), _f("security_type", S, True), _f("cfi", S, True), _f("exchange", S, True),
    _f("currency", S, True), _f("multiplier", D, True), _f("tick", D, True), _f("lot", D, True), _f("maturity", T.DateType(), True), _f("strike", D, True), _f("option_kind", I), _f("label", S, True),
])

EVENT = Shape("MarketEvent", T.StructType([
    *ENVELOPE, _f("instrument_hash", L), _f("side", I), _f("px", D, True), _f("qty", D, True), _f("px_unit", S), _f("notional", D, True), _f("venue", S, True), _f("instrument", INSTRUMENT), _f("metadata", T.MapType(S, S), True),
    _f("kind", I), _f("tif", I), _f("stop_px", D, True), _f("display_qty", D, True), _f("filled_qty", D, True), _f("leaves_qty", D, True), _f("avg_px", D, True), _f("order_id", S, True), _f("client_order_id", S, True),
    _f("prev_client_order_id", S, True), _f("reason_code", I, True), _f("reason", S, True), _f("exec_id", S, True), _f("trade_id", S, True), _f("aggressor", B, True),
]))
