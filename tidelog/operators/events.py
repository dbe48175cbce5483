"""Messages into event rows: one message gives none, one, or many. Native expressions; the rows of a message keep their order in ``pos``."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import codes
from tidelog.functions.tags import TAG_OF
from tidelog.functions import values as V

# fixed values: message types by what they give, and members of a market-data entry
ORDERS = ("D", "F", "G", "9")
REPORT, TRADE_REPORT = "8", "AE"
MARKET_DATA = ("W", "X")
ENTRY = (269, 270, 271, 272, 273, 278, 279, 346, 276, 277, 55, 48, 22, 15, 207)
TRADED = ("F", "1", "2", "G", "H")
#: fixed values: tags that have a column of their own
_CLAIMED = frozenset((
    "8", "9", "10", "34", "35", "49", "56", "52", "122", "42", "43", "60", "126", "432", "55", "48", "22", "167", "461", "207", "100", "15", "231",
    "969", "561", "541", "200", "202", "201", "107", "454", "455", "456", "555", "54", "44", "38", "40", "59", "99", "111", "14", "151", "6", "37",
    "11", "41", "103", "102", "58", "31", "32", "150", "17", "1003", "880", "1057", "378", "39", "268", "269", "270", "271", "272", "273", "278",
    "279", "346", "30",
))


#: Tags that events are made of: the fields of a role's values.
_READ = (
    6, 11, 14, 15, 17, 22, 30, 31, 32, 34, 35, 37, 38, 39, 40, 41, 42, 44, 48, 49, 52, 54, 55, 58, 59, 60, 99, 100, 102, 103, 107, 111, 122, 126, 150, 151, 167, 200, 201, 202, 207, 231,
    268, 269, 270, 271, 272, 273, 278, 279, 346, 378, 432, 461, 541, 561, 880, 969, 1003, 1057,
)


def _of(m: Column, *tags: int) -> Column:
    return F.coalesce(*[m.getField(f"t{t}") for t in tags])


def instant(m: dict[str, str]) -> int:
    """The instant a message tells of: of the transaction, of a market-data entry, of origin, of first sending, of sending; else 0."""
    get, read = m.get, V.nanos_of
    if (told := read(get("60"))) is not None:
        return told
    sent, day, clock = read(get("52")), get("272"), get("273")
    if day or clock:
        for told in (read(f"{day}-{clock}") if day and clock else None, read(day), read(clock, sent)):
            if told is not None:
                return told
    for told in (read(get("42")), read(get("122")), sent):
        if told is not None:
            return told
    return 0


def expiry(m: dict[str, str]) -> int | None:
    """The expiry instant, else the last nanosecond of the expiry date."""
    told = V.nanos_of(m.get("126"))
    if told is None and (day := V.nanos_of(m.get("432"))) is not None:
        told = day + V.DAY - 1
    return told


def message_type(m: Column) -> Column:
    """Tag 35, else inferred from what the message has."""
    said = _of(m, 35)
    return F.coalesce(said, F.when(_of(m, 268).isNotNull(), "X").when(_of(m, 17).isNotNull() | _of(m, 150).isNotNull(), "8").when(_of(m, 11).isNotNull(), "D"))


def instrument(m: Column, alt: Column) -> Column:
    """The instrument struct of a message with its alternative identifiers."""
    return F.struct(
        F.coalesce(_of(m, 55), F.lit("")).alias("symbol"), codes.asset_kind(_of(m, 461), _of(m, 167)).alias("kind"), _of(m, 48).alias("security_id"), _of(m, 22).alias("security_id_source"),
        V.isin(F.nullif(_of(m, 48), F.lit("")), _of(m, 22), alt).alias("isin_code"), alt.alias("alt_ids"), _of(m, 167).alias("security_type"), _of(m, 461).alias("cfi"), _of(m, 207, 100).alias("exchange"), _of(m, 15).alias("currency"),
        V.number(_of(m, 231)).alias("multiplier"), V.number(_of(m, 969)).alias("tick"), V.number(_of(m, 561)).alias("lot"), F.coalesce(V.date(_of(m, 541)), V.month_year(_of(m, 200))).alias("maturity"),
        V.number(_of(m, 202)).alias("strike"), codes.of_wire(codes.OptionKind, _of(m, 201)).alias("option_kind"), _of(m, 107).alias("label"),
    )


def _shared(m: Column, alt: Column, venue: str | None) -> dict[str, Column]:
    """What all rows have; computed once, before anything is decided by role."""
    return {
        "eunix": F.col("eunix"), "seq": V.integer(_of(m, 34)), "symbol": F.coalesce(_of(m, 55), F.lit("")), "venue": F.coalesce(F.lit(venue), _of(m, 30, 207, 49)),
        "px_unit": F.coalesce(_of(m, 15), F.lit("")), "instrument": instrument(m, alt), "metadata": F.col("others"),
    }


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def _order(m: Column) -> Column:
    state = F.when(message_type(m) == "D", int(codes.State.PENDING_NEW)).when(message_type(m) == "F", int(codes.State.PENDING_CANCEL)).when(message_type(m) == "G", int(codes.State.PENDING_REPLACE))
    state = F.coalesce(state, F.when(message_type(m) == "8", codes.of_wire(codes.State, _of(m, 39))), F.lit(0))
    return F.struct(
        F.lit(int(codes.EventType.ORDER)).alias("etype"), state.alias("state"), codes.of_wire(codes.Side, _of(m, 54)).alias("side"), V.number(_of(m, 44)).alias("px"), V.number(_of(m, 38)).alias("qty"),
        codes.of_wire(codes.OrderKind, _of(m, 40)).alias("kind"), codes.of_wire(codes.TimeInForce, _of(m, 59)).alias("tif"), V.number(_of(m, 99)).alias("stop_px"), V.number(_of(m, 111)).alias("display_qty"),
        V.number(_of(m, 14)).alias("filled_qty"), V.number(_of(m, 151)).alias("leaves_qty"), V.number(_of(m, 6)).alias("avg_px"), _of(m, 37).alias("order_id"), _of(m, 11).alias("client_order_id"),
        _of(m, 41).alias("prev_client_order_id"), V.integer(_of(m, 103, 102)).cast("int").alias("reason_code"), _of(m, 58).alias("reason"),
        _null("string").alias("exec_id"), _null("string").alias("trade_id"), _null("boolean").alias("aggressor"),
    )


def _execution(m: Column) -> Column:
    kind = codes.of_wire(codes.ExecKind, _of(m, 150))
    state = F.when(_of(m, 150).isin("F", "1", "2"), int(codes.State.FILLED)).when(_of(m, 150) == "G", int(codes.State.REPLACED)).when(_of(m, 150) == "H", int(codes.State.CANCELLED)).otherwise(codes.of_wire(codes.State, _of(m, 150)))
    return F.struct(
        F.lit(int(codes.EventType.EXECUTION)).alias("etype"), state.alias("state"), codes.of_wire(codes.Side, _of(m, 54)).alias("side"), V.number(_of(m, 31)).alias("px"), V.number(_of(m, 32)).alias("qty"),
        kind.alias("kind"), F.lit(0).alias("tif"), _null("double").alias("stop_px"), _null("double").alias("display_qty"), V.number(_of(m, 14)).alias("filled_qty"), V.number(_of(m, 151)).alias("leaves_qty"),
        V.number(_of(m, 6)).alias("avg_px"), _of(m, 37).alias("order_id"), _of(m, 11).alias("client_order_id"), _null("string").alias("prev_client_order_id"), V.integer(_of(m, 378)).cast("int").alias("reason_code"), _of(m, 58).alias("reason"),
        _of(m, 17).alias("exec_id"), _of(m, 1003, 880).alias("trade_id"), V.flag(_of(m, 1057)).alias("aggressor"),
    )


def _entry(m: Column) -> Column:
    """A market-data entry, its header beneath it: bids and offers are orders, trades executions."""
    kind = _of(m, 269)
    trade = kind == "2"
    action = codes.of_wire(codes.UpdateAction, F.coalesce(_of(m, 279), F.when(_of(m, 35) == "W", "0")))
    state = F.when(trade, int(codes.State.FILLED)).when(action == 110, int(codes.State.NEW)).when(codes.removes(action), int(codes.State.CANCELLED)).otherwise(int(codes.State.OPEN))
    side = F.when(kind == "0", int(codes.Side.BUY)).when(kind == "1", int(codes.Side.SELL)).otherwise(0)
    level = F.concat(F.when(kind == "0", "BUY@").otherwise("SELL@"), _of(m, 270))
    return F.struct(
        F.when(trade, int(codes.EventType.EXECUTION)).otherwise(int(codes.EventType.ORDER)).alias("etype"), state.alias("state"), side.alias("side"), V.number(_of(m, 270)).alias("px"), V.number(_of(m, 271)).alias("qty"),
        F.when(trade, int(codes.ExecKind.TRADED)).otherwise(int(codes.OrderKind.LIMIT_ORDER)).alias("kind"), F.lit(0).alias("tif"), _null("double").alias("stop_px"), _null("double").alias("display_qty"), _null("double").alias("filled_qty"),
        _null("double").alias("leaves_qty"), _null("double").alias("avg_px"), F.when(~trade, F.coalesce(_of(m, 278), level)).alias("order_id"), _null("string").alias("client_order_id"), _null("string").alias("prev_client_order_id"),
        _null("int").alias("reason_code"), _of(m, 58).alias("reason"), F.when(trade, _of(m, 278)).alias("exec_id"), _null("string").alias("trade_id"), _null("boolean").alias("aggressor"),
    )


_HEADED = ("55", "48", "22", "15", "207")
_INDEXED = re.compile(r"#?NoMDEntries\[(\d+)\]\.?(.*)", re.I | re.S)
_ALTERNATIVES = ("454", "455", "456")
_ALTERNATIVE = re.compile(r"#?NoSecurityAltID\[(\d+)\]\.?(.*)", re.I | re.S)
_SCHEMES = {wire: codes.IdSource(code).name for code, wire in codes.WIRE["IdSource"].items()}


def alternatives(pairs: list[tuple[str, str]]) -> dict[str, str]:
    """The alternative identifiers of a message (group 454) by their scheme's name, an unknown scheme by its character; the first of a scheme counts."""
    entries: list[dict[str, str]] = []
    at = next((i for i, (k, _) in enumerate(pairs) if k == "454"), None)
    if at is not None and at + 1 < len(pairs) and (n := pairs[at][1].strip()).isdecimal():
        opener = pairs[at + 1][0]
        for k, v in pairs[at + 1 :]:
            if k == opener:
                if len(entries) == int(n):
                    break
                entries.append({})
            elif not entries or k in entries[-1]:
                break
            entries[-1][k] = v
    if not entries:
        by_index: dict[int, dict[str, str]] = {}
        for k, v in pairs:
            if "[" in k and (m := _ALTERNATIVE.fullmatch(k)):
                by_index.setdefault(int(m[1]), {}).setdefault(str(TAG_OF.get(m[2].lower(), m[2])), v)
        entries = [by_index[i] for i in sorted(by_index)]
    found: dict[str, str] = {}
    for e in entries:
        if named := e.get("455"):
            scheme = (e.get("456") or "").strip()
            found.setdefault(_SCHEMES.get(scheme, scheme) or "UNKNOWN", named)
    return found


def maps_of(pairs: list[tuple[str, str]]) -> list[tuple[dict[str, str], dict[str, str]]]:
    """The first values of a message by key, and its alternative identifiers; of market data those of each entry, the header beneath
    them. An entry that names an instrument has only its own alternatives. The type is always there as 35."""
    first = dict(reversed(pairs))
    kind = first.get("35") or ("X" if "268" in first else "8" if "17" in first or "150" in first else "D" if "11" in first else None)
    if kind is None:
        return []
    first["35"] = kind
    alt = alternatives(pairs) if "454" in first or any("[" in k for k in first) else {}
    if kind not in MARKET_DATA:
        return [(first, alt)]
    members = {str(t) for t in ENTRY}
    entries: list[dict[str, str]] = []
    own: list[list[tuple[str, str]]] = []
    at = next((i for i, (k, _) in enumerate(pairs) if k == "268"), None)
    if at is not None and at + 1 < len(pairs):
        opener = pairs[at + 1][0]
        for k, v in pairs[at + 1 :]:
            if k in _ALTERNATIVES and entries:
                own[-1].append((k, v))
                continue
            if k not in members:
                break
            if k == opener or not entries or k in entries[-1]:
                entries.append({})
                own.append([])
            entries[-1][k] = v
            own[-1].append((k, v))
        n = first["268"]
        entries = entries[: int(n)] if n.isdigit() else []
    else:
        by_index: dict[int, dict[str, str]] = {}
        inside: dict[int, list[tuple[str, str]]] = {}
        for k, v in pairs:
            if m := _INDEXED.fullmatch(k):
                tag = TAG_OF.get(m[2].lower())
                by_index.setdefault(int(m[1]), {}).setdefault(str(tag) if tag else m[2], v)
                inside.setdefault(int(m[1]), []).append((str(tag) if tag else m[2], v))
        entries, own = [by_index[i] for i in sorted(by_index)], [inside[i] for i in sorted(by_index)]
    header = {k: v for k, v in first.items() if k not in members or k in _HEADED}
    names = lambda e: any(k in _HEADED or k == "454" or "[" in k and _ALTERNATIVE.fullmatch(k) for k, _ in e)
    return [(header | e, alternatives(o) if names(o) else alt) for e, o in zip(entries, own) if e.get("269") in ("0", "1", "2")]


def roles_of(pairs: list[tuple[str, str]]) -> list[tuple[int, str, dict[str, str], dict[str, str]]]:
    """Of each row that a message gives: its place, what it is, the values it is made of, and its alternative identifiers."""
    out = []
    for i, (m, alt) in enumerate(maps_of(pairs)):
        kind = m["35"]
        if kind in MARKET_DATA:
            out.append((2 * i, "entry", m, alt))
        elif kind == TRADE_REPORT:
            out.append((2 * i, "execution", m, alt))
        elif kind in ORDERS or kind == REPORT:
            out.append((2 * i, "order", m, alt))
            if kind == REPORT and m.get("150") in TRADED:
                out.append((2 * i + 1, "execution", m, alt))
    return out


_MAP = T.MapType(T.StringType(), T.StringType())
_MAP_ARROW = pa.map_(pa.string(), pa.string())
_VALUES = T.StructType([T.StructField(f"t{t}", T.StringType()) for t in _READ])
ROLE = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("unix", T.LongType()), T.StructField("eunix", T.LongType()), T.StructField("m", _VALUES), T.StructField("alt", _MAP), T.StructField("others", _MAP)]))


def pairs_by_row(pairs: pa.Array) -> Iterator[list[tuple[str, str]] | None]:
    """The pairs of each row, from whole columns of keys and values."""
    flat = pairs.flatten()
    both = list(zip(pc.struct_field(flat, "key").to_pylist(), pc.struct_field(flat, "value").to_pylist()))
    at = 0
    for n in pc.list_value_length(pairs).to_pylist():
        yield None if n is None else both[at : at + n]
        at += n or 0


@F.arrow_udf(ROLE)
def _roles(pairs: pa.Array) -> pa.Array:
    """What each message gives, its values as one column for each tag."""
    ends, pos, roles, unix, eunix, alts, others = [0], [], [], [], [], [], []
    values: list[list[str | None]] = [[] for _ in _READ]
    columns = list(zip(map(str, _READ), values))
    for row in pairs_by_row(pairs):
        for i, role, m, alt in roles_of(row) if row else ():
            pos.append(i), roles.append(role), unix.append(instant(m)), eunix.append(expiry(m))
            for tag, column in columns:
                column.append(m.get(tag))
            alts.append(list(alt.items()) or None)
            others.append([(k, v) for k, v in m.items() if k not in _CLAIMED])
        ends.append(len(pos))
    m = pa.StructArray.from_arrays([pa.array(v, pa.string()) for v in values], [f"t{t}" for t in _READ])
    rows = pa.StructArray.from_arrays(
        [pa.array(pos, pa.int32()), pa.array(roles, pa.string()), pa.array(unix, pa.int64()), pa.array(eunix, pa.int64()), m, pa.array(alts, _MAP_ARROW), pa.array(others, _MAP_ARROW)],
        ["pos", "role", "unix", "eunix", "m", "alt", "others"],
    )
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


def events(df: DataFrame, pairs: str = "pairs", venue: str | None = None) -> DataFrame:
    """The event rows of messages: ``df`` without ``pairs``, then ``pos`` and the event's columns. Keys have to be tags (see
    :func:`tidelog.functions.tags.from_pairs`). Messages of other types, and null ones, give nothing."""
    keep = [c for c in df.columns if c != pairs]
    rows = df.withColumn("_roles", _roles(F.col(pairs))).select(*keep, F.inline("_roles"))
    m = F.col("m")
    shared = _shared(m, F.col("alt"), venue)
    event = F.when(F.col("role") == "entry", _entry(m)).when(F.col("role") == "execution", _execution(m)).otherwise(_order(m))
    rows = rows.withColumns({**shared, "_event": event}).withColumn("unix_hour", V.hour_of(F.col("unix")))
    return rows.select(*keep, "pos", "unix", "unix_hour", *shared, "_event.*")
