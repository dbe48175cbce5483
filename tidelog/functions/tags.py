"""Tag/value messages into ordered pairs, and pairs into typed columns, one row at a time. Wire messages are read by native expressions.

A message is an array of ``struct<key, value>`` in wire order, repeats kept (a repeating group is tags repeating). Null means
that there is no line, empty that it holds no pair.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import values as V

# fixed values: what a message begins with and what its tokens look like
WS = r"[ \t\r\n\f\x0b]"
NAME = r"[A-Za-z][A-Za-z0-9_.\-]*"
BEGIN = r"(?:^|[^0-9])8=FIXT?"
BRIDGE_TOKEN = rf"#{NAME}(?:\[\d+\])?{WS}*="
BRIDGE = rf"(?s){BRIDGE_TOKEN}.*{BRIDGE_TOKEN}"
BRIDGE_WIRE = rf"(?s){BEGIN}.*[^0-9]35=UL(?:[^A-Za-z0-9]|\z)"
SEPARATORS = ("\x01", "|", "^A", "^", ";")

_VALUE = r"[^\x01|;^ \t\r\n\f\x0b]*"
_TOKEN = rf"(?s)^{WS}*#?(\d+|{NAME})(?:\[(\d+)\])?(?:\.([A-Za-z0-9_.\-]+))?{WS}*=(.*)\z"
_MEMBER = rf"(?s)^{WS}*(\d+|{NAME}){WS}*=(.*)\z"
_INDEXED = rf"(?s)^{WS}*#?(?:\d+|{NAME})\[\d+\]"

PAIR = "array<struct<key:string,value:string>>"

# fixed values: tags lifted to columns, those of the session first, with their kinds (S text, L integer, D number, B flag, X bytes, N instant)
LIFTED: tuple[tuple[int, str, str], ...] = (
    (8, "begin_string", "S"), (9, "body_length", "L"), (35, "msg_type", "S"), (10, "check_sum", "S"), (49, "sender_comp_id", "S"),
    (50, "sender_sub_id", "S"), (142, "sender_location_id", "S"), (56, "target_comp_id", "S"), (57, "target_sub_id", "S"),
    (143, "target_location_id", "S"), (115, "on_behalf_of_comp_id", "S"), (116, "on_behalf_of_sub_id", "S"), (144, "on_behalf_of_location_id", "S"),
    (128, "deliver_to_comp_id", "S"), (129, "deliver_to_sub_id", "S"), (145, "deliver_to_location_id", "S"), (34, "seq", "L"),
    (369, "last_msg_seq_num_processed", "L"), (43, "poss_dup_flag", "B"), (97, "poss_resend", "B"), (52, "sending_unix", "N"),
    (122, "orig_sending_unix", "N"), (370, "on_behalf_of_sending_unix", "N"), (1128, "appl_ver_id", "S"), (1129, "cstm_appl_ver_id", "S"),
    (1156, "appl_ext_id", "L"), (347, "message_encoding", "S"), (212, "xml_data_len", "L"), (213, "xml_data", "X"), (90, "secure_data_len", "L"),
    (91, "secure_data", "X"), (93, "signature_length", "L"), (89, "signature", "X"), (55, "symbol", "S"), (48, "security_id", "S"),
    (22, "security_id_source", "S"), (167, "security_type", "S"), (461, "cfi_code", "S"), (207, "security_exchange", "S"), (15, "currency", "S"),
    (1, "account", "S"), (11, "cl_ord_id", "S"), (41, "orig_cl_ord_id", "S"), (37, "order_id", "S"), (17, "exec_id", "S"), (54, "side", "S"),
    (40, "ord_type", "S"), (59, "time_in_force", "S"), (39, "ord_status", "S"), (150, "exec_type", "S"), (38, "order_qty", "D"), (44, "price", "D"),
    (6, "avg_px", "D"), (14, "cum_qty", "D"), (151, "leaves_qty", "D"), (31, "last_px", "D"), (32, "last_qty", "D"), (60, "transact_unix", "N"),
    (58, "text", "S"),
)

# fixed values: rendered names of tags
_NAMES: dict[str, int] = {
    "MsgType": 35, "SenderCompID": 49, "TargetCompID": 56, "SendingTime": 52, "OrigSendingTime": 122, "OrigTime": 42, "PossDupFlag": 43,
    "PossResend": 97, "MsgSeqNum": 34, "TransactTime": 60, "TradeDate": 75, "ExpireTime": 126, "ExpireDate": 432, "OrdStatus": 39,
    "ExecTransType": 20, "CxlRejReason": 102, "NoMDEntries": 268, "MDEntryType": 269, "MDEntryPx": 270, "MDEntrySize": 271, "MDEntryDate": 272,
    "MDEntryTime": 273, "MDEntryID": 278, "MDUpdateAction": 279, "NumberOfOrders": 346, "TrdMatchID": 880, "SecurityExchange": 207,
    "ExDestination": 100, "Price": 44, "OrderQty": 38, "LastPx": 31, "LastQty": 32, "NoSecurityAltID": 454, "SecurityAltID": 455,
    "SecurityAltIDSource": 456, "NoLegs": 555, "MaturityMonthYear": 200, "LegMaturityMonthYear": 610, "Symbol": 55, "SecurityID": 48,
    "SecurityIDSource": 22, "SecurityType": 167, "CFICode": 461, "Currency": 15, "Account": 1, "ClOrdID": 11, "OrigClOrdID": 41, "OrderID": 37,
    "ExecID": 17, "Side": 54, "OrdType": 40, "TimeInForce": 59, "ExecType": 150, "AvgPx": 6, "CumQty": 14, "LeavesQty": 151, "Text": 58,
    "StopPx": 99, "MaxFloor": 111, "OrdRejReason": 103, "AggressorIndicator": 1057, "TradeID": 1003, "LastMkt": 30, "BeginString": 8,
    "BodyLength": 9, "CheckSum": 10, "ExecInst": 18, "HandlInst": 21, "NoPartyIDs": 453, "PartyID": 448, "PartyIDSource": 447, "PartyRole": 452,
    "QuoteCondition": 276, "TradeCondition": 277, "MaturityDate": 541, "StrikePrice": 202, "PutOrCall": 201, "ContractMultiplier": 231,
}
TAG_OF = {name.lower(): tag for name, tag in _NAMES.items()}


def _first_of(text: Column, candidates: tuple[str, ...] = SEPARATORS) -> Column:
    out = F.lit(None).cast("string")
    for c in reversed(candidates):
        out = F.when(F.contains(text, F.lit(c)), c).otherwise(out)
    return out


def separator(message: Column) -> Column:
    """What stands for SOH: the sign behind the begin string, else the one before the second bridge token (``#`` where tokens abut),
    else the first known one that occurs, else SOH."""
    behind = F.regexp_extract(message, rf"(?s){BEGIN}{_VALUE}(\^A|[^\s])", 1)
    before = F.regexp_extract(message, rf"(?s){BRIDGE_TOKEN}.*?(\^A|.){BRIDGE_TOKEN}", 1)
    bridge = F.when(before != "", F.when(before.isin(*SEPARATORS), before).otherwise("#"))
    return F.when(message.isNotNull(), F.coalesce(F.nullif(behind, F.lit("")), bridge, _first_of(message), F.lit("\x01")))


def begun(message: Column, named: bool) -> Column:
    """The message without what the log wrote before it."""
    wire = F.regexp_extract(message, r"(?s)(?:^|[^0-9])(8=FIXT?.*)", 1)
    out = F.when(wire != "", wire)
    if named:
        bridge = F.regexp_extract(message, rf"(?s)({BRIDGE_TOKEN}.*{BRIDGE_TOKEN}.*)", 1)
        out = F.coalesce(out, F.when(bridge != "", bridge))
    return F.coalesce(out, message)


def _pair(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def _trim(c: Column) -> Column:
    return F.trim(c, F.lit(" \t\r\n\f\x0b"))


def _cut(token: Column) -> Column:
    """A token at its first equals sign."""
    at = F.instr(token, "=")
    return _pair(_trim(F.substring(token, F.lit(1), at - 1)), _trim(F.substring(token, at + 1, F.length(token))))


def tokens(message: Column) -> Column:
    """The ``tag=value`` tokens of a wire message; the log's own ``key=value`` noise is none."""
    sep = separator(message)
    split = F.split(begun(message, False), F.concat(F.lit("\\Q"), sep, F.lit("\\E")), F.lit(-1))
    shape = rf"(?s)^{WS}*\d+{WS}*="
    return F.filter(split, lambda t: t.rlike(shape))


def until_checksum(pairs: Column) -> Column:
    """The pairs up to the first tag 10, itself included."""
    at = F.array_position(F.transform(pairs, lambda p: p["key"]), "10")
    return F.when(at > 0, F.slice(pairs, F.lit(1), at.cast("int"))).otherwise(pairs)


_TOKEN_RE, _MEMBER_RE, _INDEXED_RE = (re.compile(x.replace(r"\z", r"\Z"), re.ASCII) for x in (_TOKEN, _MEMBER, _INDEXED))
_BRIDGE_RE, _NEXT_RE = re.compile(rf"(?s)({BRIDGE_TOKEN})(?=.*{BRIDGE_TOKEN})", re.ASCII), re.compile(BRIDGE_TOKEN, re.ASCII)
_WIRE_RE = re.compile(rf"(?:^|[^0-9])(8=FIXT?{_VALUE})(\^A|[^\s])?", re.ASCII)


def rendered(message: str) -> list[tuple[str, str]]:
    """The pairs of one rendered message: ``#SIDE=1``, ``Side=1``, ``54=1``, ``G[i]=M=v``, ``G[i].M=v``, and group entries with a separator of their own."""
    start = _WIRE_RE.search(message)
    bridge = None if start else _BRIDGE_RE.search(message)
    if start and start[2]:
        sep = start[2]
    elif bridge and (second := _NEXT_RE.search(message, bridge.end())):
        before = message[: second.start()]
        sep = next((x for x in ("^A", *SEPARATORS) if before.endswith(x)), "#")
    else:
        sep = next((x for x in SEPARATORS if x in message), "\x01")
    body = message[start.start(1) :] if start else message[bridge.start() :] if bridge else message
    kept = [t for t in body.split(sep) if _TOKEN_RE.match(t)]
    indexed = " ".join(t for t in kept if _INDEXED_RE.match(t))
    entry = next((x for x in SEPARATORS if x in indexed), None)
    out: list[tuple[str, str]] = []
    for t in kept:
        key, index, member, rest = _TOKEN_RE.match(t).groups()
        lead = key if index is None else f"{key}[{index}]"
        if index is not None and member is None and (inner := _MEMBER_RE.match(rest)):
            member, rest = inner[1], inner[2]
        full = f"{lead}.{member}" if member else lead
        if index is None or entry is None:
            out.append((full, rest.strip()))
        else:
            head, *more = rest.split(entry)
            out.append((full, head.strip()))
            for chunk in more:
                inner = _MEMBER_RE.match(chunk)
                out.append((f"{lead}.{inner[1]}", inner[2].strip()) if inner else (lead, chunk.strip()))
    end = next((i for i, (k, _) in enumerate(out) if k == "10"), len(out))
    return out[: end + 1]


PAIR_TYPE = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))
TAG_TYPE = T.ArrayType(T.StructType([T.StructField("tag", T.IntegerType()), T.StructField("value", T.StringType())]))


@F.arrow_udf(PAIR_TYPE)
def _rendered_pairs(messages: pa.Array) -> pa.Array:
    keys, values, row = [], [], []
    for i, m in enumerate(messages.to_pylist()):
        for k, v in rendered(m) if m is not None else ():
            keys.append(k), values.append(v), row.append(i)
    both = pa.StructArray.from_arrays([pa.array(keys, pa.string()), pa.array(values, pa.string())], ["key", "value"])
    return _listed(both, np.array(row, np.int64), len(messages), pc.is_null(messages))


def parse(df, message: str = "message", out: str = "pairs", named: bool | Column = False):
    """``df`` with the pairs of its messages. ``named`` is one for all, or a column: rendered names are admitted where it is true. Wire
    messages, the most, are cut by native expressions; rendered ones, whose grammar nests, by an Arrow function."""
    split = F.transform(tokens(F.when(~named, F.col(message)) if isinstance(named, Column) else F.col(message)), _cut)
    if named is False:
        return df.withColumn(out, split).withColumn(out, until_checksum(F.col(out)))
    said = F.when(named, F.col(message)) if isinstance(named, Column) else F.col(message)
    df = df.withColumn("_rendered", _rendered_pairs(said))
    return df.withColumn(out, split).withColumn(out, F.coalesce("_rendered", until_checksum(F.col(out)))).drop("_rendered")


def drop_null_values(pairs: Column) -> Column:
    return F.filter(pairs, lambda p: ~V.is_null_word(p["value"]))


def tag_of(key: Column) -> Column:
    """The tag a key names: digits, or the last name in it; null if it is unknown."""
    bare = F.regexp_replace(F.regexp_replace(key, r"\A#", ""), r"\[\d+\]\z", "")
    last = F.regexp_replace(bare, r"(?s)\A.*[.\]]", "")
    by_name = F.try_element_at(F.create_map(*[F.lit(x) for kv in TAG_OF.items() for x in kv]), F.lower(last))
    return F.coalesce(F.when(last.rlike(r"^\d{1,9}\z"), last.try_cast("int")), by_name)


def _tag(key: str) -> int | None:
    last = re.sub(r"(?s)\A.*[.\]]", "", re.sub(r"\[\d+\]\Z", "", key.removeprefix("#")))
    return int(last) if re.fullmatch(r"[0-9]{1,9}", last) else TAG_OF.get(last.lower())


#: What a message's pairs are made of: known tags, other keys, and the values of lifted tags that occur once, which are no longer among the tags.
TRANSCRIBED = T.StructType(
    [T.StructField("fix_tags", TAG_TYPE), T.StructField("keyval", PAIR_TYPE), T.StructField("lifted", T.StructType([T.StructField(n, T.StringType()) for _, n, _ in LIFTED]))]
)
_LIFTED_AT = {tag: i for i, (tag, _, _) in enumerate(LIFTED)}


def _listed(values: pa.Array, row: np.ndarray, rows: int, missing: pa.Array) -> pa.Array:
    """``values`` as a list for each row; ``row`` tells whose they are, in order."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=missing)


@F.arrow_udf(TRANSCRIBED)
def transcribed(pairs: pa.Array) -> pa.Array:
    """Pairs by their keys, in wire order; pairs without a value are dropped. Whole columns at a time: each distinct key is resolved once a batch."""
    rows, width, missing = len(pairs), len(LIFTED), pc.is_null(pairs)
    flat = pairs.flatten()
    row = np.repeat(np.arange(rows), pc.fill_null(pc.list_value_length(pairs), 0).to_numpy(zero_copy_only=False))
    value = pc.struct_field(flat, "value")
    said = pc.and_(pc.is_valid(value), pc.invert(pc.is_in(pc.utf8_lower(pc.utf8_trim_whitespace(value)), value_set=pa.array(V.NULL_WORDS))))
    flat, row = flat.filter(said), row[said.to_numpy(zero_copy_only=False)]
    value, coded = pc.struct_field(flat, "value"), pc.struct_field(flat, "key").dictionary_encode()
    names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    tags = [None if k is None else _tag(k) for k in names]
    tag = np.array([-1 if t is None else t for t in tags], np.int32)[code]
    at = np.array([_LIFTED_AT.get(t, -1) for t in tags], np.int64)[code]
    cell = row * width + at
    once = at >= 0
    once[once] = np.bincount(cell[once], minlength=rows * width)[cell[once]] == 1
    place = np.full(rows * width, -1, np.int64)
    place[cell[once]] = np.flatnonzero(once)
    place = place.reshape(rows, width)
    lifted = pa.StructArray.from_arrays([value.take(pa.array(p, mask=p < 0)) for p in place.T], [n for _, n, _ in LIFTED])
    known, other = np.flatnonzero((tag >= 0) & ~once), np.flatnonzero(tag < 0)
    plain = pa.array([None if k is None else re.sub(r"\[\d+\]", "", k) for k in names], pa.string())
    fix = pa.StructArray.from_arrays([pa.array(tag[known]), value.take(pa.array(known))], ["tag", "value"])
    keyval = pa.StructArray.from_arrays([plain.take(pa.array(code[other])), value.take(pa.array(other))], ["key", "value"])
    return pa.StructArray.from_arrays([_listed(fix, row[known], rows, missing), _listed(keyval, row[other], rows, missing), lifted], ["fix_tags", "keyval", "lifted"])


@F.arrow_udf(PAIR_TYPE)
def from_pairs(pairs: pa.Array) -> pa.Array:
    """Pairs with names as pairs with tags; what names no tag keeps its name, what has no value goes. Each distinct key is resolved once a batch."""
    flat, parent = pc.list_flatten(pairs), pc.list_parent_indices(pairs)
    have = pc.is_valid(pc.struct_field(flat, "value"))
    flat, parent = flat.filter(have), parent.filter(have).to_numpy()
    coded = pc.struct_field(flat, "key").dictionary_encode()
    names = coded.dictionary.to_pylist()
    tags = [None if k is None or "[" in k else _tag(re.sub(r"[ _-]+", "", k)) for k in names]
    keys = pa.array([k if t is None else str(t) for k, t in zip(names, tags)], pa.string()).take(coded.indices)
    both = pa.StructArray.from_arrays([keys, pc.struct_field(flat, "value")], ["key", "value"])
    return _listed(both, parent, len(pairs), pc.is_null(pairs))


_KINDS = {"S": lambda t: t, "L": V.integer, "D": V.number, "B": V.bool_words, "X": lambda t: t.cast("binary"), "N": V.nanos}


def lift(df, pairs: str = "pairs"):
    """``df`` with ``fix_tags``, ``keyval`` and a typed column for each lifted tag, which is null unless the tag occurs exactly once."""
    df = df.withColumn("_t", transcribed(F.col(pairs)))
    lifted = {name: _KINDS[kind](F.col(f"_t.lifted.{name}")) for _, name, kind in LIFTED}
    return df.withColumns({"fix_tags": F.col("_t.fix_tags"), "keyval": F.col("_t.keyval"), **lifted}).drop("_t")


def value_of(pairs: Column, tag: int, names: tuple[str, ...] = ()) -> Column:
    """The first value of a tag, or of one of its names in any spelling with an index or path."""
    return F.get(all_values(pairs, tag, names), F.lit(0))


def all_values(pairs: Column, tag: int, names: tuple[str, ...] = ()) -> Column:
    low = [str(tag), *(n.lower() for n in names)]
    last = lambda k: F.lower(F.regexp_replace(F.regexp_replace(k, r"\[\d+\]\z", ""), r"(?s)\A.*\.", ""))
    return F.transform(F.filter(pairs, lambda p: (p["key"] == str(tag)) | last(p["key"]).isin(*low)), lambda p: p["value"])


def by_tag(pairs: Column) -> Column:
    """A map of the first value of each key."""
    return F.aggregate(pairs, F.expr("cast(map() as map<string,string>)"), lambda m, p: F.when(F.map_contains_key(m, p["key"]), m).otherwise(F.map_concat(m, F.create_map(p["key"], p["value"]))))


def group(pairs: Column, count_tag: int, members: tuple[int, ...] = ()) -> Column:
    """The entries of a repeating group: ``array<array<pair>>``. The tag behind the count opens each entry; the count caps them; an entry
    ends where a tag repeats, the group where a tag is no member (if ``members`` are given)."""
    keys = F.transform(pairs, lambda p: p["key"])
    at = F.array_position(keys, str(count_tag)).cast("int")
    n = F.get(pairs, at - 1)["value"].try_cast("int")
    body = F.slice(pairs, at + 1, F.greatest(F.size(pairs) - at, F.lit(0)))
    opener = F.get(body, F.lit(0))["key"]
    ok = [str(m) for m in members]
    zero = F.struct(F.array().cast(f"array<{PAIR}>").alias("done"), F.array().cast(PAIR).alias("open"), F.lit(False).alias("over"))

    def step(acc: Column, p: Column) -> Column:
        opens = (p["key"] == opener) | F.exists(acc["open"], lambda q: q["key"] == p["key"])
        done = F.when(opens & (F.size(acc["open"]) > 0), F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])
        open_ = F.when(opens, F.array(p)).otherwise(F.concat(acc["open"], F.array(p)))
        outside = F.lit(False) if not ok else ~p["key"].isin(*ok, "0") & (p["key"] != opener)
        over = acc["over"] | outside
        return F.struct(F.when(over, acc["done"]).otherwise(done).alias("done"), F.when(over, acc["open"]).otherwise(open_).alias("open"), over.alias("over"))

    found = F.aggregate(body, zero, step, lambda a: F.when(F.size(a["open"]) > 0, F.concat(a["done"], F.array(a["open"]))).otherwise(a["done"]))
    return F.when((at > 0) & (n > 0), F.slice(found, F.lit(1), n)).otherwise(F.array().cast(f"array<{PAIR}>"))


def indexed_group(pairs: Column, name: str) -> Column:
    """The entries of a rendered group ``name[i].member``, in the order of ``i``; gaps are allowed."""
    shape = rf"(?si)^#?{name}\[(\d+)\]\.?(.*)\z"
    mine = F.filter(pairs, lambda p: p["key"].rlike(shape))
    index = lambda p: F.regexp_extract(p["key"], shape, 1).cast("int")
    numbers = F.array_sort(F.array_distinct(F.transform(mine, index)))
    return F.transform(numbers, lambda i: F.transform(F.filter(mine, lambda p: index(p) == i), lambda p: _pair(F.regexp_extract(p["key"], shape, 2), p["value"])))


def to_text(pairs: Column, sep: str = "\x01") -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["key"], F.lit("="), F.coalesce(p["value"], F.lit("")))), sep)


def version(begin_string: Column, default: str | None = None) -> Column:
    """``FIX.4.2`` and ``4.2`` as ``4.2``, ``FIXT.1.1`` as ``FIXT1.1``."""
    bare = F.regexp_extract(F.upper(F.trim(begin_string)), r"^(?:8=)?(?:FIX\.?)?(T?\.?\d+(?:\.\d+)*(?:SP\d+)?)\z", 1)
    return F.coalesce(F.nullif(F.regexp_replace(bare, r"^T\.?", "FIXT"), F.lit("")), F.lit(default))
