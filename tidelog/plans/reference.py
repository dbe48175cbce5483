"""Queries for the engine's own operators, over whole tables, each with the SQL that must give the same rows where there is one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import classify, codes, ident, tags
from tidelog.functions import values as V
from tidelog.operators import book, events, joins, lifecycle
from tidelog.runtime import scan, settled, shared_dir, spread
from tidelog.shapes import PARTITION, PRIMARY, SORT, Shape, cast_onto
from tidelog.sources import dictionary, logs
from tidelog.sources.store import Table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, k, True) for n, k in fields])


# casting


@query("SELECT l_linenumber, CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity, CAST(NULL AS VARCHAR) AS note FROM lineitem")
def cast_reorder(spark: SparkSession, d: str) -> DataFrame:
    want = _struct(("l_linenumber", T.IntegerType()), ("l_orderkey", T.IntegerType()), ("l_quantity", T.LongType()), ("note", T.StringType()))
    return cast_onto(scan(spark, d, "lineitem"), want)


@query("SELECT o_orderkey, CAST(CASE WHEN x > 2147483647 THEN x - 4294967296 ELSE x END AS INTEGER) AS wrapped FROM (SELECT o_orderkey, (o_orderkey * 2654435761) % 4294967296 AS x FROM orders)")
def cast_wraps(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "orders").select("o_orderkey", F.pmod(F.col("o_orderkey") * 2654435761, F.lit(4294967296)).alias("wrapped"))
    return cast_onto(rows, _struct(("o_orderkey", T.LongType()), ("wrapped", T.IntegerType())))


@query("SELECT n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS region FROM nation")
def cast_map_to_struct(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "nation").select("n_nationkey", F.create_map(F.lit("name"), F.col("n_name"), F.lit("region"), F.col("n_regionkey").cast("string")).alias("m"))
    out = cast_onto(rows, _struct(("n_nationkey", T.IntegerType()), ("m", _struct(("name", T.StringType()), ("region", T.LongType()), ("gone", T.StringType())))))
    return out.where("m.gone is null").select("n_nationkey", F.col("m.name").alias("n_name"), F.col("m.region").alias("region"))


@query("SELECT p_partkey, k.key AS key, k.value AS value FROM (SELECT p_partkey, unnest([{'key': 'brand', 'value': p_brand}, {'key': 'size', 'value': CAST(p_size AS VARCHAR)}]) AS k FROM part)")
def cast_struct_to_map(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "part").select("p_partkey", F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("s"))
    return cast_onto(rows, _struct(("p_partkey", T.LongType()), ("s", T.MapType(T.StringType(), T.StringType())))).select("p_partkey", F.explode("s"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(pos AS INTEGER) AS pos, v AS value FROM (SELECT l_orderkey, l_linenumber, l_partkey, unnest([l_discount, l_tax]) AS v, unnest([0, 1]) AS pos FROM lineitem)")
def cast_struct_to_list(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.struct("l_discount", "l_tax").alias("s"))
    want = _struct(("l_orderkey", T.LongType()), ("l_linenumber", T.IntegerType()), ("l_partkey", T.LongType()), ("s", T.ArrayType(T.DoubleType())))
    return cast_onto(rows, want).select("l_orderkey", "l_linenumber", "l_partkey", F.posexplode("s").alias("pos", "value"))


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS c_mktsegment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier")
def merge_schema_widen(spark: SparkSession, d: str) -> DataFrame:
    a = scan(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_mktsegment")
    b = scan(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    narrow = Shape("Party", _struct(("id", T.LongType()), ("name", T.StringType()), ("balance", T.DoubleType())))
    wide = cast_onto(a, narrow, merge_schema=True)
    return wide.unionByName(cast_onto(b, wide.schema))


# classification and messages


@query(r"""
SELECT row_id, CAST(CASE WHEN regexp_matches(message, '35=8(\D|$)|ExecutionReport') THEN 210
  WHEN regexp_matches(message, '35=[DFG](\D|$)|NewOrderSingle|OrderCancel(Request|Replace)') THEN 110
  WHEN regexp_matches(message, '35=X(\D|$)|MarketDataIncrementalRefresh') THEN 310 WHEN regexp_matches(message, '35=W(\D|$)|MarketDataSnapshot') THEN 320
  WHEN regexp_matches(message, '35=[SR](\D|$)|Quote(Request)?\b') THEN 120 WHEN regexp_matches(message, '35=d(\D|$)|SecurityDefinition') THEN 410 ELSE 0 END AS INTEGER) AS etype
FROM log_lines""")
def classify_event_type(spark: SparkSession, d: str) -> DataFrame:
    return spread(scan(spark, d, "log_lines").select("row_id", "message")).select("row_id", classify.event_type(F.col("message")).alias("etype"))


_PROTOCOL = r"""CASE WHEN regexp_matches(message, '(?s)(?:^|[^0-9])8=FIXT?.*[^0-9]35=UL(?:[^A-Za-z0-9]|$)') THEN 'UL'
  WHEN regexp_matches(message, '(?:^|[^0-9])8=FIXT?') THEN 'FIX'
  WHEN regexp_matches(message, '(?s)#[A-Za-z][A-Za-z0-9_.\-]*(?:\[\d+\])?\s*=.*#[A-Za-z][A-Za-z0-9_.\-]*(?:\[\d+\])?\s*=') THEN 'UL' ELSE 'OTHER' END"""


@query(f"SELECT row_id, {_PROTOCOL} AS protocol FROM log_lines")
def classify_protocol(spark: SparkSession, d: str) -> DataFrame:
    return spread(scan(spark, d, "log_lines").select("row_id", "message")).select("row_id", classify.protocol(F.col("message")).alias("protocol"))


_NAME, _TOKEN = tags.NAME, r"#[A-Za-z][A-Za-z0-9_.\-]*(?:\[\d+\])?\s*="
_SEPARATOR = rf"""CASE WHEN protocol = 'UL' THEN CASE WHEN regexp_extract(message, '(?s){_TOKEN}.*?(\^A|.){_TOKEN}', 1) IN ('|', '^A', '^', ';', chr(1)) THEN regexp_extract(message, '(?s){_TOKEN}.*?(\^A|.){_TOKEN}', 1) ELSE '#' END
  WHEN regexp_extract(message, '(?s)(?:^|[^0-9])8=FIXT?[^\x01|;^ \t\r\n\f\x0b]*(\^A|[^\s])', 1) <> ''
  THEN regexp_extract(message, '(?s)(?:^|[^0-9])8=FIXT?[^\x01|;^ \t\r\n\f\x0b]*(\^A|[^\s])', 1) ELSE chr(1) END"""


def _messages(spark: SparkSession, d: str, *columns: str, where: str = "protocol <> 'OTHER'") -> DataFrame:
    return spread(scan(spark, d, "log_lines").where(where).select("row_id", *columns, "message"))


@query(f"SELECT row_id, {_SEPARATOR} AS separator FROM log_lines WHERE protocol <> 'OTHER'")
def detect_separator(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).select("row_id", tags.separator(F.col("message")).alias("separator"))


#: The pairs of every message: wire messages up to the checksum, rendered ones from their first name on.
_PAIRS = rf"""bodies AS (
  SELECT row_id, protocol = 'UL' AS named, {_SEPARATOR} AS sep, CASE WHEN protocol = 'UL' THEN regexp_extract(message, '(?s)({_TOKEN}.*)', 1) ELSE regexp_extract(message, '(?s)(?:^|[^0-9])(8=FIXT?.*)', 1) END AS body
  FROM log_lines WHERE protocol <> 'OTHER'),
kept AS (SELECT row_id, named, list_filter(string_split(body, sep), lambda t: regexp_matches(t, '(?s)^\s*\d+\s*=') OR (named AND regexp_matches(t, '(?s)^\s*#?{_NAME}\s*='))) AS toks FROM bodies),
keyed AS (SELECT row_id, list_transform(toks, lambda t: ltrim(trim(split_part(t, '=', 1)), '#')) AS ks, list_transform(toks, lambda t: regexp_replace(regexp_replace(t, '(?s)^[^=]*=', ''), '^\s+|\s+$', '', 'g')) AS vs FROM kept),
cut AS (SELECT row_id, ks, vs, CASE WHEN list_contains(ks, '10') THEN list_position(ks, '10') ELSE len(ks) END AS n FROM keyed),
pairs AS (SELECT row_id, unnest(range(n)) AS pos, unnest(ks[1:n]) AS key, unnest(vs[1:n]) AS value FROM cut)"""

#: Pairs with a value by their tag, null if there is none.
_TAGGED = f"""names AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {t})" for n, t in tags.TAG_OF.items())}) AS v(name, tag)),
tagged AS (SELECT row_id, pos, key, value, coalesce(TRY_CAST(CASE WHEN regexp_matches(key, '^[0-9]+$') THEN key END AS INTEGER), names.tag) AS tag FROM pairs LEFT JOIN names ON lower(key) = name
  WHERE lower(trim(value)) NOT IN ({", ".join(f"'{w}'" for w in V.NULL_WORDS)}))"""


def _parsed(spark: SparkSession, d: str, where: str = "protocol <> 'OTHER'") -> DataFrame:
    return tags.parse(_messages(spark, d, "unix", "protocol", where=where), named=F.col("protocol") == "UL")


@query(f"WITH {_PAIRS} SELECT row_id, CAST(pos AS INTEGER) AS pos, key, value FROM pairs")
def parse_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d).select("row_id", F.posexplode("pairs").alias("pos", "p")).select("row_id", "pos", "p.key", "p.value")


_NANOS = """CASE WHEN regexp_full_match({v}, '\\d{{8}}-\\d\\d:\\d\\d:\\d\\d(\\.\\d{{1,9}})?') THEN epoch_us(try_strptime(substr({v}, 1, 17), '%Y%m%d-%H:%M:%S')) * 1000 + CAST(rpad(substr({v}, 19), 9, '0') AS BIGINT)
  WHEN regexp_full_match({v}, '\\d{{8}}') THEN epoch_us(try_strptime({v}, '%Y%m%d')) * 1000 END"""
_READ = {
    "S": "{v}", "L": "TRY_CAST(CASE WHEN regexp_full_match({v}, '[+-]?[0-9]+') THEN {v} END AS BIGINT)", "D": "TRY_CAST(CASE WHEN regexp_full_match({v}, '[+-]?[0-9]*[.]?[0-9]*([eE][+-]?[0-9]+)?') THEN {v} END AS DOUBLE)", "X": "hex(encode({v}))", "N": _NANOS,
    "B": "CASE WHEN lower(trim({v})) IN ('y', 'yes', 'true', 't', '1', 'on', 'oui', 'si', 'ja', 'da') THEN true WHEN lower(trim({v})) IN ('n', 'no', 'false', 'f', '0', 'off', 'non', 'nein', 'nej') THEN false END",
}


@query(f"""WITH {_PAIRS}, {_TAGGED}, once AS (SELECT row_id, tag, max(value) AS value FROM tagged GROUP BY row_id, tag HAVING count(*) = 1),
wide AS (SELECT b.row_id, {", ".join(f"max(value) FILTER (tag = {t}) AS t{t}" for t, _, _ in tags.LIFTED)} FROM bodies b LEFT JOIN once ON b.row_id = once.row_id GROUP BY b.row_id)
SELECT row_id, {", ".join(f"{_READ[k].format(v=f't{t}')} AS {n}" for t, n, k in tags.LIFTED)} FROM wide""")
def lift_columns(spark: SparkSession, d: str) -> DataFrame:
    lifted = [F.hex(n).alias(n) if k == "X" else F.col(n) for _, n, k in tags.LIFTED]
    return tags.lift(_parsed(spark, d)).select("row_id", *lifted)


@query(f"""WITH {_PAIRS}, {_TAGGED}, many AS (SELECT row_id, pos, tag, value, count(*) OVER (PARTITION BY row_id, tag) AS n FROM tagged WHERE tag IS NOT NULL)
SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY pos) - 1 AS INTEGER) AS pos, tag, value FROM many WHERE NOT (n = 1 AND tag IN ({", ".join(str(t) for t, _, _ in tags.LIFTED)}))""")
def tags_left(spark: SparkSession, d: str) -> DataFrame:
    rows = tags.lift(_parsed(spark, d))
    return rows.select("row_id", F.posexplode("fix_tags").alias("pos", "t")).select("row_id", "pos", "t.tag", "t.value")


@query(f"""WITH {_PAIRS}, {_TAGGED} SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY pos) - 1 AS INTEGER) AS pos, regexp_replace(key, '\\[\\d+\\]', '', 'g') AS key, value FROM tagged WHERE tag IS NULL""")
def keys_left(spark: SparkSession, d: str) -> DataFrame:
    rows = tags.lift(_parsed(spark, d))
    return rows.select("row_id", F.posexplode("keyval").alias("pos", "t")).select("row_id", "pos", "t.key", "t.value")


#: Of the messages of market data the values of each entry, which its action opens, else its type.
_ENTRIES = """openers AS (SELECT row_id, CASE WHEN bool_or(tag = 279) THEN 279 ELSE 269 END AS opener FROM tagged GROUP BY row_id HAVING bool_or(tag = 35 AND value IN ('W', 'X'))),
opened AS (SELECT row_id, pos, tag, value, count(*) FILTER (tag = opener) OVER (PARTITION BY row_id ORDER BY pos) - 1 AS entry FROM tagged JOIN openers USING (row_id)),
entries AS (SELECT row_id, entry, max(value) FILTER (tag = 269) AS kind, max(value) FILTER (tag = 270) AS px, max(value) FILTER (tag = 271) AS qty, max(value) FILTER (tag = 278) AS id, max(value) FILTER (tag = 279) AS action,
  max(value) FILTER (tag = 272) AS day, max(value) FILTER (tag = 273) AS clock FROM opened WHERE entry >= 0 GROUP BY row_id, entry)"""


@query(f"WITH {_PAIRS}, {_TAGGED}, {_ENTRIES} SELECT row_id, CAST(entry AS INTEGER) AS entry, kind, CAST(px AS DOUBLE) AS px, CAST(qty AS DOUBLE) AS qty FROM entries")
def market_data_entries(spark: SparkSession, d: str) -> DataFrame:
    rows = _parsed(spark, d).where(tags.value_of(F.col("pairs"), 35).isin("W", "X")).select("row_id", F.posexplode(tags.group(F.col("pairs"), 268, events.ENTRY)).alias("entry", "e"))
    return rows.select("row_id", "entry", tags.value_of(F.col("e"), 269).alias("kind"), V.number(tags.value_of(F.col("e"), 270)).alias("px"), V.number(tags.value_of(F.col("e"), 271)).alias("qty"))


def _wire(kind: str, value: str) -> str:
    """The code of a wire character in SQL."""
    return f"coalesce(CASE {value} {' '.join(f'WHEN {chr(39)}{w}{chr(39)} THEN {c}' for c, w in codes.WIRE[kind].items())} END, 0)"


_EVENT_TAGS = (6, 11, 14, 17, 30, 31, 32, 34, 35, 37, 38, 39, 40, 41, 42, 44, 49, 52, 54, 55, 58, 59, 60, 99, 102, 103, 111, 122, 126, 150, 151, 207, 268, 378, 432, 880, 1003, 1057)
_EVENT = "etype, state, side, px, qty, kind, tif, stop_px, display_qty, filled_qty, leaves_qty, avg_px, order_id, client_order_id, prev_client_order_id, reason_code, reason, exec_id, trade_id, aggressor".split(", ")
_HEAD = "pos, unix, unix_hour, eunix, seq, symbol, venue".split(", ")


def _number(t: int) -> str:
    return _READ["D"].format(v=f"t{t}")


_EVENTS = f"""firsts AS (SELECT row_id, tag, arg_min(value, pos) AS value FROM tagged WHERE tag IS NOT NULL GROUP BY row_id, tag),
m0 AS (SELECT row_id, {", ".join(f"max(value) FILTER (tag = {t}) AS t{t}" for t in _EVENT_TAGS)} FROM firsts GROUP BY row_id),
m AS (SELECT *, coalesce(t35, CASE WHEN t268 IS NOT NULL THEN 'X' WHEN t17 IS NOT NULL OR t150 IS NOT NULL THEN '8' WHEN t11 IS NOT NULL THEN 'D' END) AS type, {_NANOS.format(v="t52")} AS sent,
  coalesce({_NANOS.format(v="t126")}, {_NANOS.format(v="t432")} + 86399999999999) AS eunix, {_READ["L"].format(v="t34")} AS seq, coalesce(t55, '') AS symbol, coalesce(t30, t207, t49) AS venue FROM m0),
told AS (SELECT *, {_NANOS.format(v="t60")} AS transacted, coalesce({_NANOS.format(v="t42")}, {_NANOS.format(v="t122")}, sent) AS sent_at FROM m),
rows AS (
  SELECT row_id, 0 AS pos, coalesce(transacted, sent_at, 0) AS unix, eunix, seq, symbol, venue, 110 AS etype,
    CASE type WHEN 'D' THEN 110 WHEN 'F' THEN 240 WHEN 'G' THEN 230 WHEN '8' THEN {_wire("State", "t39")} ELSE 0 END AS state, {_wire("Side", "t54")} AS side, {_number(44)} AS px, {_number(38)} AS qty,
    {_wire("OrderKind", "t40")} AS kind, {_wire("TimeInForce", "t59")} AS tif, {_number(99)} AS stop_px, {_number(111)} AS display_qty, {_number(14)} AS filled_qty, {_number(151)} AS leaves_qty, {_number(6)} AS avg_px, t37 AS order_id,
    t11 AS client_order_id, t41 AS prev_client_order_id, TRY_CAST(coalesce(t103, t102) AS INTEGER) AS reason_code, t58 AS reason, CAST(NULL AS VARCHAR) AS exec_id, CAST(NULL AS VARCHAR) AS trade_id, CAST(NULL AS BOOLEAN) AS aggressor
  FROM told WHERE type IN ('D', 'F', 'G', '9', '8')
  UNION ALL
  SELECT row_id, CASE type WHEN '8' THEN 1 ELSE 0 END, coalesce(transacted, sent_at, 0), eunix, seq, symbol, venue, 210,
    CASE WHEN t150 IN ('F', '1', '2') THEN 410 WHEN t150 = 'G' THEN 520 WHEN t150 = 'H' THEN 510 ELSE {_wire("State", "t150")} END, {_wire("Side", "t54")}, {_number(31)}, {_number(32)},
    {_wire("ExecKind", "t150")}, 0, NULL, NULL, {_number(14)}, {_number(151)}, {_number(6)}, t37, t11, NULL, TRY_CAST(t378 AS INTEGER), t58, t17, coalesce(t1003, t880), CASE upper(left(trim(t1057), 1)) WHEN 'Y' THEN true WHEN 'N' THEN false END
  FROM told WHERE type = 'AE' OR (type = '8' AND t150 IN ('F', '1', '2', 'G', 'H'))
  UNION ALL
  SELECT row_id, 2 * entry, coalesce(transacted, {_NANOS.format(v="day || '-' || clock")}, {_NANOS.format(v="day")}, CASE WHEN clock IS NULL THEN NULL WHEN sent IS NULL THEN 0 ELSE sent - sent % 86400000000000 END + epoch_us(try_strptime('19700101 ' || substr(clock, 1, 8), '%Y%m%d %H:%M:%S')) * 1000
      + CAST(rpad(substr(clock, 10), 9, '0') AS BIGINT), sent_at, 0), eunix, seq, symbol, venue, CASE kind WHEN '2' THEN 210 ELSE 110 END,
    CASE WHEN kind = '2' THEN 410 WHEN a = 110 THEN 210 WHEN a >= 200 THEN 510 ELSE 200 END, CASE kind WHEN '0' THEN 100 WHEN '1' THEN 200 ELSE 0 END, TRY_CAST(px AS DOUBLE), TRY_CAST(qty AS DOUBLE), CASE kind WHEN '2' THEN 310 ELSE 210 END, 0, NULL, NULL, NULL, NULL, NULL,
    CASE WHEN kind <> '2' THEN coalesce(id, CASE kind WHEN '0' THEN 'BUY@' ELSE 'SELL@' END || px) END, NULL, NULL, NULL, t58, CASE WHEN kind = '2' THEN id END, NULL, NULL
  FROM (SELECT *, {_wire("UpdateAction", "coalesce(action, CASE type WHEN 'W' THEN '0' END)")} AS a FROM entries JOIN told USING (row_id)) WHERE kind IN ('0', '1', '2'))"""


@query(f"WITH {_PAIRS}, {_TAGGED}, {_ENTRIES}, {_EVENTS} SELECT row_id, {', '.join(c if c != 'unix_hour' else 'unix - unix % 3600000000000 AS unix_hour' for c in _HEAD + _EVENT)} FROM rows")
def events_from_messages(spark: SparkSession, d: str) -> DataFrame:
    rows = _parsed(spark, d).select("row_id", tags.from_pairs(tags.drop_null_values(F.col("pairs"))).alias("pairs"))
    return events.events(rows).select("row_id", *_HEAD, *_EVENT)


@query(f"SELECT cast(sum(CASE WHEN protocol = 'UL' THEN 1 ELSE 0 END) AS BIGINT) AS named, count(*) AS messages FROM log_lines WHERE ({_PROTOCOL}) <> 'OTHER'")
def message_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(scan(spark, d, "log_lines").select("message")).select(classify.protocol(F.col("message")).alias("p")).where("p <> 'OTHER'")
    return rows.agg(F.count_if(F.col("p") == "UL").alias("named"), F.count("*").alias("messages"))


@query(f"WITH {_PAIRS} SELECT row_id, string_agg(key || '=' || value, chr(1) ORDER BY pos) AS written, true AS same FROM pairs GROUP BY row_id")
def message_round_trip(spark: SparkSession, d: str) -> DataFrame:
    rows = _parsed(spark, d).where(F.size("pairs") > 0).withColumn("written", tags.to_text(F.col("pairs")))
    again = tags.parse(rows.select("row_id", "written", "protocol", F.col("pairs").alias("first")), "written", named=F.col("protocol") == "UL")
    return again.select("row_id", "written", (F.col("pairs") == F.col("first")).alias("same"))


# typed reading


@query("SELECT event_id, epoch_us(ts) * 1000 AS at, epoch_us(date_trunc('day', ts)) * 1000 AS day FROM events")
def stamp_nanos(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(scan(spark, d, "events").select("event_id", "ts")).select("event_id", F.date_format("ts", "yyyyMMdd-HH:mm:ss.SSSSSS").alias("t"), F.date_format("ts", "yyyyMMdd").alias("day"))
    return rows.select("event_id", V.nanos(F.col("t")).alias("at"), V.nanos(F.col("day")).alias("day"))


@query("""SELECT o_orderkey, CASE WHEN lower(trim(w)) IN ('y', 'yes', 'true', 't', '1', 'on', 'oui', 'si', 'ja', 'da') THEN true WHEN lower(trim(w)) IN ('n', 'no', 'false', 'f', '0', 'off', 'non', 'nein', 'nej') THEN false END AS flag
FROM (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'NEIN' WHEN 2 THEN '0' WHEN 3 THEN 'maybe' WHEN 4 THEN o_orderstatus ELSE '' END AS w FROM orders)""")
def bool_words(spark: SparkSession, d: str) -> DataFrame:
    k = F.pmod("o_orderkey", F.lit(6))
    word = F.when(k == 0, " Yes ").when(k == 1, "NEIN").when(k == 2, "0").when(k == 3, "maybe").when(k == 4, F.col("o_orderstatus")).otherwise("")
    return scan(spark, d, "orders").select("o_orderkey", V.bool_words(word).alias("flag"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_linenumber % 3 <> 0 THEN l_extendedprice END, 2) AS px, CASE WHEN l_linenumber % 3 = 1 THEN CAST(l_quantity AS BIGINT) END AS qty FROM lineitem")
def guarded_numbers(spark: SparkSession, d: str) -> DataFrame:
    third = F.pmod("l_linenumber", F.lit(3))
    px = F.when(third == 0, F.lit("12,5")).otherwise(F.round("l_extendedprice", 2).cast("decimal(18,2)").cast("string"))
    qty = F.when(third == 1, F.col("l_quantity").cast("long").cast("string")).otherwise("n/a")
    return scan(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", V.number(px).alias("px"), V.integer(qty).alias("qty"))


@query("SELECT h AS unix_hour, count(*) AS n FROM (SELECT unix - ((unix % 3600000000000) + 3600000000000) % 3600000000000 AS h FROM (SELECT unix FROM market_order UNION ALL SELECT -unix FROM market_order)) GROUP BY h")
def hour_bucket(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "market_order").select("unix")
    return rows.union(rows.select(-F.col("unix"))).groupBy(V.hour_of(F.col("unix")).alias("unix_hour")).agg(F.count("*").alias("n"))


@query("""SELECT state // 100 * 100 AS band, state >= 200 AND state < 400 AS live, state >= 400 AS terminal, CASE side // 100 WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END AS sign, count(*) AS n, count(CASE WHEN tif >= 200 THEN 1 END) AS rests
FROM market_order GROUP BY ALL""")
def code_bands(spark: SparkSession, d: str) -> DataFrame:
    m = scan(spark, d, "market_order")
    keys = [codes.band(F.col("state")).alias("band"), codes.is_live(F.col("state")).alias("live"), codes.is_terminal(F.col("state")).alias("terminal"), codes.sign(F.col("side")).alias("sign")]
    return m.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(codes.rests(F.col("tif"))).alias("rests"))


@query("""SELECT symbol, CAST(CASE left(cfi, 1) WHEN 'E' THEN 110 WHEN 'D' THEN 120 WHEN 'C' THEN 130 WHEN 'T' THEN 140 WHEN 'J' THEN 150 WHEN 'M' THEN 160 WHEN 'F' THEN 210 WHEN 'O' THEN 220 WHEN 'S' THEN 230 WHEN 'R' THEN 240 ELSE
  CASE upper(trim(security_type)) WHEN 'CS' THEN 110 WHEN 'PS' THEN 110 WHEN 'MF' THEN 130 WHEN 'FUT' THEN 210 WHEN 'OPT' THEN 220 WHEN 'WAR' THEN 240 WHEN 'MLEG' THEN 320 WHEN 'FXSPOT' THEN 140 WHEN 'CASH' THEN 140 WHEN 'FXFWD' THEN 250 WHEN 'FXNDF' THEN 250 WHEN 'FORWARD' THEN 250
  WHEN 'CDS' THEN 230 WHEN 'IRS' THEN 230 WHEN 'FXSWAP' THEN 230 WHEN 'REPO' THEN 410 WHEN 'BUYSELL' THEN 410 WHEN 'SECLOAN' THEN 420 WHEN 'CORP' THEN 120 WHEN 'TBOND' THEN 120 WHEN 'TNOTE' THEN 120 WHEN 'TBILL' THEN 120 WHEN 'MUNI' THEN 120 WHEN 'CB' THEN 120 WHEN 'GO' THEN 120 ELSE 0 END END AS INTEGER) AS kind FROM instrument""")
def asset_kind(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, d, "instrument").select("symbol", codes.asset_kind(F.col("cfi"), F.col("security_type")).alias("kind"))


@query("SELECT row_id, round(px * qty * coalesce(instrument.multiplier, CASE WHEN instrument.kind >= 100 AND instrument.kind < 200 THEN 1.0 END), 4) AS notional FROM market_order")
def notional(spark: SparkSession, d: str) -> DataFrame:
    worth = V.notional(F.col("px"), F.col("qty"), F.col("instrument.multiplier"), F.col("instrument.kind"))
    return scan(spark, d, "market_order").select("row_id", F.round(worth, 4).alias("notional"))


@query("""SELECT row_id, round(CASE WHEN px IS NULL OR qty IS NULL THEN avg_px WHEN avg_px IS NULL OR coalesce(filled_qty = 0, true) THEN px ELSE (avg_px * filled_qty + px * qty) / nullif(filled_qty + qty, 0) END, 6) AS avg_px,
  round(CASE WHEN state >= 400 THEN 0.0 ELSE greatest(qty - coalesce(filled_qty, 0.0), 0.0) END, 6) AS leaves, CAST(CASE WHEN leaves_qty <= 0 THEN 210 WHEN filled_qty > 0 THEN 120 ELSE 110 END AS INTEGER) AS action FROM market_order""")
def order_figures(spark: SparkSession, d: str) -> DataFrame:
    """Average price after one more fill, what is left, and what a level does."""
    m = {c: F.col(c) for c in ("avg_px", "filled_qty", "px", "qty", "state", "leaves_qty")}
    avg = V.weighted(m["avg_px"], m["filled_qty"], m["px"], m["qty"])
    left = V.leaves(m["state"], m["qty"], m["filled_qty"])
    return scan(spark, d, "market_order").select("row_id", F.round(avg, 6).alias("avg_px"), F.round(left, 6).alias("leaves"), codes.update_action(m["filled_qty"], m["leaves_qty"]).alias("action"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) * 1000 ELSE epoch_us(date_trunc('day', ts)) * 1000 + 86399999999999 END AS expires FROM events")
def expiries(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(scan(spark, d, "events").select("event_id", "ts"))
    time = F.when(F.pmod("event_id", F.lit(2)) == 0, F.date_format("ts", "yyyyMMdd-HH:mm:ss.SSSSSS"))
    return rows.select("event_id", V.expires(time, F.date_format("ts", "yyyyMMdd")).alias("expires"))


@query("SELECT begin_string, CASE WHEN begin_string LIKE 'FIXT.%' THEN 'FIXT' || substr(begin_string, 6) WHEN regexp_full_match(begin_string, 'FIX[.]?[0-9].*') THEN regexp_extract(begin_string, 'FIX[.]?(.*)', 1) ELSE 'unknown' END AS version, count(*) AS n FROM log_lines GROUP BY ALL")
def begin_versions(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, d, "log_lines").groupBy("begin_string").agg(F.count("*").alias("n")).select("begin_string", tags.version(F.col("begin_string"), "unknown").alias("version"), "n")


# lifecycles and books


@query("""SELECT row_id, CAST(row_number() OVER w - 1 AS BIGINT) AS version, nullif(lag(hash) OVER w, 0) AS prev_hash, coalesce(lag(state) OVER w, 0) AS prev_state, lag(unix) OVER w AS prev_unix FROM market_order WINDOW w AS (PARTITION BY xhash ORDER BY unix, row_id)""")
def version_chain(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "market_order").select("row_id", "xhash", "hash", "unix", "state")
    return lifecycle.version_chain(rows, order=("unix", "row_id")).select("row_id", "version", "prev_hash", "prev_state", "prev_unix")


@query("""SELECT row_id, last_value(px IGNORE NULLS) OVER w AS px, last_value(stop_px IGNORE NULLS) OVER w AS stop_px, last_value(order_id IGNORE NULLS) OVER w AS order_id, first_value(unix) OVER w AS cunix FROM market_order
WINDOW w AS (PARTITION BY xhash ORDER BY unix, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def carried_forward(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "market_order").select("row_id", "xhash", "unix", "cunix", "px", "stop_px", "order_id")
    return lifecycle.carried(rows, ["px", "stop_px", "order_id"], order=("unix", "row_id")).select("row_id", "px", "stop_px", "order_id", "cunix")


@query("""WITH e AS (SELECT min(exec_id) AS exec_id, order_xhash, unix, hash, px, qty FROM execution_report WHERE order_xhash IS NOT NULL GROUP BY order_xhash, unix, hash, px, qty)
SELECT order_xhash, unix, hash, round(coalesce(sum(CASE WHEN px IS NOT NULL THEN qty END) OVER w, 0), 6) AS filled_qty, round(sum(px * qty) OVER w / nullif(sum(CASE WHEN px IS NOT NULL THEN qty END) OVER w, 0), 6) AS avg_px FROM e
WINDOW w AS (PARTITION BY order_xhash ORDER BY unix, hash ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_fills(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "execution_report").where("order_xhash is not null").select("order_xhash", "unix", "hash", "px", "qty").distinct()
    return lifecycle.fills(rows).select("order_xhash", "unix", "hash", F.round("filled_qty", 6).alias("filled_qty"), F.round("avg_px", 6).alias("avg_px"))


@query("""WITH f AS (SELECT symbol, min(struct_pack(at := unix, r := row_id)) FILTER (WHERE order_id IS NOT NULL) AS o, min(struct_pack(at := unix, r := row_id)) FILTER (WHERE reason IS NOT NULL) AS s FROM market_order GROUP BY symbol),
m AS (SELECT symbol, o AS at FROM f WHERE o IS NOT NULL UNION SELECT symbol, s FROM f WHERE s IS NOT NULL)
SELECT m.symbol, m.at.at AS unix, m.at.r AS row_id, CAST(row_number() OVER (PARTITION BY m.symbol ORDER BY m.at) - 1 AS BIGINT) AS version, CASE WHEN f.o <= m.at THEN a.order_id END AS order_id, CASE WHEN f.s <= m.at THEN b.reason END AS reason
FROM m JOIN f USING (symbol) LEFT JOIN market_order a ON a.row_id = f.o.r LEFT JOIN market_order b ON b.row_id = f.s.r""")
def learnt_once(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.learnt(scan(spark, d, "market_order"), "symbol", ["order_id", "reason"], order=("unix", "row_id"))


@query("""WITH b AS (SELECT instrument_hash, side, unix, max(row_id) AS row_id FROM (SELECT *, row_number() OVER () AS row_id FROM (SELECT DISTINCT instrument_hash, side, unix, version, depth FROM book_side)) GROUP BY ALL),
r AS (SELECT instrument_hash, side, unix, max(struct_pack(v := version, d := coalesce(depth, -1))) AS x FROM book_side GROUP BY ALL),
n AS (SELECT *, coalesce(lead(unix) OVER (PARTITION BY instrument_hash, side ORDER BY unix), (SELECT max(unix) FROM book_side)) AS nxt FROM r)
SELECT instrument_hash, side, h AS unix, unix AS sunix, x.v AS version FROM (SELECT *, unnest(range(unix - unix % 3600000000000 + 3600000000000, nxt, 3600000000000)) AS h FROM n)""")
def hourly_grid(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "book_side").groupBy("instrument_hash", "side", "unix").agg(F.max(F.struct("version", F.coalesce("depth", F.lit(-1)))).alias("x"))
    return lifecycle.grid(rows.select("instrument_hash", "side", "unix", "x.version"), ["instrument_hash", "side"])


@query("""SELECT symbol, unix, hash, alive[1].px AS px, alive[1].qty AS qty, CAST(len(alive) AS INTEGER) AS depth, round(coalesce(list_sum(list_transform(alive, lambda x: x.qty)), CASE WHEN alive IS NOT NULL THEN 0.0 END), 6) AS total_qty FROM book_side""")
def side_summary(spark: SparkSession, d: str) -> DataFrame:
    s = book.side_summary(F.col("alive"))
    return scan(spark, d, "book_side").select("symbol", "unix", "hash", s["px"].alias("px"), s["qty"].alias("qty"), s["depth"].alias("depth"), F.round(s["total_qty"], 6).alias("total_qty"))


_LAST = "SELECT instrument_hash, alive FROM (SELECT *, row_number() OVER (PARTITION BY instrument_hash ORDER BY unix DESC, version DESC, hash DESC, runix DESC) AS rn FROM book_side WHERE side {s} AND alive IS NOT NULL) WHERE rn = 1"


@query(f"""WITH b AS ({_LAST.format(s="BETWEEN 100 AND 199")}), a AS ({_LAST.format(s="BETWEEN 200 AND 299")}),
q AS (SELECT instrument_hash, b.alive[1].px AS bp, b.alive[1].qty AS bq, a.alive[1].px AS ap, a.alive[1].qty AS aq FROM b JOIN a USING (instrument_hash))
SELECT instrument_hash, round((bp + ap) / 2, 6) AS px, bq + aq AS qty, round(ap - bp, 6) AS spread, round(CASE WHEN bq + aq > 0 THEN (bp * aq + ap * bq) / (bq + aq) END, 6) AS micro_px, round(CASE WHEN bq + aq > 0 THEN (bq - aq) / (bq + aq) END, 6) AS imbalance FROM q""")
def book_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "book_side").where("alive is not null")
    last = rows.groupBy("instrument_hash").agg(*[F.max_by("alive", F.when(codes.in_band(F.col("side"), b), F.struct("unix", "version", "hash", "runix"))).alias(n) for n, b in (("bid", 100), ("ask", 200))])
    last = last.where("bid is not null and ask is not null")
    s = book.book_summary(book.side_summary(F.col("bid")), book.side_summary(F.col("ask")))
    return last.select("instrument_hash", *[(F.round(c, 6) if n != "qty" else c).alias(n) for n, c in s.items()])


_CHANGES = """v AS (SELECT *, CASE WHEN side BETWEEN 100 AND 199 THEN 1 WHEN side BETWEEN 200 AND 299 THEN -1 ELSE 0 END AS sgn FROM market_order WHERE xhash IS NOT NULL AND unix IS NOT NULL),
r AS (SELECT instrument_hash, unix, xhash, version, row_id, sgn, px, CASE WHEN sgn <> 0 AND state < 400 AND px IS NOT NULL THEN coalesce(display_qty, leaves_qty, qty, 0) ELSE 0 END AS q FROM v),
w AS (SELECT *, lag(sgn) OVER l AS psgn, lag(px) OVER l AS ppx, lag(q) OVER l AS pq FROM r WINDOW l AS (PARTITION BY xhash ORDER BY unix, version, row_id)),
m AS (SELECT instrument_hash, unix, psgn AS side, ppx AS px, -pq AS delta FROM w UNION ALL SELECT instrument_hash, unix, sgn, px, q FROM w),
c AS (SELECT instrument_hash, unix, side, px, sum(delta) AS delta FROM m WHERE px IS NOT NULL AND delta <> 0 GROUP BY ALL HAVING sum(delta) <> 0)"""


@query(f"WITH {_CHANGES} SELECT instrument_hash, side, px, unix, round(sum(delta) OVER (PARTITION BY instrument_hash, side, px ORDER BY unix), 9) AS qty FROM c")
def book_levels(spark: SparkSession, d: str) -> DataFrame:
    return book.levels(book.level_changes(scan(spark, d, "market_order")))


@query(f"""WITH {_CHANGES}, lv AS (SELECT instrument_hash, side, px, unix, round(sum(delta) OVER (PARTITION BY instrument_hash, side, px ORDER BY unix), 9) AS qty FROM c),
h AS (SELECT instrument_hash, side, px, unix - unix % 3600000000000 + 3600000000000 AS hour, arg_max(qty, unix) AS qty FROM lv GROUP BY ALL),
hrs AS (SELECT DISTINCT instrument_hash, hour FROM h),
sp AS (SELECT *, coalesce(lead(hour) OVER (PARTITION BY instrument_hash, side, px ORDER BY hour), 9223372036854775807) AS nxt FROM h),
j AS (SELECT hrs.instrument_hash, hrs.hour, side, px, qty FROM hrs JOIN sp ON sp.instrument_hash = hrs.instrument_hash AND sp.hour <= hrs.hour AND hrs.hour < sp.nxt AND sp.qty > 0)
SELECT hrs.instrument_hash, hrs.hour AS unix, max(px) FILTER (WHERE side = 1) AS bid_px, arg_max(qty, px) FILTER (WHERE side = 1) AS bid_qty, count(*) FILTER (WHERE side = 1) AS bid_depth,
  min(px) FILTER (WHERE side = -1) AS ask_px, arg_min(qty, px) FILTER (WHERE side = -1) AS ask_qty, count(*) FILTER (WHERE side = -1) AS ask_depth
FROM hrs LEFT JOIN j ON j.instrument_hash = hrs.instrument_hash AND j.hour = hrs.hour GROUP BY ALL""")
def book_hours(spark: SparkSession, d: str) -> DataFrame:
    return book.best_at_hours(book.levels(book.level_changes(scan(spark, d, "market_order"))))


# joins and keyed rows


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def first_row_per_key(spark: SparkSession, d: str) -> DataFrame:
    return joins.first_rows(scan(spark, d, "orders"), ["o_custkey"], ["o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_join_keys(spark: SparkSession, d: str) -> DataFrame:
    big = scan(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi_join(scan(spark, d, "customer"), big, ["c_custkey"])


@query("SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def anti_join_keys(spark: SparkSession, d: str) -> DataFrame:
    big = scan(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti_join(scan(spark, d, "customer"), big, ["c_custkey"])


@query("""WITH o AS (SELECT symbol, unix, max(row_id) AS order_row FROM market_order GROUP BY ALL), e AS (SELECT DISTINCT symbol, unix, hash FROM execution_report)
SELECT e.symbol, e.unix, e.hash, o.unix AS prev_unix, o.order_row AS prev_order_row FROM e ASOF LEFT JOIN o ON e.symbol = o.symbol AND e.unix >= o.unix""")
def as_of_orders(spark: SparkSession, d: str) -> DataFrame:
    right = scan(spark, d, "market_order").groupBy("symbol", "unix").agg(F.max("row_id").alias("order_row"))
    left = scan(spark, d, "execution_report").select("symbol", "unix", "hash").distinct()
    return joins.as_of(left, right, ["symbol"], "unix", slice_nanos=V.HOUR)


@query("SELECT symbol, min(unix) AS low, max(unix) AS high, count(DISTINCT xhash) AS lives FROM market_order GROUP BY symbol")
def key_ranges(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, d, "market_order").groupBy("symbol").agg(F.min("unix").alias("low"), F.max("unix").alias("high"), F.countDistinct("xhash").alias("lives"))


@query("SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return joins.duplicate_keys(scan(spark, d, "orders"), ["o_custkey", "o_orderpriority"])


# tables


_ORDER = Shape("Order", T.StructType([
    T.StructField("o_orderkey", T.LongType(), False, {PRIMARY: True, SORT: 0}), T.StructField("o_custkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
]))


def _table(spark: SparkSession) -> Table:
    return Table(spark, f"{shared_dir(spark)}/orders-{uuid.uuid4().hex}", _ORDER).create()


_CHANGED = "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders"


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice FROM orders")
def insert_only_merge(spark: SparkSession, d: str) -> DataFrame:
    t, o = _table(spark), scan(spark, d, "orders")
    t.append(o.where("o_orderkey % 3 = 0"))
    t.insert_new(o.withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return t.read()


@query(_CHANGED)
def upsert_changed(spark: SparkSession, d: str) -> DataFrame:
    t, o = _table(spark), scan(spark, d, "orders")
    t.append(o.where("o_orderkey % 4 <> 0"))
    t.upsert(o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))))
    return t.read()


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE NOT o_orderstatus = 'F'")
def delete_where(spark: SparkSession, d: str) -> DataFrame:
    t = _table(spark)
    t.append(scan(spark, d, "orders"))
    t.delete("o_orderstatus = 'F'")
    return t.read()


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def time_travel(spark: SparkSession, d: str) -> DataFrame:
    t, o = _table(spark), scan(spark, d, "orders")
    t.append(o.where("o_orderstatus <> 'P'"))
    at = t.head().id
    t.append(o.where("o_orderstatus = 'P'"))
    t.delete("o_orderstatus = 'F'")
    return t.read(snapshot_id=at)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def compaction(spark: SparkSession, d: str) -> DataFrame:
    t, o = _table(spark), scan(spark, d, "orders")
    for s in ("F", "O", "P"):
        t.append(o.where(F.col("o_orderstatus") == s))
    t.optimize(retain=1, older_than=0)
    return t.read()


_DAYS = Shape("Line", T.StructType([
    T.StructField("l_orderkey", T.LongType(), False, {PRIMARY: True, SORT: 0}), T.StructField("l_linenumber", T.IntegerType(), False, {PRIMARY: True}), T.StructField("l_returnflag", T.StringType(), False, {PARTITION: "identity"}),
    T.StructField("l_extendedprice", T.DoubleType()),
]))


def _lines(spark: SparkSession, d: str) -> Table:
    """A table in parts by flag, appended in four pieces."""
    t = Table(spark, f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}", _DAYS).create()
    lines = scan(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    quarter = lines.agg(F.max("l_orderkey")).first()[0] // 4 + 1
    for i in range(4):
        t.append(lines.where(F.col("l_orderkey").between(i * quarter, (i + 1) * quarter - 1)))
    return t


@query("SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice, true AS skipped FROM lineitem WHERE l_returnflag = 'R' AND (l_orderkey < 100 OR l_orderkey IN (5000, 5001))")
def pruned_read(spark: SparkSession, d: str) -> DataFrame:
    """A condition in SQL leaves out the files of other flags and of other stretches of orders."""
    where = "l_returnflag = 'R' AND (l_orderkey < 100 OR l_orderkey IN (5000, 5001))"
    t = _lines(spark, d)
    plan = t.scan_plan(where=where)
    return t.read(where=where).withColumn("skipped", F.lit(plan.files * 6 <= plan.total_files))


@query("SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS price, true AS apart, 0 AS again FROM lineitem GROUP BY l_returnflag")
def compaction_by_part(spark: SparkSession, d: str) -> DataFrame:
    """Small files of a part are put together, parts stay apart, and what is settled is not rewritten."""
    t = _lines(spark, d)
    t.compact()
    apart = all(f["bounds"]["l_returnflag"][0] == f["bounds"]["l_returnflag"][1] for f in t.snapshot().files)
    rows = t.read().groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))
    return rows.select("*", F.lit(apart).alias("apart"), F.lit(t.compact()).alias("again"))


# identifiers, log files, dictionaries, streams


@query("SELECT count(*) AS n, count(DISTINCT symbol || '/' || unix || '/' || xhash) AS ids FROM market_order")
def identifiers(spark: SparkSession, d: str) -> DataFrame:
    ids = spread(scan(spark, d, "market_order").select("symbol", "unix", "xhash")).select(ident.ident("Order", F.col("symbol"), F.col("unix"), F.col("xhash"), kinds=("string", "string", "long", "long")).alias("id"))
    return ids.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))


_WRITTEN = r"""SELECT unix // 1000 * 1000 AS unix, thread_name, driver_name, regexp_replace(regexp_replace(message, '^[ \t]+', ''), '\r\n', chr(10), 'g') AS message FROM log_lines"""


@query(_WRITTEN)
def log_files(spark: SparkSession, d: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/capture-{uuid.uuid4().hex}"
    logs.write_logs(scan(spark, d, "log_lines").select("unix", "thread_name", "driver_name", "message"), folder, "gzip")
    lines = logs.lines(spark, [folder])
    return logs.parsed(lines, message_layer=False).select("unix", "thread_name", "driver_name", "message")


_KNOWN = ", ".join(f"({tag}, '{name}', {'NULL' if about is None else chr(39) + about.replace(chr(39), chr(39) * 2) + chr(39)})" for _, tag, name, _, about, *_ in dictionary.builtin())


@query(f"""WITH d AS (SELECT * FROM (VALUES {_KNOWN}) AS v(tag, name, about)), q AS (SELECT * FROM (VALUES ('ordrqty'), ('px')) AS v(low)),
r AS (SELECT low, CAST(CASE WHEN CAST(tag AS VARCHAR) = low OR lower(name) = low THEN 0 WHEN starts_with(lower(name), low) THEN 1 WHEN contains(lower(name), low) THEN 2 WHEN contains(lower(coalesce(about, '')), low) THEN 3
  WHEN levenshtein(lower(name), low) <= 2 THEN 4 + levenshtein(lower(name), low) END AS INTEGER) AS rank, tag, name FROM d, q)
SELECT rank, tag, name FROM r WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY low ORDER BY rank, tag) <= 20""")
def dictionary_search(spark: SparkSession, d: str) -> DataFrame:
    known = dictionary.dictionary(spark)
    return dictionary.search(known, "OrdrQty").select("rank", "tag", "name").unionByName(dictionary.search(known, "px").select("rank", "tag", "name"))


@query("SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    from tidelog.streaming import ingest

    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    counts = ingest.windowed(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"])
    land = lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/out")
    counts.writeStream.outputMode("complete").foreachBatch(land).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").select(F.unix_micros("window.start").alias("start_us"), "event_type", "n")


@query("SELECT n_name, l_returnflag, count(*) AS n, round(sum(l_extendedprice), 1) AS price FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY CUBE (n_name, l_returnflag)")
def cube_of_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "lineitem").join(scan(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(scan(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.cube("n_name", "l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 1).alias("price"))


__all__ = ["QUERIES", "SQL", "settled"]
