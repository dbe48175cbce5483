"""Queries of the general data-processing problems, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import delivered, hierarchy, keyed, late, loglines, multivalue
from tidelog.runtime import scan, settled

SKEWED = ("book_side", "market_order")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [keyed.heavy_keys(scan(spark, d, t), "symbol").select(F.lit(t).alias("tbl"), "symbol") for t in SKEWED]
    return parts[0].union(parts[1])


def p1_totals(spark: SparkSession, d: str) -> DataFrame:
    parts = [keyed.keyed_totals(scan(spark, d, t), "symbol", ["qty", "notional"]).withColumn("tbl", F.lit(t)) for t in SKEWED]
    out = parts[0].unionByName(parts[1])
    return out.select("tbl", "symbol", "n", F.round("qty_sum", 2).alias("qty_sum"), "qty_known", F.round("notional_sum", 1).alias("notional_sum"), "notional_known")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    out = loglines.records(scan(spark, d, "raw_lines"))
    return out.withColumn("message_md5", F.md5(F.col("message").cast("binary"))).drop("message")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return delivered.message_copies(scan(spark, d, "log_lines"))


def _tree(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    links = settled(hierarchy.order_links(scan(spark, d, "market_order")), "links")
    return links, hierarchy.depths(links, "place")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    solved = _tree(spark, d)[1]
    return solved.select(F.col("node").alias("hash"), F.coalesce("ring", "root").alias("root_hash"), F.coalesce("depth", F.lit(-1)).cast("int").alias("depth"))


def p5_descendants(spark: SparkSession, d: str) -> DataFrame:
    links, solved = _tree(spark, d)
    return hierarchy.ancestry(links, settled(solved, "solved")).select(F.col("ancestor").alias("hash"), F.col("node").alias("descendant"), "distance")


def p5_paths(spark: SparkSession, d: str) -> DataFrame:
    links, solved = _tree(spark, d)
    solved = settled(solved, "solved")
    return hierarchy.paths(hierarchy.ancestry(links, solved), solved).select(F.col("node").alias("hash"), F.array_join(F.col("path").cast("array<string>"), "/").alias("path"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return late.placed(scan(spark, d, "log_lines").select("row_id", "unix", "runix", "eunix")).where("fate in ('corrects', 'dropped')").select("row_id", "fate")


def p6_revisions(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "log_lines").select("unix", "runix", "eunix", F.col("order_qty").alias("value"))
    return late.revisions(rows).withColumn("value", F.round("value", 2)).withColumn("revision", F.col("revision").cast("long"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    fields = multivalue.packed_fields(scan(spark, d, "log_lines"))
    return multivalue.unpacked(fields, multivalue.quoted_values(fields))


QUERIES = {f.__name__: f for f in (p1_found, p1_totals, p3_found, p4_found, p5_found, p5_descendants, p5_paths, p6_found, p6_revisions, p7_found)}

_LINKS = """links AS (
  SELECT hash AS node, arg_min(struct_pack(p := coalesce(nullif(prev_hash, 0), list_filter(parent_hash, lambda x: x IS NOT NULL AND x <> 0)[1])), row_id).p AS up
  FROM market_order WHERE hash IS NOT NULL GROUP BY hash),
known AS (SELECT l.node, p.node AS up FROM links l LEFT JOIN links p ON l.up = p.node)"""

#: A quotation, in SQL.
_QUOTED = '"(?:[^"]|"")*"|' + "''(?:[^'']|'''')*''"

SQL = {
    "p1_found": """
SELECT 'book_side' AS tbl, symbol FROM book_side WHERE symbol IS NOT NULL GROUP BY symbol HAVING count(*) * 100 >= 3 * (SELECT count(*) FROM book_side)
UNION ALL
SELECT 'market_order' AS tbl, symbol FROM market_order WHERE symbol IS NOT NULL GROUP BY symbol HAVING count(*) * 100 >= 3 * (SELECT count(*) FROM market_order)""",
    "p1_totals": """
SELECT tbl, symbol, count(*) AS n, round(sum(qty), 2) AS qty_sum, count(qty) AS qty_known, round(sum(notional), 1) AS notional_sum, count(notional) AS notional_known
FROM (SELECT 'book_side' AS tbl, symbol, qty, notional FROM book_side UNION ALL SELECT 'market_order' AS tbl, symbol, qty, notional FROM market_order) GROUP BY tbl, symbol""",
    "p4_found": """
WITH RECURSIVE m AS (
  SELECT row_id, upper(trim(sender_comp_id)) AS s, target_comp_id AS t, seq, msg_type, cl_ord_id, exec_id, poss_resend,
         CAST(floor(coalesce(orig_sending_unix, sending_unix) / 86400000000000) AS BIGINT) AS d
  FROM log_lines WHERE seq IS NOT NULL),
r AS (SELECT *, CASE WHEN s IS NULL OR t IS NULL OR d IS NULL THEN row_id ELSE min(row_id) OVER (PARTITION BY s, t, seq, d) END AS rep FROM m),
resent AS (SELECT DISTINCT s, t, msg_type, cl_ord_id, exec_id FROM m WHERE poss_resend AND cl_ord_id IS NOT NULL AND s IS NOT NULL AND t IS NOT NULL),
edges AS (SELECT DISTINCT r.rep, row(x.s, x.t, x.msg_type, x.cl_ord_id, x.exec_id) AS link FROM r JOIN resent x
  ON r.s = x.s AND r.t = x.t AND r.msg_type IS NOT DISTINCT FROM x.msg_type AND r.cl_ord_id = x.cl_ord_id AND r.exec_id IS NOT DISTINCT FROM x.exec_id),
hops AS (SELECT DISTINCT a.rep AS x, b.rep AS y FROM edges a JOIN edges b ON a.link = b.link),
reach AS (SELECT x, y FROM hops UNION SELECT reach.x, hops.y FROM reach JOIN hops ON reach.y = hops.x),
label AS (SELECT x AS rep, min(y) AS first FROM reach GROUP BY x)
SELECT r.row_id FROM r LEFT JOIN label ON r.rep = label.rep WHERE r.row_id <> coalesce(label.first, r.rep)""",
    "p5_found": f"""
WITH RECURSIVE {_LINKS},
down AS (SELECT node, node AS root, 0 AS depth FROM known WHERE up IS NULL UNION ALL SELECT k.node, d.root, d.depth + 1 FROM down d JOIN known k ON k.up = d.node),
lost AS (SELECT k.node, k.up FROM known k LEFT JOIN down d ON k.node = d.node WHERE d.node IS NULL),
above AS (SELECT node, up AS a FROM lost UNION SELECT above.node, l.up FROM above JOIN lost l ON above.a = l.node),
rings AS (SELECT DISTINCT node FROM above WHERE node = a)
SELECT node AS hash, root AS root_hash, depth FROM down
UNION ALL
SELECT above.node, min(above.a), -1 FROM above JOIN rings ON above.a = rings.node GROUP BY above.node""",
    "p5_descendants": f"""
WITH RECURSIVE {_LINKS},
down AS (SELECT node FROM known WHERE up IS NULL UNION ALL SELECT k.node FROM down d JOIN known k ON k.up = d.node),
pairs AS (SELECT k.node, k.up AS a, CAST(1 AS BIGINT) AS distance FROM known k JOIN down USING (node) WHERE k.up IS NOT NULL
  UNION ALL SELECT p.node, k.up, p.distance + 1 FROM pairs p JOIN known k ON p.a = k.node WHERE k.up IS NOT NULL)
SELECT a AS hash, node AS descendant, distance FROM pairs""",
    "p5_paths": f"""
WITH RECURSIVE {_LINKS},
down AS (SELECT node, CAST(node AS VARCHAR) AS path FROM known WHERE up IS NULL
  UNION ALL SELECT k.node, d.path || '/' || CAST(k.node AS VARCHAR) FROM down d JOIN known k ON k.up = d.node)
SELECT node AS hash, path FROM down""",
    "p6_found": """
SELECT row_id, CASE WHEN runix >= e + 7200000000000 OR coalesce(runix >= eunix, false) THEN 'dropped' ELSE 'corrects' END AS fate
FROM (SELECT *, unix - ((unix % 3600000000000) + 3600000000000) % 3600000000000 + 3600000000000 AS e FROM log_lines) WHERE runix >= e""",
    "p7_found": rf"""
WITH f AS (
  SELECT row_id, 'fix_tags' AS field, CAST(i - 1 AS INTEGER) AS item_no, 0 AS part, t.value AS text FROM (SELECT row_id, unnest(fix_tags) AS t, generate_subscripts(fix_tags, 1) AS i FROM log_lines) WHERE t.tag IN (18, 276, 277)
  UNION ALL SELECT row_id, 'keyval', CAST(i - 1 AS INTEGER), 0, t.value FROM (SELECT row_id, unnest(keyval) AS t, generate_subscripts(keyval, 1) AS i FROM log_lines) WHERE upper(t.key) LIKE '%LIST'
  UNION ALL SELECT row_id, 'message', 0, part, text FROM (SELECT row_id, unnest(l) AS text, generate_subscripts(l, 1) AS part FROM (SELECT row_id, regexp_extract_all(message, '\{{((?:[^}}"'']|{_QUOTED})*)\}}', 1) AS l FROM log_lines))),
g AS (SELECT row_id, field, item_no, part, regexp_replace(text, '^\s+|\s+$', '', 'g') AS body FROM f WHERE regexp_matches(text, '\S')),
t AS (SELECT row_id, field, item_no, part, unnest(l) AS tok, generate_subscripts(l, 1) AS k FROM (SELECT *, regexp_extract_all(body, '(?s){_QUOTED}|[\pL\pN._:\-]+|\s*\|\|\s*|\s*[^\pL\pN._:\-\s"'']\s*|\s+|.') AS l FROM g)),
c AS (SELECT *, regexp_full_match(tok, '(?s){_QUOTED}|[\pL\pN._:\-]+') AS is_value FROM t),
b AS (SELECT *, lag(is_value) OVER (PARTITION BY row_id, field, item_no, part ORDER BY k) AS was FROM c),
s AS (SELECT *, sum(CASE WHEN NOT is_value OR (was AND is_value) THEN 1 ELSE 0 END) OVER (PARTITION BY row_id, field, item_no, part ORDER BY k) AS slot FROM b),
v AS (SELECT row_id, field, item_no, part, slot, max(tok) FILTER (is_value) AS tok FROM (SELECT row_id, field, item_no, part, slot, tok, is_value FROM s UNION ALL SELECT row_id, field, item_no, part, 0, NULL, false FROM g) GROUP BY ALL)
SELECT row_id, field, item_no, CAST(row_number() OVER (PARTITION BY row_id, field, item_no ORDER BY part, slot) - 1 AS INTEGER) AS pos,
  CASE left(tok, 1) WHEN '"' THEN replace(substr(tok, 2, length(tok) - 2), '""', '"') WHEN '''' THEN replace(substr(tok, 2, length(tok) - 2), '''''', '''') ELSE coalesce(tok, '') END AS value
FROM v""",
    "p6_revisions": """
WITH p AS (SELECT unix - ((unix % 3600000000000) + 3600000000000) % 3600000000000 AS h, runix - ((runix % 3600000000000) + 3600000000000) % 3600000000000 AS a, unix, runix, eunix, order_qty AS value FROM log_lines),
k AS (SELECT h AS event_period, greatest(a, h) AS arrival_period, value FROM p
  WHERE runix < h + 3600000000000 OR NOT (runix >= h + 10800000000000 OR coalesce(runix >= eunix, false))),
c AS (SELECT event_period, arrival_period, count(*) AS n, count(value) AS n_value, sum(value) AS value FROM k GROUP BY ALL)
SELECT event_period, arrival_period, row_number() OVER w - 1 AS revision,
  CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(n_value) OVER w AS BIGINT) AS n_value, round(sum(value) OVER w, 2) AS value
FROM c WINDOW w AS (PARTITION BY event_period ORDER BY arrival_period)""",
}
