import dataclasses
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import classify, codes, ident, tags
from tidelog.functions import values as V
from tidelog.operators import events as E
from tidelog.plans.jobs import Job, market_events
from tidelog.shapes import DoesNotFit, Shape, cast_onto, class_of, merged, shape_of
from tidelog.sources import dictionary, logs
from tidelog.sources.locations import Location
from tidelog.sources.store import Table


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "text, want",
    [("20260105-06:00:00.004", 1767592800004000000), ("20260105", 1767571200000000000), ("06:00:00", 21600000000000), ("20260105 06:00:60Z", 1767592860000000000), ("20260230", None), ("20260105-24:00:00", None), ("x", None), ("", None), (None, None), ("20260105T06:00:00.123456789", 1767592800123456789)],
)
def test_nanos(spark, text, want):
    assert one(spark, text, "string", V.nanos) == want


def test_readings(spark):
    assert [one(spark, x, "string", V.number) for x in ("1.5", "1e3", ".5", "1_0", "nan", "", None)] == [1.5, 1000.0, 0.5, None, None, None, None]
    assert [one(spark, x, "string", V.integer) for x in ("12", "-3", "1.0", None)] == [12, -3, None, None]
    assert [one(spark, x, "string", V.bool_words) for x in (" Ja", "NO", "maybe")] == [True, False, None]
    assert [one(spark, x, "string", V.flag) for x in ("Yes", "n", "1")] == [True, False, None]
    assert [one(spark, x, "string", V.month_year) for x in ("202603", "20260315", "2026")] == [date(2026, 3, 1), date(2026, 3, 15), None]
    assert [one(spark, x, "long", V.hour_of) for x in (-1, 0, V.HOUR + 5)] == [-V.HOUR, 0, V.HOUR]
    assert one(spark, 0.5, "double", lambda c: V.rendered(c, "double")) == "0.5" and one(spark, 1767592800004000000, "long", lambda c: V.rendered(c, "nanos")) == "20260105-06:00:00.004000"
    assert V.datatype("UTCTimestamp") == "nanos" and V.datatype("nothing") == "string"


def test_zones(spark):
    f = lambda z: lambda c: V.local_to_nanos(c, z)
    assert one(spark, "2026-03-29 02:30:00", "string", f("Europe/Berlin")) == 1774746000000000000  # left out: the change
    assert one(spark, "2026-10-25 02:30:00", "string", f("Europe/Berlin")) == 1792888200000000000  # told twice: the first
    assert one(spark, "2026-01-05 06:00:00", "string", f(None)) == 1767592800000000000


def test_codes(spark):
    assert codes.State.of_wire("2") == 410 and codes.Side.BUY.band == 100 and codes.State.of_code(415) == 400 and codes.State.of_code(9001) == 9001 and codes.Side.of_wire(None) == 0
    assert [one(spark, x, "int", codes.sign) for x in (100, 230, 310, None)] == [1, -1, 0, 0]
    assert [one(spark, x, "string", lambda c: codes.of_wire(codes.Side, c)) for x in ("1", "G", "g", None)] == [100, 120, 0, 0]


def test_identity(spark):
    assert ident.hash_bytes(b"abc") == 8696274497037089104
    assert ident.hash_of("AB", "C") != ident.hash_of("A", "BC") and ident.hash_of(None) != ident.hash_of("")
    df = spark.createDataFrame([("AB", 5, 2.5), (None, None, None)], "s string, n int, d double")
    got = [r.i for r in df.select(ident.ident("Order", F.col("s"), F.col("n"), F.col("d"), kinds=("string", "string", "long", "double")).alias("i")).collect()]
    assert got == [ident.hash_of("Order", "AB", 5, 2.5), ident.hash_of("Order", None, None, None)]


def pairs(spark, text, named=False):
    return [(p.key, p.value) for p in tags.parse(spark.createDataFrame([(text,)], "message string"), named=named).first().pairs or []]


def test_messages(spark):
    want = [("8", "FIX.4.4"), ("35", "D"), ("58", "a=b"), ("10", "085 << x")]
    for sep in ("|", "^A", "\x01", ";"):
        assert pairs(spark, "in: latency=5ms " + sep.join(["8=FIX.4.4", "35=D", "noise", "58= a=b ", "10=085 << x", "99=no"])) == want
    assert pairs(spark, None) == [] and pairs(spark, "") == [] and pairs(spark, "prose k=v") == []
    assert pairs(spark, "to #A=1|#NoPartyIDs[0]=PartyID=x\x01PartyRole=2|#NoPartyIDs[1].PartyID=y|junk|SIDE=1", True) == [("A", "1"), ("NoPartyIDs[0].PartyID", "x"), ("NoPartyIDs[0].PartyRole", "2"), ("NoPartyIDs[1].PartyID", "y"), ("SIDE", "1")]
    assert pairs(spark, "x #A=1#B=2", True) == [("A", "1"), ("B", "2")]


def test_lift_and_events(spark):
    rows = [(1, "8=FIX.4.4|35=8|11=c|17=e|150=F|39=1|31=5.5|32=2|38=10|58=n/a|54=1|10=1|"), (2, "8=FIX.4.4|35=W|55=S|268=2|269=0|270=9.5|271=3|269=2|270=9|271=1|10=1|"), (3, None), (4, "8=FIX.4.4|35=0|10=1"), (5, "8=FIX.4.4|35=D|38=1|38=2|11=q|10=1")]
    df = tags.parse(spark.createDataFrame(rows, "id long, message string"))
    got = {r.id: r for r in tags.lift(df).collect()}
    assert got[1].last_px == 5.5 and got[1].text is None and got[5].order_qty is None and [t.tag for t in got[5].fix_tags] == [38, 38] and got[3].fix_tags is None and got[4].fix_tags == []
    ev = sorted((r.id, r.pos, r.etype, r.px, r.qty, r.side, r.symbol) for r in E.events(df.select("id", tags.from_pairs("pairs").alias("pairs"))).collect())
    assert ev == [(1, 0, 110, None, 10.0, 100, ""), (1, 1, 210, 5.5, 2.0, 100, ""), (2, 0, 110, 9.5, 3.0, 100, "S"), (2, 2, 210, 9.0, 1.0, 0, "S"), (5, 0, 110, None, 1.0, 0, "")]


def test_groups(spark):
    df = tags.parse(spark.createDataFrame([("8=FIX.4.4|453=2|448=a|447=D|448=b|452=1|44=5|10=1",)], "message string"))
    r = df.select(tags.group(F.col("pairs"), 453, (448, 447, 452)).alias("g"), tags.value_of(F.col("pairs"), 44).alias("px"), tags.by_tag(F.col("pairs")).alias("m"), tags.to_text(F.col("pairs"), "|").alias("t")).first()
    assert [[(p.key, p.value) for p in e] for e in r.g] == [[("448", "a"), ("447", "D")], [("448", "b"), ("452", "1")]] and r.px == "5" and r.m["448"] == "a" and r.t.startswith("8=FIX.4.4|453=2|")


def test_rules(spark):
    assert one(spark, "35=8", "string", classify.event_type) == 210 and one(spark, None, "string", classify.event_type) == 0
    rules = (classify.ProtocolRule("X", "", "none", "^Wire"), classify.ProtocolRule("OTHER"))
    df = spark.createDataFrame([("m", "Wire_1"), ("m", None)], "m string, d string")
    assert [r[0] for r in df.select(classify.protocol(F.col("m"), F.col("d"), rules)).collect()] == ["X", "OTHER"]
    assert [r[0] for r in df.select(classify.protocol(F.col("m"), None, rules)).collect()] == ["OTHER", "OTHER"]


def test_casting(spark):
    df = spark.createDataFrame([(3_000_000_000, "x", {"a": "1"}, [1, 2])], "n long, s string, m map<string,string>, l array<int>")
    want = T.StructType([T.StructField("s", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("m", T.StructType([T.StructField("a", T.LongType(), False)])), T.StructField("l", T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])), T.StructField("z", T.DoubleType())])
    r = cast_onto(df, want).first()
    assert (r.s, r.n, r.m.a, r.l.x, r.l.y, r.z) == (None, -1294967296, 1, 1, "2", None)
    with pytest.raises(DoesNotFit, match="row.k"):
        cast_onto(df, T.StructType([T.StructField("k", T.LongType(), False)]))
    with pytest.raises(Exception, match="row.m.b"):
        cast_onto(df, T.StructType([T.StructField("m", T.StructType([T.StructField("b", T.LongType(), False)]))])).collect()
    with pytest.raises(DoesNotFit, match="row.l"):
        cast_onto(df, T.StructType([T.StructField("l", T.LongType())]))


def test_shapes(tmp_path):
    @dataclasses.dataclass
    class Leg:
        side: str
        size: int | None

    @dataclasses.dataclass
    class Quote:
        symbol: str = dataclasses.field(metadata={"primary_key": True})
        legs: list[Leg]
        tags: dict[str, str | None] | None

    Quote.__annotations__["legs"] = list[Leg]
    s = shape_of(Quote)
    assert s.primary_keys == ["symbol"] and s.leaf_names == ["symbol", "legs.element.side", "legs.element.size", "tags.key", "tags.value"]
    for name in ("q.yaml", "q.json"):
        s.write(tmp_path / name)
        assert Shape.read(tmp_path / name).schema == s.schema
    assert shape_of(class_of(s)).schema.simpleString() == s.schema.simpleString()
    wide = merged(s.schema, T.StructType([T.StructField("new", T.LongType(), False)]))
    assert wide["new"].nullable and wide.names[:3] == s.schema.names


CAPTURE = "orphan\r\n2026-01-05 06:00:00.123 [t1] [Wire] (INFO) in 8=FIX.4.4|35=D|11=x|38=5|55=S|10=1|\r\n2026-01-05T06:00:00,123_456 [t2] [App] failed\n\tat a.b\n\n2026-01-05 06:00:01.5 [no] [header]\n2026-01-05 06:00:02.000001 [t] [App] (ERROR) done"


def test_log_files(spark, tmp_path):
    for name in ("b10.log", "b9.log"):
        (tmp_path / name).write_bytes(CAPTURE.encode())
    (tmp_path / "skip.txt").write_text("x")
    assert [p.rsplit("/", 1)[1] for p in logs.walk([str(tmp_path)], "*.log")] == ["b9.log", "b10.log"]
    rows = logs.read_logs(spark, str(tmp_path), pattern="*.log", static={"desk": "d"}).orderBy("url", "pos").collect()
    assert len(rows) == 6 and [r.message for r in rows[:3]] == ["in 8=FIX.4.4|35=D|11=x|38=5|55=S|10=1|", "failed\n\tat a.b\n\n2026-01-05 06:00:01.5 [no] [header]", "done"]
    r = rows[0]
    assert (r.unix, rows[1].unix, rows[2].unix) == (1767592800123000000, 1767592800123456000, 1767592802000001000) and (r.etype, r.order_qty, r.symbol, r.desk) == (110, 5.0, "S", "d")
    assert r.hash == ident.hash_bytes(CAPTURE.split("\r\n")[1].encode())
    with pytest.raises(FileNotFoundError):
        logs.walk([str(tmp_path / "none")])
    with pytest.raises(ValueError):
        logs.read_logs(spark, str(tmp_path), static={"unix": 1})


def test_own_header_and_dirty_bytes(spark, tmp_path):
    (tmp_path / "own.log").write_bytes(b"before\nW|2026-01-05 06:00:00.123|gate|first \xff\xfe line\n  more\nE|2026-01-05 06:00:01.000||second\n")
    mine = logs.header_of(r"(?s)^[A-Z]\|([^|]*)\|([^|]*)\|(.*)\z", stamp=1, driver=2, message=3)
    rows = logs.read_logs(spark, str(tmp_path), header=mine).orderBy("pos").collect()
    assert [(r.unix, r.thread_name, r.driver_name, r.message) for r in rows] == [(1767592800123000000, "", "gate", "first \ufffd\ufffd line\n  more"), (1767592801000000000, "", "", "second")]
    for wrong in ({"stamp": 1}, {"stamp": 1, "message": 4}, {"stamp": 1, "message": 2, "other": 3}):
        with pytest.raises(ValueError):
            logs.header_of(r"(a)(b)(c)", **wrong)


def test_rendered_groups(spark):
    text = "to #A=1|#NoLegs[2].LegSymbol=z|#NoLegs[0]=LegSymbol=x\x01LegSide=2|#B=2"
    df = tags.parse(spark.createDataFrame([(text,), (None,)], "message string"), named=True)
    got = df.select(tags.indexed_group(F.col("pairs"), "NoLegs").alias("g")).collect()
    assert [[(p.key, p.value) for p in e] for e in got[0].g] == [[("LegSymbol", "x"), ("LegSide", "2")], [("LegSymbol", "z")]] and not got[1].g


@pytest.mark.parametrize("text", ["20260105-06:00:00.004", "20260105", "06:00", "06:00:00.5", "20260105 06:00:60Z", " 20260105T23:59 Z ", "20260230", "20260105-24:00:00", "20260105-06:60:00", "20260105x06:00:00", "2026010", "x", "", None, "20260105-06:00:00.", "20260105-06:00:00.1234567891", "\u0661:00"])
def test_one_stamp_as_a_column(spark, text):
    for day in (None, 1767592800004000000):
        assert one(spark, text, "string", lambda c: V.nanos(c, None if day is None else F.lit(day))) == V.nanos_of(text, day)


def test_jobs(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.log").write_bytes(CAPTURE.encode())
    job = Job.from_dict({"kind": "parse_logs", "source": str(src), "target": f"{tmp_path}/log", "unknown": 1})
    first, again = job.run(spark), job.run(spark)
    assert first.rows == 3 and first.written == {"all": 3} and again.written == {"all": 0} and again.skipped == 3
    split = Job.from_dict({"kind": "parse_logs", "source": str(src), "target": f"{tmp_path}/split", "split": True}).run(spark)
    assert split.written == {"0": 2, "110": 1}
    market = Job.from_dict({"kind": "parse_market", "source": str(src), "target": f"{tmp_path}/market"})
    assert market.run(spark).written == {"orders": 1, "executions": 0} and market.run(spark).written == {"orders": 0, "executions": 0}
    with pytest.raises(ValueError, match="parse_logs"):
        Job.from_dict({"kind": "none"})
    assert Table(spark, f"{tmp_path}/log").read(columns=["message"]).count() == 3


def test_streaming(spark, tmp_path):
    from tidelog import tables
    from tidelog.streaming import ingest

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.log").write_bytes(CAPTURE.encode())
    table = Table(spark, f"{tmp_path}/t", tables.LOG).create()
    for want in (3, 3):
        q = ingest.ingest(spark, str(src), table, f"{tmp_path}/state")
        q.awaitTermination()
        assert table.records() == want


def test_dictionary(spark):
    xml = "<fix type='FIX' major='4' minor='4'><header><field name='MsgType' required='Y'/></header><trailer/><fields><field number='35' name='MsgType' type='STRING'><value enum='D' description='NEW'/></field><field number='44' name='Price' type='PRICE'/></fields></fix>"
    d = dictionary.dictionary(spark, dictionary.from_xml(xml))
    assert dictionary.lookup(d, "msgtype").first().symbols == {"D": "NEW"} and dictionary.lookup(d, 44).first().name == "Price"
    assert [r.name for r in dictionary.search(d, "pricf").collect()] == ["Price"] and dictionary.search(d, "35").first()["rank"] == 0


def test_locations():
    s = Location.parse("s3://key:se:cret@bucket/a/b%20c?region=eu")
    assert (s.bucket, s.key, s.user, s.secret, s.region) == ("bucket", "a/b c", "key", "se:cret", "eu") and "cret" not in repr(s)
    assert s.join("d").uri() == "s3a://bucket/a/b%20c/d" and s.parent.key == "a" and Location.parse("C:\\x\\y").path == "C:/x/y"
    assert Location.parse("https://name.s3.eu-west-1.amazonaws.com/k").bucket == "name" and s.hadoop()["fs.s3a.bucket.bucket.access.key"] == "key"


def test_alternative_identifiers(spark):
    """All entries of group 454, by the scheme's name; those of a market-data entry are its own."""
    two = "454=2|455=US0378331005|456=4|455=037833100|456=1|"
    rows = [
        (1, f"8=FIX.4.4|35=D|11=a|55=S|48=X.Y|22=5|{two}54=1|10=1"), (2, "8=FIX.4.4|35=D|11=b|454=3|455=A|456=8|455=B|456=8|455=C|456=Z|10=1"), (3, "8=FIX.4.4|35=D|11=c|48=DE0001|22=4|10=1"), (4, "8=FIX.4.4|35=D|11=d|454=1|455=A|456=4|455=B|456=1|10=1"),
        (5, f"8=FIX.4.4|35=W|55=S|{two}268=2|269=0|270=9|269=1|270=10|10=1"), (6, f"8=FIX.4.4|35=X|268=2|279=0|269=0|55=S|{two}270=9|279=0|269=1|55=T|454=1|455=T1|456=2|270=10|10=1"),
    ]
    df = tags.parse(spark.createDataFrame(rows, "id long, message string"))
    got = {(r.id, r.pos): (r.instrument.alt_ids, r.instrument.isin_code, r.px) for r in E.events(df.select("id", tags.from_pairs("pairs").alias("pairs"))).collect()}
    both = {"ISIN": "US0378331005", "CUSIP": "037833100"}
    assert got == {
        (1, 0): (both, "US0378331005", None), (2, 0): ({"EXCHANGE": "A", "Z": "C"}, None, None), (3, 0): (None, "DE0001", None), (4, 0): ({"ISIN": "A"}, "A", None),
        (5, 0): (both, "US0378331005", 9.0), (5, 2): (both, "US0378331005", 10.0), (6, 0): (both, "US0378331005", 9.0), (6, 2): ({"SEDOL": "T1"}, None, 10.0),
    }
    named = [("11", "e"), ("NoSecurityAltID[1].SecurityAltID", "B"), ("NoSecurityAltID[1].SecurityAltIDSource", "1"), ("NoSecurityAltID[0].SecurityAltID", "A"), ("NoSecurityAltID[0].SecurityAltIDSource", "4")]
    assert list(E.alternatives(named).items()) == [("ISIN", "A"), ("CUSIP", "B")]


def test_instrument_identities(spark):
    """Registered identifier, ISIN, exchange and symbol, nothing: in this order."""
    said = {
        "own": ("48=AAPL.O|22=5|55=S|207=X", ("id", "5", "AAPL.O")), "other": ("48=MSFT.O|22=5", ("id", "5", "MSFT.O")), "is": ("48=US1|22=4|55=S", ("id", "4", "US1")), "alt": ("55=S|454=2|455=C|456=1|455=US1|456=4", ("id", "4", "US1")),
        "bare": ("48=AAPL.O|55=S|207=X", ("symbol", "X", "S")), "symbol": ("55=S", ("symbol", "", "S")), "none": ("22=4", None),
    }
    df = spark.createDataFrame([(f"8=FIX.4.4|35=D|11={k}|{m}|54=1|38=1|10=1",) for k, (m, _) in said.items()], "message string")
    got = {r.client_order_id: r.instrument_hash for r in market_events(df).collect()}
    assert got == {k: ident.hash_of(*key) if key else 0 for k, (_, key) in said.items()}
