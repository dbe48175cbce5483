"""Log line records against a line-by-line reader written for the test."""

import hashlib
import json
import re
from datetime import datetime, timezone

import pytest

from tidelog.operators import loglines
from tidelog.runtime import scan

LEVEL = {w: level for level, words in loglines.LEVELS.items() for w in words}
WORDS = "|".join(w for w in LEVEL if not w.isdigit())


def nanos(stamp):
    if isinstance(stamp, int):
        return stamp * 10 ** {13: 6, 19: 0}[len(str(stamp))]
    m = re.fullmatch(r"(\d+)-(\d+)-(\d+)[ T](\d+):(\d+):(\d+)(?:[.,](\d+)(?:[._,](\d+))?)?(Z|[+-]\d\d:\d\d)?", stamp)
    s = int(datetime(*map(int, m.groups()[:6]), tzinfo=timezone.utc).timestamp())
    if m[9] and m[9] != "Z":
        s -= (1 if m[9][0] == "+" else -1) * (int(m[9][1:3]) * 3600 + int(m[9][4:]) * 60)
    return s * 10**9 + int(((m[7] or "") + (m[8] or "")).ljust(9, "0"))


def read(lines):
    """(line_no, text) in order -> records."""
    out, cur = [], None
    for no, text in lines:
        t = (text or "").rstrip("\r")
        rec = None
        if m := re.match(rf"[ \t]?(\d{{4}}-\d\d-\d\d[ T][\d:]{{8}}[.,]\d{{3}}(?:[._,]?\d{{3}})?) \[(.*?)\] \[(.*?)\](?: \(({WORDS})\))?(?: (.*))?$", t, re.I):
            rec = [nanos(m[1]) if len(re.sub(r"\D", "", m[1])) else None, LEVEL.get((m[4] or "").upper(), ""), m[3], m[2], m[5] or ""]
        elif m := re.match(r"(\S+T\S+) +(\w+) +(\S+) +<(.*?)> -(?: (.*))?$", t):
            rec = [nanos(m[1]), LEVEL.get(m[2].upper(), ""), m[3], m[4], m[5] or ""]
        elif m := re.match(r"<(\d+)>1 (\S+) \S+ (\S+) (\S+) - -(?: (.*))?$", t):
            rec = [nanos(m[2]), LEVEL[str(int(m[1]) % 8)], m[3], m[4], m[5] or ""]
        elif t.startswith('{"'):
            j = json.loads(t)
            rec = [nanos(j["ts"]), LEVEL[j["level"].upper()], j["logger"], j["thread"], j["msg"]]
        elif m := re.match(r"([A-Z][a-z]{2} \d+, \d{4} [\d:]+ [AP]M) (\S+) \S+$", t):
            rec = [int(datetime.strptime(m[1] + " +0000", "%b %d, %Y %I:%M:%S %p %z").timestamp()) * 10**9, None, m[2], "", ""]
        elif t.startswith("time="):
            kv = dict(re.findall(r'(\w+)=("(?:[^"\\]|\\.)*"|\S*)', t))
            un = lambda v: json.loads(v) if v.startswith('"') else v
            rec = [nanos(un(kv["time"])), LEVEL.get(kv.get("level", "").upper(), ""), un(kv.get("component", "")), un(kv.get("thread", "")), un(kv.get("msg", ""))]
        if rec:
            cur = [no, no, *rec]
            out.append(cur)
        elif cur:
            cur[1] = no
            if cur[3] is None and (m := re.match(r"([A-Z]+): ?(.*)$", t)):
                cur[3], cur[6] = LEVEL[m[1]], m[2]
            else:
                cur[6] += "\n" + t
    return [(*r[:3], r[3] or "", r[4], r[5], r[6].strip()) for r in out]


@pytest.mark.parametrize("block", [7, 8192])
def test_against_a_plain_reader(spark, sf, block):
    rows = scan(spark, sf, "raw_lines")
    by = {}
    for r in sorted(rows.collect(), key=lambda r: (r.url, r.line_no)):
        by.setdefault(r.url, []).append((r.line_no, r.text))
    want = {(u, *x) for u, lines in by.items() for x in read(lines)}
    got = {(r.url, r.line_no, r.last_line_no, r.unix, r.level, r.driver_name, r.thread_name, r.message) for r in loglines.records(rows, block).collect()}
    assert got == want and len(got) > 50


def test_edges(spark):
    lines = [
        ("a", 1, "orphan"), ("a", 2, "2026-01-05 09:00:00.123 [t] [d] (Info) one\r"), ("a", 3, None), ("a", 4, "  two \r\r"),
        ("a", 5, "2026-01-05T09:00:00,123.456 [t] [d] (expected) x"), ("a", 6, "  2026-01-05 09:00:00.123 [t] [d] quoted"),
        ("b", 1, "Jan 05, 2026 12:00:00 AM a.b.C run"), ("b", 2, "SEVERE: boom"), ("b", 3, "more: of it"), ("b", 4, "Jan 05, 2026 12:00:01 PM a.b.C run"),
        ("c", 1, "<128>1 2026-01-05T01:00:00.5+02:00 - app - - - "), (None, 1, "x"), ("d", 1, '{"ts":"bad"}'), ("d", 2, '{"no":1}'),
        ("e", 1, 'time=2026-01-05T09:00:00.5Z msg="a \\"b\\" level=info \\\\n c" level=err thread='),
    ]
    got = {(r.url, r.line_no): r for r in loglines.records(spark.createDataFrame(lines, "url string, line_no long, text string")).collect()}
    a = got["a", 2]
    assert (a.last_line_no, a.level, a.message) == (4, "INFO", "one\n\n  two") and a.unix == 1767603600123000000
    assert got["a", 5].unix == 1767603600123456000 and got["a", 5].level == "" and got["a", 5].message == "(expected) x\n  2026-01-05 09:00:00.123 [t] [d] quoted"
    assert got["b", 1].level == "ERROR" and got["b", 1].message == "boom\nmore: of it" and got["b", 1].unix == 1767571200000000000
    assert got["b", 4].level == "" and got["b", 4].message == "" and got["b", 4].unix == 1767614401000000000
    assert got["c", 1].level == "FATAL" and got["c", 1].unix == 1767567600500000000 and got["c", 1].thread_name == ""
    assert got["d", 1].unix is None and got["d", 1].last_line_no == 2
    e = got["e", 1]
    assert (e.message, e.level, e.thread_name) == ('a "b" level=info \\n c', "ERROR", "")
    assert len(got) == 7
    empty = spark.createDataFrame([], "url string, line_no long, text string")
    assert loglines.records(empty).count() == 0


def test_md5_column(spark, sf):
    from tidelog.plans.problems import p3_found

    row = p3_found(spark, sf).first()
    assert re.fullmatch(r"[0-9a-f]{32}", row.message_md5) and hashlib.md5(b"").hexdigest()
