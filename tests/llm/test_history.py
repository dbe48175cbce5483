"""Repeats: the suffix segments against brute force, on tables and on made-up records."""

import itertools
import random
import re

import numpy as np
import pytest

from tidelog.llm import history as H
from tidelog.runtime import scan


def plain_form(t):
    t = re.sub(r"\^a|[\x00-\x20\x7f |;]+", " ", t.lower())
    return re.sub(" #", "#", re.sub(r" +", " ", t).strip(" "))


def plain_log(rows):
    """(row_id, hash, unix, driver, thread, message) -> repeats."""
    seen, groups, out = set(), {}, set()
    for rid, h, u, d, t, m in sorted(rows):
        if h is not None and u is not None:
            if (h, u) in seen:
                out.add(rid)
            seen.add((h, u))
        if None in (u, d, t, m):
            continue
        f = plain_form(m)
        group = groups.setdefault((d, t, u // 10**6), [])
        if any(H.same_line(o, f) for o in group):
            out.add(rid)
        group.append(f)
    return out


def found(spark, rows, **how):
    log = spark.createDataFrame(rows, "row_id long, hash long, unix long, driver_name string, thread_name string, message string")
    got = [r[0] for r in H.repeats(H.log_rows(log.selectExpr("cast(row_id div 700 as int) as batch_id", "*")), "line", together=1, **how).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_table(spark, sf):
    log = scan(spark, sf, "log_lines")
    rows = [tuple(r) for r in log.select("row_id", "hash", "unix", "driver_name", "thread_name", "message").collect()]
    got = [r[0] for r in H.repeats(H.log_rows(log), "line").collect()]
    assert set(got) == plain_log(rows) and got and len(got) == len(set(got))


def altered(rng, m):
    kind = rng.randint(0, 4)
    if kind == 0:
        return m.upper()
    if kind == 1:
        i = rng.choice([i for i, c in enumerate(m) if c.isalpha()])
        return m[:i] + "�" + m[i + 1 :]
    if kind == 2:
        return m[: rng.randint(int(len(m) * 0.8), len(m) - 1)]
    if kind == 3:
        return m.replace(" ", "  ") + " "
    return m.replace("|", "^A")


@pytest.mark.parametrize("block", [5, 20_000])
def test_one_hot_key(spark, block):
    """A third of all rows under one key, cut into blocks, and a group of exact copies."""
    rng = random.Random(5)
    lines = [f"crossed prices|seen on ticket T0-{i:05d}, audit trail kept under A{rng.randint(100, 999)}" for i in range(60)]
    messages = lines + [altered(rng, rng.choice(lines)) for _ in range(60)] + [lines[0]] * 60
    rng.shuffle(messages)
    rows = [(i, i, 5_000_000 + i % 7, "d", "t", m) for i, m in enumerate(messages)]
    rows += [(1000 + i, -i, i * 10**6, "d", "t", "alone") for i in range(300)]
    rows += [(2000, None, None, "d", "t", "x"), (2001, 1, 5_000_000, None, "t", lines[0]), (2002, 7, 7, "d", "t", None), (2003, 8, 8, "d", "t", ""), (2004, 9, 8, "d", "t", "")]
    assert found(spark, rows, block=block) == plain_log(rows)
    assert found(spark, []) == set()


def test_long_texts_and_ties(spark):
    long = " ".join(f"w{i}" for i in range(20000))
    rows = [(1, 1, 1, "d", "t", long), (2, 2, 2, "d", "t", long.upper()), (3, 3, 3, "d", "t", long.replace("w777 ", "w7�7 ")), (4, 4, 4, "d", "t", long + " 1"), (5, 5, 5, "d", "t", "a"), (6, 6, 6, "d", "t", "A ")]
    assert found(spark, rows) == {2, 3, 4, 6}


def test_segment_finds_longest():
    rng = np.random.default_rng(1)
    words = {}
    texts = [" ".join(rng.choice(list("abc"), rng.integers(1, 12))) for _ in range(60)]
    keys = rng.integers(0, 3, 60)
    t = H.Texts(keys, texts, words)
    s = H.Segment(t)
    suffixes = [(keys[s.record[i]], *t.words[s.at[i] : s.at[i] + s.rest[i]]) for i in s.suffixes]
    assert suffixes == sorted(suffixes)
    q = H.Texts(keys, ["a b c a", *texts[1:]], words)
    length, lo, hi = s.longest(q.key, q.start, q.length, q.words)
    for i in range(60):
        w = tuple(q.words[q.start[i] : q.start[i] + q.length[i]])
        best = max((k for k in range(len(w) + 1) if any(x[: k + 1] == (keys[i], *w[:k]) for x in suffixes)), default=0)
        assert best == length[i]
        if best:
            assert all(x[: best + 1] == (keys[i], *w[:best]) for x in suffixes[lo[i] : hi[i]])


def in_batches(spark, path, stream, size, merged):
    """What a history says of ``stream`` (key, message), so many at a time; the history may be opened anew for each."""
    got = set()
    for at in range(0, len(stream), size):
        history = H.History(spark, path, "line", block=40)
        rows = [(i, i, 1_000_000 * stream[i][0] + 400_000_000_000 * (stream[i][0] % 2), "d", "t", stream[i][1], 1) for i in range(at, min(at + size, len(stream)))]
        df = spark.createDataFrame(rows, "row_id long, hash long, unix long, driver_name string, thread_name string, message string, batch_id int")
        got |= {r[0] for r in history.add(H.log_rows(df)).collect()}
        if merged:
            history.merge(everything=len(history.list.head()["runs"]) > 2)
            history.list.vacuum()
    return got, H.History(spark, path, "line")


@pytest.mark.parametrize("merged", [False, True])
def test_batches_against_history(spark, tmp_path, merged):
    """Batch by batch, with segments merged on the way, as at once."""
    rng = random.Random(2)
    base = [f"limit check passed for account A{i:04d} headroom {i % 90} lots ticket T0-{i * 7:05d}" for i in range(120)]
    stream = [(rng.randint(0, 9), x) for x in base + [altered(rng, rng.choice(base)) for _ in range(150)]]
    rng.shuffle(stream)
    forms = [plain_form(m) for _, m in stream]
    got, history = in_batches(spark, f"{tmp_path}/history", stream, 60, merged)
    want = {j for i, j in itertools.combinations(range(len(stream)), 2) if stream[i][0] == stream[j][0] and H.same_line(forms[i], forms[j])}
    assert got == want
    assert len(history.list.head()["runs"]) == (1 if merged else 5)


def test_segments_merge_by_levels(spark, tmp_path):
    stream = [(i % 3, f"ticket T{i % 20}") for i in range(30)]
    history = H.History(spark, f"{tmp_path}/history", "line")
    for i, (k, m) in enumerate(stream):
        if i < 9:
            df = spark.createDataFrame([(1, i, i, k, "d", "t", m)], "batch_id int, row_id long, hash long, unix long, driver_name string, thread_name string, message string")
            assert history.add(H.log_rows(df)).count() == 0
            history.merge()
    levels = sorted(r["level"] for r in history.list.head()["runs"])
    assert levels == [0, 1] and len(history.list.vacuum()) == 8
    df = spark.createDataFrame([(1, 50, 50, 0, "d", "t", "TICKET  t0"), (1, 51, 0, 0, "x", "t", "y"), (1, 52, 52, 0, "d", "t", "ticket t99")], df.schema)
    assert {r[0] for r in history.add(H.log_rows(df)).collect()} == {50, 51}


def test_orders(spark, sf):
    orders = scan(spark, sf, "market_order")
    forms = {r.row_id: (r.key, r.form) for r in H.order_rows(orders).collect()}
    whole, copies = set(), set()
    for r in orders.select("row_id", "hash", "unix").orderBy("row_id").collect():
        if (r.hash, r.unix) in whole:
            copies.add(r.row_id)
        whole.add((r.hash, r.unix))
    seen, want = {}, set()
    for rid in sorted(forms):
        k, f = forms[rid]
        if any(H._same_row(o, f) for o in seen.get(k, [])):
            want.add(rid)
        seen.setdefault(k, []).append(f)
    assert {r[0] for r in H.repeats(H.order_rows(orders), "row").collect()} == want | copies and want and copies


def test_row_forms(spark):
    schema = "row_id long, batch_id int, runix long, hash long, xhash long, version long, unix long, px double, name string, tags map<string,string>, legs array<struct<a:double,b:string>>"
    row = lambda i, px, name, legs=None, tags=None: (i, 1, i, i, 1, 1, 1, px, name, tags, legs)
    rows = [
        row(1, 100.0, "V 1", [(1.0, "x")], {"a": "b", "c": "d"}), row(2, 100.00000001, "v1 ", [(1.0000000001, "X")], {"c": "d", "a": "b"}), row(3, 100.1, "V 1", [(1.0, "x")], {"a": "b", "c": "d"}),
        row(4, None, "V 1"), row(5, None, "v1"), row(6, 0.0, "v1"), row(7, None, None), row(8, None, ""), row(9, float("nan"), "q"),
    ]
    got = {r[0] for r in H.repeats(H.order_rows(spark.createDataFrame(rows, schema)), "row").collect()}
    assert got == {2, 5}


@pytest.mark.parametrize("a, b, same", [("", "", True), ("", "a", False), ("ab", "abcd", True), ("ab", "abcde", False), ("a�c", "abc", True), ("a1c", "a2c", False), ("a�cd", "axcde", True), ("���� x", "abcd x", False)])
def test_same_line(a, b, same):
    assert H.same_line(a, b) is same and H.same_line(b, a) is same


def ending_in_identifiers(rng, n):
    """Distinct lines of templates that end in their identifier, and damaged and cut ones of these."""
    tails = lambda: f"T0-{rng.randint(100000, 100000 + 2 * n)}"
    base = [rng.choice([f"throttle window opened at {rng.randint(700, 760)} quotes per second for feed {tails()}", f"clearing file accepted, {rng.randint(1, 20)} records, control number {tails()}", f"ok {tails()}"]) for _ in range(n)]
    out = [*base, "ab", "�b", "a�"]
    for _ in range(n):
        m = list(rng.choice(base))
        for _ in range(rng.choice([1, 1, 2, 3])):
            m[rng.randrange(len(m))] = "�"
        out.append("".join(m)[: rng.choice([len(m), rng.randint(len(m) // 2, len(m))])].strip())
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block", [25, 20_000])
def test_hot_key_of_templates(spark, block):
    """A partner hidden by rows that share more of the template with the damaged line than it does."""
    rows = [(i, i, 5_000_000, "d", "t", m) for i, m in enumerate(ending_in_identifiers(random.Random(3), 80))]
    assert found(spark, rows, block=block) == plain_log(rows)


def test_hot_key_in_batches(spark, tmp_path):
    stream = [(0, m) for m in ending_in_identifiers(random.Random(4), 100)]
    forms = [plain_form(m) for _, m in stream]
    got, _ = in_batches(spark, f"{tmp_path}/history", stream, 70, False)
    assert got == {j for i, j in itertools.combinations(range(len(forms)), 2) if H.same_line(forms[i], forms[j])}


def heavily_damaged(rng, n, fields):
    """Lines of one template, half of them handed in again with as many illegible characters as are allowed."""
    base = [" ".join(f"f{k} v{rng.randint(0, 9)}" for k in range(fields)) for _ in range(n)]
    out = list(base)
    for _ in range(n // 2):
        m = list(rng.choice(base))
        for i in rng.sample([i for i, c in enumerate(m) if c != " "], max(3, len(m) // 10)):
            m[i] = "�"
        out.append("".join(m))
    return out


def test_recall_under_heavy_damage(spark):
    """Up to a tenth of the characters lost, in templates that differ by single digits: every repeat is found."""
    rows = [(i, i, 5_000_000, "d", "t", m) for i, m in enumerate(heavily_damaged(random.Random(8), 200, 25))]
    want = plain_log(rows)
    assert found(spark, rows) == want and len(want) >= 100


def test_rows_looked_up():
    """Doubles that agree but are printed apart at four digits, among many rows of the same strings."""
    rng = random.Random(6)
    forms = [f"=v\x1f{a!r} {b} ~" for a, b in ((1.2345 * (1 + rng.choice([-1, 0, 1]) * 4e-7), rng.randint(1, 40)) for _ in range(150))] + ["=v\x1f~ ~ ~", "=v\x1fNaN 1 ~", "=v\x1fNaN 1.0000001 ~", "=v\x1f1.5"]
    rows = H.Rows(forms, list(range(len(forms))))
    got = {j for j, f in enumerate(forms) if any(H._same_row(forms[i], f) for i in rows.like(f, j))}
    assert got == {j for i, j in itertools.combinations(range(len(forms)), 2) if H._same_row(forms[i], forms[j])} and got


@pytest.mark.parametrize("a, same", [("feed t0-135157 ", True), ("feed t0-135157", True), ("feed t0-135157 op", True), ("feed t0-1351", False), ("feed ", False), ("feed t0-1�5157 o", False), ("feed t0-135157 �p", True), ("feed t0-135158 ", False)])
def test_ended_before_the_middle(spark, a, same):
    """A beginning counts whatever its share, if it holds an identifier or number that is whole."""
    b = "feed t0-135157 opened at 764 quotes per second by the throttle window"
    assert H.same_line(a, b) is same and H.same_line(b, a) is same
    rows = [(1, 1, 1, "d", "t", b), (2, 2, 2, "d", "t", a)]
    assert found(spark, rows) == plain_log(rows)
