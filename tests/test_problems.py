"""Keyed totals, delivered messages, hierarchies and late figures against plain Python, with skew, nulls, ties and empty tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tidelog.operators import delivered as D
from tidelog.operators import hierarchy as H
from tidelog.operators import keyed as K
from tidelog.operators import late as L
from tidelog.sources.store import Conflict


def test_keyed_totals(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None, ""]), rng.choice([None, 1.0, 2.5]), "x") for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double, n string").repartition(5)
    got = {r.k: (r.n, r.v_sum, r.v_known) for r in K.keyed_totals(df, "k", ["v"]).collect()}
    want = {}
    for k, v, _ in rows:
        n, s, c = want.get(k, (0, None, 0))
        want[k] = (n + 1, s if v is None else (s or 0) + v, c + (v is not None))
    assert got == want
    assert {r.k for r in K.heavy_keys(df, "k", 40).collect()} == {"hot"}
    none = df.limit(0)
    assert K.keyed_totals(none, "k", ["v"]).count() == 0 == K.heavy_keys(none, "k").count()
    assert {r.v for r in K.keyed_totals(df, "v").select("v").collect()} == {None, 1.0, 2.5}


def test_more_keys_than_a_block(spark):
    df = spark.range(K.BLOCK * 2 + 5).selectExpr("id % 9000 as k")
    assert K.keyed_totals(df, "k").agg(F.sum("n"), F.count("*")).first()[:] == (K.BLOCK * 2 + 5, min(9000, K.BLOCK * 2 + 5))


def messages(rows):
    """Copies by union-find."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    resent = {(s.strip().upper(), t, m, c, e) for _, _, s, t, q, m, c, e, u, o, r in rows if r and q is not None and None not in (s, t, c)}
    for rid, _, s, t, q, m, c, e, u, o, r in rows:
        if q is None:
            continue
        at = o if o is not None else u
        keys = []
        if None not in (s, t, at):
            keys.append((s.strip().upper(), t, q, at // 86_400_000_000_000))
        if None not in (s, t) and (s.strip().upper(), t, m, c, e) in resent:
            keys.append((s.strip().upper(), t, m, c, e, "resent"))
        for k in keys:
            parent[root(k)] = root(("row", rid))
    groups = {}
    for row in rows:
        if row[4] is not None:
            groups.setdefault(root(("row", row[0])), []).append(row[0])
    return {x for g in groups.values() for x in sorted(g)[1:]}


MESSAGE = "row_id long, batch_id int, sender_comp_id string, target_comp_id string, seq long, msg_type string, cl_ord_id string, exec_id string, sending_unix long, orig_sending_unix long, poss_resend boolean"


@pytest.mark.parametrize("seed", [1, 2])
def test_message_copies(spark, seed):
    rng = random.Random(seed)
    day = 86_400_000_000_000
    rows = []
    for i in range(600):
        hot = rng.random() < 0.35
        s, seq = ("HOT", 1) if hot else (rng.choice(["A", " a", "B", None]), rng.choice([None, *range(60)]))
        rows.append((i, i // 50, s, rng.choice(["T", "U"]) if not hot else "T", seq, rng.choice(["D", "8"]), rng.choice([None, *"pqrstuvw"]), rng.choice([None, "x"]), rng.choice([5, day + 5, None]) if not hot else 7, rng.choice([None, None, 6]), rng.random() < 0.05))
    df = spark.createDataFrame(rows, MESSAGE)
    assert {r[0] for r in D.message_copies(df).collect()} == messages(rows)
    assert D.message_copies(df.limit(0)).count() == 0


def test_runs():
    """Batches against sorted runs, merged on the way, as against a dictionary."""
    rng = np.random.default_rng(3)
    runs, seen = [], {}
    for at in range(0, 3000, 100):
        hi, lo = rng.integers(-5, 5, 100), rng.integers(0, 40, 100)
        ours = D.Runs.run(hi, lo, np.arange(at, at + 100))
        rep, known = D.Runs(runs).look_up(ours)
        before = dict(seen)
        for h, l, r in zip(hi.tolist(), lo.tolist(), range(at, at + 100)):
            seen.setdefault((h, l), r)
        ids = list(zip(ours["hi"].tolist(), ours["lo"].tolist()))
        assert len(set(ids)) == len(ids) and [seen[x] for x in ids] == rep.tolist() and [x in before for x in ids] == known.tolist()
        runs.append(ours[~known])
        if len(runs) > 4:
            runs = [D.Runs.merged(runs)]
    assert sum(map(len, runs)) == len(seen)


def _batch(spark, *xs):
    return spark.createDataFrame([(h, h, r, "m") for h, r in xs], "hi long, lo long, row_id long, text string")


def _kept(df):
    return sorted(r.row_id for r in df.collect())


def test_index_of_delivered(spark, tmp_path):
    index = D.DeliveredIndex(spark, f"{tmp_path}/index")
    assert _kept(index.accept(_batch(spark, (1, 1), (1, 2), (-9, 3), (None, 4)))) == [1, 3, 4]
    assert _kept(index.accept(_batch(spark, (1, 5), (2, 6), (None, 7)))) == [6, 7]
    assert index.merge(everything=True) and not index.merge()
    assert len(index.list.vacuum()) == 2
    assert _kept(D.DeliveredIndex(spark, f"{tmp_path}/index").accept(_batch(spark, (2, 8), (-9, 9), (5, 10)))) == [10]
    assert index.accept(_batch(spark)).count() == 0


@pytest.mark.parametrize("many", [D.MANY_PREFIXES, 1])
def test_index_of_many_batches(spark, tmp_path, monkeypatch, many):
    """Levels merge, blocks are cut anew as they grow, and only the prefixes a batch touches are read."""
    monkeypatch.setattr(D, "BLOCK_IDS", 8)
    monkeypatch.setattr(D, "MANY_PREFIXES", many)
    rng = random.Random(4)
    index, seen, at = D.DeliveredIndex(spark, f"{tmp_path}/index", bits=1), set(), 0
    for _ in range(10):
        ids = [rng.randint(-(2**63), 2**63 - 1) if rng.random() < 0.6 or not seen else rng.choice(sorted(seen)) for _ in range(40)]
        ids += ids[:5]
        want = []
        for i, x in enumerate(ids):
            if x not in seen:
                want.append(at + i)
            seen.add(x)
        assert _kept(index.accept(_batch(spark, *[(x, at + i) for i, x in enumerate(ids)]))) == want
        at += len(ids)
        while index.merge():
            pass
    head = index.list.head()
    assert head["bits"] > 1 and len(head["runs"]) < 10 and len(index.list.vacuum()) >= 8


def test_index_survives_a_lost_merge(spark, tmp_path, monkeypatch):
    index = D.DeliveredIndex(spark, f"{tmp_path}/index")
    for i in range(3):
        index.accept(_batch(spark, (i, i), (10 + i, 10 + i)))
    before = index.list.head()
    with monkeypatch.context() as broken:
        broken.setattr(D, "_RUN_ARROW", pa.schema([("other", pa.int64())]))  # the tasks that merge fail
        with pytest.raises(PythonException):
            index.merge(everything=True)
    with monkeypatch.context() as broken:
        broken.setattr(index.list, "publish", lambda *a, **k: 1 / 0)  # the driver is lost when all is written
        with pytest.raises(ZeroDivisionError):
            index.merge(everything=True)
    assert index.list.head() == before
    assert _kept(index.accept(_batch(spark, (0, 20), (12, 21), (13, 22)))) == [22]
    with pytest.raises(Conflict):  # another has written a version meanwhile
        index.list.publish(before, runs=[])


def plain_tree(links):
    out = {}
    for n in links:
        way, x = [n], n
        while links.get(x) is not None and links[x] in links and links[x] not in way:
            x = links[x]
            way.append(x)
        nxt = links.get(x)
        if nxt is not None and nxt in links:
            ring = way[way.index(nxt) :]
            out[n] = (None, None, min(ring))
        else:
            out[n] = (way[-1], len(way) - 1, None)
    return out


@pytest.mark.parametrize("task_nodes, shape", [(10**6, "mixed"), (40, "mixed"), (40, "chain"), (25, "wide"), (30, "ring")])
def test_depths(spark, task_nodes, shape):
    rng = random.Random(7)
    ids = rng.sample(range(-1000, 1000), 200)
    if shape == "chain":
        links = {a: b for a, b in zip(ids, [None, *ids])}
    elif shape == "wide":
        links = {i: (None if i == ids[0] else ids[0] if rng.random() < 0.7 else rng.choice(ids[:20])) for i in ids}
    elif shape == "ring":
        links = {a: b for a, b in zip(ids, [ids[-1], *ids])}
    else:
        links = {i: rng.choice([None, 5000, i, *rng.choices(ids, k=6)]) for i in ids}
    df = spark.createDataFrame([(n, p, rng.randint(0, 9)) for n, p in links.items()] + [(None, 3, 1)], "node long, parent long, place long")
    got = {r.node: (r.root, r.depth, r.ring) for r in H.depths(df, rng.choice([None, "place"]), task_nodes).collect()}
    assert got == plain_tree(links)


def test_ancestry_and_paths(spark):
    links = {1: None, 2: 1, 3: 2, 4: 3, 5: 4, 6: 3, 7: 8, 8: 7, 9: 7}
    df = spark.createDataFrame(list(links.items()), "node long, parent long")
    solved = H.depths(df)
    pairs = H.ancestry(df, solved)
    got = {(r.node, r.ancestor): r.distance for r in pairs.collect()}
    want, x = {}, None
    for n in range(1, 7):
        x, d = links[n], 1
        while x:
            want[n, x] = d
            x, d = links[x], d + 1
    assert got == want
    assert {r.node: r.path for r in H.paths(pairs, solved).collect()} == {1: [1], 2: [1, 2], 3: [1, 2, 3], 4: [1, 2, 3, 4], 5: [1, 2, 3, 4, 5], 6: [1, 2, 3, 6]}
    assert H.depths(df.limit(0)).count() == 0


def test_order_links(spark):
    rows = [(1, 9, None, None, 5), (2, 9, 3, None, 5), (3, 8, 0, [0, None, 4, 5], 5), (4, 7, None, [], 5), (5, None, 1, None, 5), (6, 6, None, [0], None)]
    df = spark.createDataFrame(rows, "row_id long, hash long, prev_hash long, parent_hash array<long>, xhash long")
    assert {(r.node, r.parent) for r in H.order_links(df).collect()} == {(9, None), (8, 4), (7, None), (6, None)}


def test_late(spark):
    h = L.HOUR
    rows = [(1, 5, 10, None), (2, 5, h, None), (3, 5, 3 * h - 1, None), (4, 5, 3 * h, None), (5, 5, h + 1, h + 1), (6, 5, h + 1, h + 2), (7, -1, 0, None), (8, None, 5, None), (9, 2 * h, 1, None), (2, 5, h, None)]
    df = spark.createDataFrame(rows, "row_id long, unix long, runix long, eunix long").withColumn("value", F.lit(1.0))
    fate = sorted((r.row_id, r.fate) for r in L.placed(df).where("fate is not null").collect())
    assert fate == [(1, "on_time"), (2, "corrects"), (2, "corrects"), (3, "corrects"), (4, "dropped"), (5, "dropped"), (6, "corrects"), (7, "corrects"), (9, "on_time")]
    got = sorted((r.event_period, r.arrival_period, r.revision, r.n, r.value) for r in L.revisions(df).collect())
    assert got == [(-h, 0, 0, 1, 1.0), (0, 0, 0, 1, 1.0), (0, h, 1, 4, 4.0), (0, 2 * h, 2, 5, 5.0), (2 * h, 2 * h, 0, 1, 1.0)]
    assert L.revisions(df.limit(0)).count() == 0
