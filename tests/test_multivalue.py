"""Packed fields: the count that messages state, a plain scanner, and edges."""

import random
import re

import pytest

from tidelog.operators import multivalue as m
from tidelog.runtime import scan


def plain(text):
    """Scans once from left to right."""
    text = (text or "").strip()
    if not text:
        return []
    out, cur, i, had = [], "", 0, False
    tokens = re.findall(r"\s*\|\|\s*|\s*[^\w.:\-\s\"']\s*|\s+|\"(?:[^\"]|\"\")*\"|'(?:[^']|'')*'|[\w.:\-]+|.", text)
    for t in tokens:
        if t[0] in "\"'" and len(t) > 1:
            cur = t[1:-1].replace(t[0] * 2, t[0])
        elif re.fullmatch(r"[\w.:\-]+", t):
            cur = t
        else:
            out.append(cur)
            cur = ""
    return [*out, cur]


@pytest.mark.parametrize("known", [(), ('"late, but firm"', "'half | half'", "PEG:MID")])
def test_stated_counts(spark, sf, known):
    log = scan(spark, sf, "log_lines")
    got = {}
    for r in m.unpacked(m.packed_fields(log), known).collect():
        got.setdefault((r.row_id, r.field, r.item_no), []).append((r.pos, r.value))
    fields = m.packed_fields(log).collect()
    assert len(fields) > 50
    for f in fields:
        vs = [v for _, v in sorted(got.get((f.row_id, f.field, f.item_no), []))]
        if f.field == "message":
            (inside,) = m.braces(f.text)
            assert int(re.search(r"\[(\d+)\] ?\{", f.text)[1]) == len(vs)
            assert vs == plain(inside)
        else:
            assert vs == plain(f.text)


def test_random_fields():
    rng = random.Random(3)
    values = ["A", "B_1", "PEG:MID", '"x, y"', "'half | half'", '"no ""best"" price"', "", "7.5", '""']
    s = m.Segmenter(['"x, y"', "'half | half'", "A"])
    for _ in range(500):
        vs = [rng.choice(values) for _ in range(rng.randint(1, 6))]
        text = vs[0]
        for v in vs[1:]:
            blank = rng.random() < 0.2 and v and text and not text[-1:].isspace() and text[-1:] not in ",;|/+~"
            text += (" " if blank else rng.choice([",", " , ", ";", "||", " || ", "/", " + ", "~", "\t|\t"])) + v
        want = [(v[1:-1].replace(v[0] * 2, v[0]) if v[:1] in ("'", '"') else v) for v in vs] if text.strip() else []
        assert s.values("  " + text + " ") == want, text


@pytest.mark.parametrize(
    "text, want",
    [(None, []), ("", []), ("  ", []), (",", ["", ""]), ("a||b", ["a", "b"]), ("a|||b", ["a", "", "b"]), ("a  b", ["a", "b"]), ("a , ,b", ["a", "", "b"]),
     ("'it''s'", ["it's"]), ("a;;", ["a", "", ""]), (" , a ", ["", "a"]), ('"open', ["", "open"]), ("ß~é.1", ["ß", "é.1"])],
)
def test_edges(text, want):
    assert m.Segmenter(["a", "open"]).values(text) == want
    assert m.Segmenter().values(text) == want


@pytest.mark.parametrize(
    "known, text, want",
    [(["a,b"], "x;a,b;c", ["x", "a,b", "c"]), ([], "x;a,b;c", ["x", "a", "b", "c"]), (["a,b"], "xa,b;a,bc", ["xa", "b", "a", "bc"]), (["Smith, Kline & Co"], "Smith, Kline & Co / Smith", ["Smith, Kline & Co", "Smith"]),
     (["a,b", "b,c", "c,d"], "a,b,c,d", ["a,b", "c,d"]), (["a,b", "a,b,c"], "a,b,c", ["a,b,c"]), (["x, y"], '"x, y"', ["x, y"]), (["b c"], "a b c d", ["a", "b c", "d"]), (["'a"], "'a", ["'a"])],
)
def test_dictionary_decides(spark, known, text, want):
    """Known values are kept whole though the grammar would cut them; of overlapping ones the cheapest cover counts."""
    assert m.Segmenter(known).values(text) == want
    fields = spark.createDataFrame([(1, "keyval", 0, text)], "row_id long, field string, item_no int, text string")
    assert [r.value for r in m.unpacked(fields, known).orderBy("pos").collect()] == want


def test_braces_never_closed():
    import time

    began = time.time()
    assert list(m.braces("{" * 50_000 + "'" + "{ " * 50_000)) == [] and list(m.braces("{'}' {'a}'} {")) == ["'}' {'a}'"]
    assert time.time() - began < 5


def test_braces():
    assert list(m.braces("x {a '}' b} y {c} {")) == ["a '}' b", "c"]


def test_long_and_empty(spark):
    many = ",".join(map(str, range(20000)))
    rows = [(1, "keyval", 0, many), (2, "message", 0, "no braces"), (3, "message", 0, "{a}{b,c}")]
    got = m.unpacked(spark.createDataFrame(rows, "row_id long, field string, item_no int, text string")).collect()
    assert sum(r.row_id == 1 for r in got) == 20000
    assert sorted((r.pos, r.value) for r in got if r.row_id == 3) == [(0, "a"), (1, "b"), (2, "c")]
    with pytest.raises(ValueError):
        m.unpacked(spark.createDataFrame(rows, "row_id long, field string, item_no int, text string"), map(str, range(m.DICTIONARY + 1)))


def test_no_automaton_no_result():
    """Where the automaton's library is missing the module can't be loaded, rather than leave it out."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['ahocorasick'] = None; import tidelog.operators.multivalue"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True)
    assert done.returncode and "ahocorasick" in done.stderr
