"""Reading levels: held-out accuracy against single readers, prose, and edges."""

import duckdb
import numpy as np
import pytest

from tidelog.llm import reading as R
from tidelog.runtime import scan


def labelled(sf):
    q = f"select doc_id, any_value(text), list(level) from '{sf}/documents.parquet' join '{sf}/reading_labels.parquet' using (doc_id) where genre <> 'capture' and trim(text) <> '' group by 1 order by hash(doc_id)"
    return duckdb.connect().execute(q).fetchall()


def test_held_out():
    rows = labelled("/root/testdata/sf0.1")
    cut = len(rows) * 2 // 3
    model = R.fit([r[1] for r in rows[:cut]], [r[2] for r in rows[:cut]])
    got = model.levels([r[1] for r in rows[cut:]])
    off = np.array([abs(x - g) for r, g in zip(rows[cut:], got) for x in r[2]])
    # two readers of one document agree in nine of ten cases
    assert (off == 0).mean() > 0.85 and (off <= 1).mean() > 0.99


def test_sentences():
    text = "# Title\n- One fish.\n- Two fish! Three\r\n\r\n2026-02-20 07:00:32.673 [60] [Snap] (INFO) 8=FIX.4.4|35=D|34=1|\nIt goes\non here. | no table\n| a | b |\n#SYMBOL=KAVO|#SIDE=1|#X=2\n> quoted\n"
    assert R.sentences(text) == ["One fish.", "Two fish!", "Three", "It goes on here.", "| no table"]


def test_table(spark, sf):
    docs, labels = scan(spark, "/root/testdata/sf0.01", "documents"), scan(spark, "/root/testdata/sf0.01", "reading_labels")
    from tidelog.llm.queries import p10_found

    got = p10_found(spark, "/root/testdata/sf0.01").collect()
    want = docs.where("genre <> 'capture' and text is not null").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in want if r.text.strip())
    assert {r.level for r in got} == {1, 2, 3, 4}
    # pasted lines change nothing
    some = docs.where("genre <> 'capture' and length(text) > 300").limit(40)
    noisy = some.selectExpr("doc_id", "concat('2026-02-20 07:00:32.673 [60-l00:4140] [SnapPublisher] (WARNING) ticket T0-4 matched on lane 332 after 231 us\\n', text) as text")
    a, b = ({r.doc_id: r.level for r in R.leveled(x.unionByName(docs, allowMissingColumns=True).dropDuplicates(["doc_id"]), labels).collect()} for x in (some, noisy))
    assert len(a) == len(b) and sum(a[k] == b[k] for k in a) >= 0.98 * len(a)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, " \n\t", 9), (3, "Plain words here. ", 9), (4, "|a|b|", 9), (5, "word " * 60000, 9), (3, "Plain words here.", 9)], "doc_id long, text string, level int")
    none = spark.createDataFrame([(3, "r", 0), (99, "r", 2), (None, "r", 1), (2, "r", 1)], "doc_id long, reader string, level int")
    got = R.leveled(docs, none).collect()
    assert sorted(r.doc_id for r in got) == [3, 3, 4, 5] and {r.level for r in got} == {None}
    some = none.unionByName(spark.createDataFrame([(3, "r", 1), (5, "r", 4), (5, "s", 4)], none.schema))
    got = {r.doc_id: r.level for r in R.leveled(docs, some).collect()}
    assert set(got) == {3, 4, 5} and set(got.values()) <= {1, 2, 3, 4}
    assert R.leveled(docs.limit(0), some).count() == 0


@pytest.mark.parametrize("p, level", [([1, 0, 0, 0], 1), ([0.4, 0.2, 0.2, 0.2], 2), ([0, 0, 0, 1], 4), ([0.25, 0.25, 0.25, 0.25], 2)])
def test_settle(p, level):
    assert R.settle(np.array([p]))[0] == level
