"""Parent-child rows into paths, depths, roots and descendants, with circles found.

Rows are laid out by a locality key (an order's versions lie together) in partitions of even size. Each task contracts
the chains within it: every node learns its exit, the last ancestor in the partition, and how far that is. The exits whose
parent lies elsewhere form a smaller forest of the same shape, which is solved the same way, level by level, until it fits
one task; the answers are then expanded to all nodes. Where the layout keeps too little together, a level contracts
stars instead (a node into its parent, where a coin of their hashes says so), which takes a quarter of the open nodes
whatever the shape. Nothing is gathered by tree: a deep or wide tree costs what its number of nodes costs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.runtime import settled

#: Nodes that one task contracts: as many as spread a level over all cores, within these bounds. A forest of at most the lower bound is solved in one task.
TASK_NODES = 25_000, 500_000

NONE = np.iinfo(np.int64).max

#: A node's exit, its distance and the smallest node on the way to it; of the exit: its parent, the distance there and the smallest
#: node before it; the smallest node of the circle it is in or below.
_LOCAL = "node long, exit long, dist long, low long, up long, up_dist long, up_low long, ring long"


def contracted(node: np.ndarray, parent: np.ndarray, has: np.ndarray, weight: np.ndarray, least: np.ndarray):
    """Positions of the exits, distances, smallest nodes on the way, and the smallest node of a circle above (``NONE``: there is none)."""
    n = len(node)
    order = np.argsort(node, kind="stable")
    at = np.searchsorted(node[order], parent)
    at[at == n] = 0
    at = order[at]
    inside = has & (node[at] == parent)
    step = np.where(inside, at, np.arange(n))
    jump, dist, low = step.copy(), np.where(inside, weight, 0), np.where(inside, least, NONE)
    for _ in range(int(n).bit_length() + 1):  # after k rounds a pointer is 2^k steps up
        far = jump[jump]
        if (far == jump).all():
            break
        low, dist, jump = np.minimum(low, low[jump]), dist + dist[jump], far
    ring = np.full(n, NONE)
    circular = inside[jump]  # further up than there are nodes, and still a parent: the pointer stands on a circle
    if circular.any():
        smallest: dict[int, int] = {}
        for s in np.unique(jump[circular]).tolist():
            if s not in smallest:
                members, x = [s], int(step[s])
                while x != s:
                    members.append(x)
                    x = int(step[x])
                smallest.update(dict.fromkeys(members, int(least[members].min())))
        ring[circular] = [smallest[j] for j in jump[circular].tolist()]
    return jump, dist, low, ring


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    t = pa.Table.from_batches(batches)
    has = t.column("parent").is_valid().to_numpy()
    parent = t.column("parent").fill_null(0).to_numpy()
    node, weight, least = (t.column(c).to_numpy() for c in ("node", "weight", "least"))
    tag = t.column("ring").fill_null(NONE).to_numpy()
    jump, dist, low, ring = contracted(node, parent, has, weight, least)
    ring = np.minimum(ring, tag[jump])
    closed = (ring != NONE) | ~has[jump]
    cols = {
        "node": pa.array(node), "exit": pa.array(node[jump]), "dist": pa.array(dist), "low": pa.array(low), "up": pa.array(parent[jump], mask=closed),
        "up_dist": pa.array(weight[jump]), "up_low": pa.array(least[jump]), "ring": pa.array(ring, mask=ring == NONE),
    }
    yield from pa.Table.from_pydict(cols).to_batches(max_chunksize=65536)


def _stars(forest: DataFrame) -> DataFrame:
    coin = lambda c: F.xxhash64(c).bitwiseAND(1)
    into = (coin("node") == 0) & (coin("parent") == 1)
    none = F.lit(NONE)
    return forest.select(
        "node", F.when(into, F.col("parent")).otherwise(F.col("node")).alias("exit"), F.when(into, F.col("weight")).otherwise(0).alias("dist"),
        F.when(into, F.col("least")).otherwise(none).alias("low"), F.when(~F.coalesce(into, F.lit(False)), F.col("parent")).alias("up"),
        F.col("weight").alias("up_dist"), F.col("least").alias("up_low"), "ring",
    )


def _tasks(nodes: int, cores: int, bounds: tuple[int, int]) -> int:
    """How many tasks contract a level of so many nodes."""
    return -(-nodes // min(max(-(-nodes // (2 * cores)), bounds[0]), bounds[1]))


def _solved(forest: DataFrame, nodes: int, level: int, stars: bool, bounds: tuple[int, int]) -> DataFrame:
    """``node, root, depth, ring`` of ``forest`` (``place, node, parent, weight, least, ring``). At level 0 a parent that is no
    node is none; above, it is a root that was settled below."""
    tasks = _tasks(nodes, forest.sparkSession.sparkContext.defaultParallelism, bounds)
    if tasks <= 1:
        local = forest.coalesce(1).mapInArrow(_contract, _LOCAL)
        if level == 0:
            return local.select("node", F.when(F.col("ring").isNull(), F.col("exit")).alias("root"), F.when(F.col("ring").isNull(), F.col("dist")).alias("depth"), "ring")
        return local.select(
            "node", F.when(F.col("ring").isNull(), F.coalesce("up", "exit")).alias("root"),
            F.when(F.col("ring").isNull(), F.col("dist") + F.when(F.col("up").isNotNull(), F.col("up_dist")).otherwise(0)).alias("depth"), "ring",
        )
    if stars:
        local = settled(_stars(forest), "stars")
    else:
        local = settled(forest.repartitionByRange(tasks, "place", "node").mapInArrow(_contract, _LOCAL), "contracted")
    exits = local.where((F.col("node") == F.col("exit")) & F.col("ring").isNull() & F.col("up").isNotNull()).select("node", "up", "up_dist", "up_low")
    onto = local.select(F.col("node").alias("up"), F.col("exit").alias("onto"), F.col("dist").alias("on"), F.col("low").alias("on_low"), F.col("ring").alias("above"))
    raised = exits.join(onto, "up", "inner" if level == 0 else "left")
    upper = settled(
        raised.select(
            F.coalesce("onto", "node").alias("place"), "node", F.when(F.col("above").isNull(), F.col("onto")).alias("parent"), (F.col("up_dist") + F.coalesce("on", F.lit(0))).alias("weight"),
            F.least("up_low", "on_low").alias("least"), F.col("above").alias("ring"), F.when(F.col("onto").isNull(), F.col("up")).alias("root"),
        ),
        "quotient",
    )
    open_ = upper.where("root is null").drop("root")
    left = open_.count()
    nothing = F.lit(None).cast("long")
    answers = _solved(open_, left, level + 1, left > nodes * 8 // 10 and not stars, bounds)
    known = upper.where("root is not null").select("node", "root", F.col("weight").alias("depth"), nothing.alias("ring"))
    if level > 0:  # what is a root above may be one that hangs on a root settled further below
        below = known.select(F.col("node").alias("root"), F.col("root").alias("below"), F.col("depth").alias("more"))
        answers = answers.join(below, "root", "left").select("node", F.coalesce("below", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), "ring")
    answers = answers.unionByName(known)
    if stars:
        answers = answers.unionByName(local.where("ring is not null and node = exit").select("node", nothing.alias("root"), nothing.alias("depth"), "ring"))
    answers = settled(answers.select(F.col("node").alias("exit"), "root", "depth", F.col("ring").alias("exit_ring")), "answers")
    whole = local.join(answers, "exit", "left").withColumn("circle", F.coalesce("ring", "exit_ring"))
    return whole.select(
        "node", F.when(F.col("circle").isNull(), F.coalesce("root", "exit")).alias("root"),
        F.when(F.col("circle").isNull(), F.coalesce("depth", F.lit(0)) + F.col("dist")).alias("depth"), F.col("circle").alias("ring"),
    )


def depths(links: DataFrame, place: str | None = None, task_nodes: int | tuple[int, int] = TASK_NODES) -> DataFrame:
    """``node, root, depth, ring`` for each node of ``links`` (``node, parent`` of type long, one row per node).

    A null parent, or one that is no node, makes a root (its own root, depth 0). A node in a circle or below one has null
    root and depth and, as ``ring``, the smallest node of that circle. ``place`` names a column by which related nodes lie
    together; it changes only the speed. ``task_nodes``: nodes to a task, or the least and the most. Rows with a null node give nothing.
    """
    nothing = F.lit(None).cast("long")
    forest = links.where(F.col("node").isNotNull()).select(
        F.col(place or "node").alias("place"), "node", "parent", F.lit(1).cast("long").alias("weight"), F.col("node").alias("least"), nothing.alias("ring")
    )
    forest = settled(forest, "forest")
    return _solved(forest, forest.count(), 0, False, (task_nodes, task_nodes) if isinstance(task_nodes, int) else task_nodes)


def ancestry(links: DataFrame, solved: DataFrame) -> DataFrame:
    """``node, ancestor, distance`` of every node and every ancestor of it (so: every ancestor's descendants), circles left out.

    ``solved`` is the answer of :func:`depths`. Distances double in each round; the result has as many rows as the
    depths of all nodes sum up to.
    """
    free = solved.where("ring is null and depth > 0").select("node")
    pairs = settled(links.join(free, "node").select("node", F.col("parent").alias("ancestor"), F.lit(1).cast("long").alias("distance")), "pairs")
    deepest, reach = solved.agg(F.max("depth")).first()[0] or 0, 1
    while reach < deepest:
        further = pairs.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("beyond"), F.col("distance").alias("more"))
        longer = pairs.where(F.col("distance") == reach).join(further, "ancestor").select("node", F.col("beyond").alias("ancestor"), (F.col("distance") + F.col("more")).alias("distance"))
        pairs = settled(pairs.unionByName(longer), "pairs")
        reach *= 2
    return pairs


def paths(pairs: DataFrame, solved: DataFrame) -> DataFrame:
    """``node, path``: the nodes from the root down to the node itself; no row for nodes in or below a circle."""
    way = pairs.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("d"), "ancestor"))), lambda x: x["ancestor"]).alias("way"))
    return solved.where("ring is null").select("node").join(way, "node", "left").select("node", F.concat(F.coalesce("way", F.array().cast("array<bigint>")), F.array("node")).alias("path"))


def order_links(orders: DataFrame) -> DataFrame:
    """``node, parent, place`` of each distinct ``hash``: the parent is ``prev_hash`` unless null or 0, else the first entry of
    ``parent_hash`` that is neither, else null. Of rows with the same hash the one with the smallest ``row_id`` counts."""
    first = F.get(F.filter("parent_hash", lambda x: x.isNotNull() & (x != 0)), F.lit(0))
    parent = F.coalesce(F.when(F.col("prev_hash") != 0, F.col("prev_hash")), first)
    rows = orders.where(F.col("hash").isNotNull()).select(F.col("hash").alias("node"), "row_id", F.struct(parent.alias("parent"), F.col("xhash").alias("place")).alias("at"))
    return rows.groupBy("node").agg(F.min_by("at", "row_id").alias("at")).select("node", "at.parent", "at.place")
