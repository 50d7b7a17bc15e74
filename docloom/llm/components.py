"""Connected components: distributed union-find over an edge table.

Every task joins the edges of its own partition and names each node by the smallest it is joined to.  A node that tasks name apart links their names, and these
links, far fewer, are solved in the same way, at last in one task once there are at most ``TASK_EDGES`` of them.  A node comes at most once from each
task, so a hub is no task's burden.  Where a level's links are not even halved (long chains over many tasks), large-star and small-star steps take
over, which shorten any chain by a power each round.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved

#: Links that one task solves, nodes that a task holds at once, and names up to which they are broadcast (16 bytes each).
TASK_EDGES, TASK_NODES, MAX_BROADCAST_NAMES = 50_000, 1_000_000, 500_000
#: Neighbours that make a hub, in the star steps, and hubs up to which they are broadcast.
HUB, MAX_BROADCAST_HUBS = 1000, 500_000


def components(edges: DataFrame, task_edges: int = TASK_EDGES, hub: int = HUB) -> DataFrame:
    """Edges (a, b) of bigint -> (node, label) for every node of an edge; the label is the component's smallest node."""
    now = saved(edges.where(F.col("a") != F.col("b")).select("a", "b"))
    out = _solved(now, task_edges, hub)
    discard(now)
    return out


def _solved(now: DataFrame, task_edges: int, hub: int) -> DataFrame:
    n = now.count()
    if n <= task_edges:
        return saved(now.coalesce(1).mapInArrow(_joined, "node bigint, label bigint"))
    own = saved(now.mapInArrow(_joined, "node bigint, label bigint"))
    named = saved(own.groupBy("node").agg(F.min("label").alias("least"), F.collect_set("label").alias("names")))  # at most a name for each task
    more = saved(named.where(F.size("names") > 1).select(F.explode("names").alias("a"), F.col("least").alias("b")).where("a <> b").distinct())
    discard(own)
    k = more.count()
    if not k:
        return named.select("node", F.col("least").alias("label"))
    above = (_solved if 2 * k <= n else _starred)(more, *((task_edges, hub) if 2 * k <= n else (hub,))).select(F.col("node").alias("least"), "label")
    above = F.broadcast(above) if 2 * k <= MAX_BROADCAST_NAMES else above
    out = saved(named.join(above, "least", "left").select("node", F.coalesce("label", "least").alias("label")))
    discard(named)
    discard(more)
    return out


def _joined(batches):
    """(node, label): union-find over what a task is given; when it holds many nodes it names them and begins anew."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := up[x]) != x:
            up[x] = x = up[y]
        return x

    def named():
        nodes = list(up)
        for lo in range(0, len(nodes), 100_000):
            own = nodes[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([find(x) for x in own], pa.int64())], names=["node", "label"])
        up.clear()

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            up.setdefault(a, a)
            up.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        if len(up) > TASK_NODES:
            yield from named()
    yield from named()


def _starred(edges: DataFrame, hub: int = HUB) -> DataFrame:
    """The same by alternating large-star and small-star steps; minima are written before they are joined."""
    now = saved(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while True:
        middle = _star(now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), F.col("b") > F.col("a"), hub)
        after = _star(middle, F.lit(True), hub, include_self=True)
        discard(now)
        discard(middle)
        was, state, now = state, _state(after), after
        if state == was:
            break
    tops = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(tops)


def _star(pairs: DataFrame, keep, hub: int, include_self: bool = False) -> DataFrame:
    """For each node: its neighbours that ``keep`` admits are linked to the least of the neighbourhood."""
    least = saved(pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n"))
    hubs = least.where(F.col("n") > hub).select("a", "m")
    n = hubs.count()
    if n:
        hubs = F.broadcast(hubs) if n <= MAX_BROADCAST_HUBS else hubs
        met = pairs.join(hubs.select("a"), "a", "left_anti").join(least, "a").select("a", "b", "m").union(pairs.join(hubs, "a").select("a", "b", "m"))
    else:
        met = pairs.join(least, "a")
    linked = met.where(keep).select(F.col("b").alias("x"), "m")
    if include_self:
        linked = linked.union(least.select(F.col("a").alias("x"), "m"))
    out = saved(linked.where(F.col("x") != F.col("m")).select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct())
    discard(least)
    return out


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
