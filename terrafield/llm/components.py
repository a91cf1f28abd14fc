"""Connected components of an undirected graph of 64-bit nodes, without gathering it anywhere.

Each round merges every node into the neighbour (or itself) of least hash, the hash changing
by round, so that a constant share of the nodes goes away per round whatever the graph's
shape. Before that, each task replaces the links it holds by a spanning forest of them.
Links, forests and labels are tables in the shared folder; the driver sees counts alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Links that a task joins at once; bounds its memory.
CHUNK_LINKS = 1 << 18


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}
    links = 0

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def stars() -> pa.RecordBatch:
        pairs = [(x, root(x)) for x in list(parent)]
        pairs = [p for p in pairs if p[0] != p[1]]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        links += batch.num_rows
        if links >= CHUNK_LINKS:
            yield stars()
            links = 0
    yield stars()


def connected_components(links: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """``links`` (a bigint, b bigint) to (node, label): nodes share a label if and only if they are connected.

    Only nodes with a link to another node are returned. Links to itself and repeated links
    do no harm; no links give an empty table.
    """
    assigned: DataFrame | None = None
    for turn in range(most_rounds):
        links = materialise(links.select("a", "b").filter("a <> b").mapInArrow(_forest, "a bigint, b bigint"), f"{name}-links")
        if links.isEmpty():
            break
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("v"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min(order("b")).alias("m"))
        parents = materialise(parents.select("node", F.least("m", order("node"))["v"].alias("label")), f"{name}-parents")
        up_a = parents.select(F.col("node").alias("a"), F.col("label").alias("la"))
        up_b = parents.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        links = links.join(up_a, "a").join(up_b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
        if assigned is None:
            assigned = parents
        else:
            moved = parents.select(F.col("node").alias("label"), F.col("label").alias("next"))
            assigned = materialise(assigned.join(moved, "label", "left").select("node", F.coalesce("next", "label").alias("label")), f"{name}-labels")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return assigned if assigned is not None else links.select(F.col("a").alias("node"), F.col("b").alias("label"))
