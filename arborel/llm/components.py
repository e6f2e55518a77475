"""Connected components of a distributed edge list.

Each round every node takes the least root it is linked to, other roots it had are linked to
that one, and roots are followed one step. Before the first round each partition contracts its
own edges with a union-find, so hubs and chains within a partition cost one row a node. Rounds
are written to the shared folder; nothing but two counts comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborel.llm.common import stored


class Forest:
    """Union-find over arbitrary integers; the least member of a set is its root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (p := up.get(top, top)) != top:
            top = p
        while (p := up.get(x, x)) != top:
            up[x] = top
            x = p
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
    nodes = [x for x in forest.up if forest.root(x) != x]
    roots = [forest.root(x) for x in nodes]
    for i in range(0, len(nodes), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[i : i + (1 << 16)], pa.int64()), pa.array(roots[i : i + (1 << 16)], pa.int64())], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b: long, not null) that is not itself the least of its component."""
    links = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).filter("node <> root")
    links = stored(links.mapInArrow(_contract, "node long, root long"), "links")
    while True:
        least = links.groupBy("node").agg(F.min("root").alias("least"))
        # other roots of a node, which belong together with its least one
        hooks = links.join(least, "node").filter("root <> least").select(F.greatest("root", "least").alias("node"), F.least("root", "least").alias("root"), F.lit(True).alias("moved"))
        over = least.select(F.col("node").alias("least"), F.col("least").alias("beyond"))
        jumps = least.join(over, "least", "left").select("node", F.coalesce("beyond", "least").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        after = stored(jumps.unionByName(hooks).groupBy("node", "root").agg(F.max("moved").alias("moved")), "links")
        links = after.select("node", "root")
        if not after.filter("moved").head(1):
            return links
