"""Road graphs: nodes from lines, shortest paths from many sources, connected components."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborel.operators.lineage import written


def symmetric(edges: DataFrame, u: str = "u", v: str = "v", w: str = "w") -> DataFrame:
    """Both directions of every edge, the shortest of parallel ones; loops and null ends go, a null length is an error."""
    checked = edges.select(F.col(u).alias("u"), F.col(v).alias("v"), F.when(F.col(w).isNull(), F.raise_error(F.lit("an edge has no length"))).otherwise(F.col(w).cast("double")).alias("w"))
    checked = checked.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    return checked.unionByName(checked.select(F.col("v").alias("u"), F.col("u").alias("v"), "w")).groupBy("u", "v").agg(F.min("w").alias("w"))


def _relax(edges: Iterator[pd.DataFrame] | pd.DataFrame, labels: pd.DataFrame) -> pd.DataFrame:
    """Dijkstra from all labelled nodes of one block over its edges; ties go to the least order."""
    out: dict[int, list[tuple[int, float]]] = {}
    for u, v, w in zip(edges["u"].tolist(), edges["v"].tolist(), edges["w"].tolist()):
        out.setdefault(u, []).append((v, w))
    best: dict[int, tuple[float, int]] = {}
    queue: list[tuple[float, int, int]] = []
    for n, d, o in zip(labels["node"].tolist(), labels["dist"].tolist(), labels["source"].tolist()):
        if n not in best or (d, o) < best[n]:
            best[n] = (d, o)
            heapq.heappush(queue, (d, o, n))
    while queue:
        d, o, n = heapq.heappop(queue)
        if best[n] < (d, o):
            continue
        for m, w in out.get(n, ()):
            if m not in best or (d + w, o) < best[m]:
                best[m] = (d + w, o)
                heapq.heappush(queue, (d + w, o, m))
    return pd.DataFrame({"node": list(best), "dist": [x[0] for x in best.values()], "source": [x[1] for x in best.values()]}, columns=["node", "dist", "source"])


def nearest_source(nodes: DataFrame, edges: DataFrame, sources: DataFrame, block: float = 5000.0) -> DataFrame:
    """Every reachable node's least ``dist`` from any source and that ``source``; ties go to the least source.

    ``nodes`` has node, x and y, ``edges`` u, v and w (one row a street), ``sources`` node, dist (the
    way to it) and source (a number). The plane is cut into square blocks; a round runs Dijkstra in each block from the
    labels that have improved there, and hands improved labels of nodes beyond its border to
    their blocks. So rounds grow with the blocks on a shortest path, not with its streets, and
    a task holds one block's streets. Rounds are written to the shared folder.
    """
    at = nodes.select("node", F.concat_ws(":", F.floor(F.col("x") / block), F.floor(F.col("y") / block)).alias("block"))
    ways = written(symmetric(edges).join(at.withColumnRenamed("node", "u"), "u").select("block", "u", "v", "w"), "streets")
    # nodes with a street into another block
    beyond = written(ways.join(at.select(F.col("node").alias("v"), F.col("block").alias("other")), "v").filter("block <> other").select(F.col("v").alias("node")).distinct().withColumn("edge", F.lit(True)), "beyond")
    schema = "node long, dist double, source long"
    start = sources.select(F.col("node").cast("long").alias("node"), F.col("dist").cast("double").alias("dist"), F.col("source").cast("long").alias("source"))
    labels = written(start.groupBy("node").agg(F.min(F.struct("dist", "source")).alias("b")).select("node", "b.dist", "b.source", F.lit(True).alias("fresh")), "labels")
    while labels.filter("fresh").head(1):
        here = labels.join(at, "node").select("block", "node", "dist", "source", "fresh")
        active = here.filter("fresh").select("block").distinct()
        found = (
            ways.join(active, "block", "left_semi").groupBy("block").cogroup(here.join(active, "block", "left_semi").groupBy("block"))
            .applyInPandas(_relax, schema)
        )
        both = labels.select("node", "dist", "source", F.lit(0).alias("new")).unionByName(found.select("node", "dist", "source", F.lit(1).alias("new")))
        best = both.groupBy("node").agg(F.min(F.struct("dist", "source")).alias("b"), F.min(F.when(F.col("new") == 0, F.struct("dist", "source"))).alias("old"))
        # a label is fresh to the blocks beyond the border only if it has just improved; inside its own block it is settled
        best = best.join(beyond, "node", "left")
        improved = F.col("old").isNull() | (F.col("b") < F.col("old"))
        labels = written(best.select("node", "b.dist", "b.source", (improved & F.coalesce("edge", F.lit(False))).alias("fresh")), "labels")
    return labels.select("node", "dist", "source")


def edge_keys(edges: DataFrame, u: str = "u", v: str = "v", order: str = "edge_id") -> DataFrame:
    """``edges`` with ``key``, which tells parallel edges from u to v apart: 0, 1, ... in the order of ``order``."""
    return edges.withColumn("key", F.row_number().over(Window.partitionBy(u, v).orderBy(order)) - 1)


def node_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) of every end of an edge; a component is named by its least node."""
    links = edges.select(F.greatest(u, v).alias("node"), F.least(u, v).alias("root")).filter("node IS NOT NULL AND root IS NOT NULL")
    ends = links.select(F.col("node")).unionByName(links.select(F.col("root").alias("node"))).distinct()
    links = written(links.filter("node <> root").distinct(), "links")
    while True:
        least = links.groupBy("node").agg(F.min("root").alias("least"))
        hooks = links.join(least, "node").filter("root <> least").select(F.greatest("root", "least").alias("node"), F.least("root", "least").alias("root"), F.lit(True).alias("moved"))
        over = least.select(F.col("node").alias("least"), F.col("least").alias("beyond"))
        jumps = least.join(over, "least", "left").select("node", F.coalesce("beyond", "least").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        after = written(jumps.unionByName(hooks).groupBy("node", "root").agg(F.max("moved").alias("moved")), "links")
        links = after.select("node", "root")
        if not after.filter("moved").head(1):
            break
    return ends.join(links, "node", "left").select("node", F.coalesce("root", "node").alias("component"))


def largest_component(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """The edges of the component with the most nodes, the least name where several are as large."""
    found = node_components(edges, u, v)
    largest = found.groupBy("component").count().orderBy(F.desc("count"), "component").limit(1).select("component")
    kept = found.join(F.broadcast(largest), "component", "left_semi").select(F.col("node").alias(u))
    return edges.join(kept, u, "left_semi")


def derived_nodes(lines: DataFrame, path: str = "path", edge_id: str = "edge_id", places: int = 1) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of lines: ends rounded to ``places`` decimals are the nodes (node, x, y), numbered from 0
    in the order of edge_id, start before end; edges has edge_id, u and v.

    Numbers are running counts over ranges of edge_id, so no single task orders all ends.
    """
    first, last = F.col(path)[0], F.element_at(path, -1)
    ends = lines.select(edge_id, F.posexplode(F.array(first, last)).alias("side", "p")).select(edge_id, "side", F.round("p.x", places).alias("x"), F.round("p.y", places).alias("y"))
    seen = ends.groupBy("x", "y").agg(F.min(F.struct(edge_id, "side")).alias("at"))
    seen = written(seen.repartitionByRange("at").sortWithinPartitions("at").withColumn("part", F.spark_partition_id()), "ends")
    sizes = {r["part"]: r["count"] for r in seen.groupBy("part").count().collect()}
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    offsets = lines.sparkSession.createDataFrame(starts or [(0, 0)], "part int, before long")
    place = F.row_number().over(Window.partitionBy("part").orderBy("at"))
    nodes = seen.withColumn("place", place).join(F.broadcast(offsets), "part").select((F.col("before") + F.col("place") - 1).alias("node"), "x", "y")
    named = ends.join(nodes, ["x", "y"]).groupBy(edge_id).agg(F.min(F.when(F.col("side") == 0, F.col("node"))).alias("u"), F.min(F.when(F.col("side") == 1, F.col("node"))).alias("v"))
    return nodes, named
