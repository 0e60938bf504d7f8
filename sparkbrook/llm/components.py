"""Connected components of a graph given as rows of links, without a driver-side copy.

Large-star and small-star steps, each a pre-aggregated minimum per node joined back to the
links, until nothing changes or few enough links are left for one task to finish: O(log n)
rounds in practice. Rounds are written to the
shared folder, so the lineage stays short and a lost executor costs one round. The minima
are written before they are joined back: both sides of that join are then bare exchanges of
written tables, the form in which adaptive execution splits the partition of a star's centre.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbrook.llm.memory import returning
from sparkbrook.scratch import materialize


#: What is left of the links at this size (1.6 MB) is finished by one task.
SMALL = 100_000


def _local_stars(batches):
    """Every partition's links as stars around the smallest node of each local component."""
    import pyarrow as pa

    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 1_000_000:  # bounded memory: what is known goes out, and is forgotten
            yield _stars(pa, parent, find)
            parent.clear()
    yield _stars(pa, parent, find)


def _stars(pa, parent, find):
    pairs = [(x, find(x)) for x in parent]
    pairs = [p for p in pairs if p[0] != p[1]]
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["u", "v"])


def _mark(links: DataFrame) -> tuple[int, int]:
    n, total = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return n, total


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns): its smallest reachable node.

    Links of a node with itself or with null are left out.
    """
    a, b = links.columns[:2]
    pairs = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v")
    stars = materialize(pairs.mapInArrow(returning(_local_stars), "u long, v long"), "stars")
    mark = _mark(stars)
    for _ in range(rounds):
        if not mark[0]:
            break
        if mark[0] <= SMALL:
            stars = materialize(stars.coalesce(1).mapInArrow(returning(_local_stars), "u long, v long"), "stars")
            break
        # large star: neighbours above a node go to its smallest neighbour
        both = stars.unionByName(stars.selectExpr("v AS u", "u AS v"))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m"), "least")
        large = both.join(least, "u").filter("v > u").selectExpr("v AS u", "m AS v").filter("u <> v")
        # small star: neighbours below a node, and the node, go to the smallest of them
        large = materialize(large.distinct(), "large-star")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        joined = large.join(low, "u")
        small = joined.selectExpr("v AS u", "m AS v").unionByName(low.selectExpr("u", "m AS v")).filter("u <> v").distinct()
        stars = materialize(small, "stars")
        new = _mark(stars)
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("the components did not settle")
    roots = stars.select(F.col("v").alias("node")).distinct().selectExpr("node", "node AS component")
    return stars.selectExpr("u AS node", "v AS component").unionByName(roots)
