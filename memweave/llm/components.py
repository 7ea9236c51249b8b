"""Connected components of a link table by union-find inside tasks and star contraction between them.

Links stay distributed: each task first runs union-find on the links it holds
and passes on one link per node, then large-star and small-star rounds let all
nodes of a component meet at its smallest id. Every round is written to the
shared checkpoint folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memweave.session import materialize


def local_forest(links: DataFrame) -> DataFrame:
    """Replace the links (u, v) of each partition by links from every node to the smallest id of its local tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (up := parent.setdefault(root, root)) != root:
                root = up
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for b in batches:
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                a, c = find(u), find(v)
                if a != c:
                    parent[max(a, c)] = min(a, c)
        nodes = [x for x in parent if find(x) != x]
        for at in range(0, max(len(nodes), 1), 100_000):
            part = nodes[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([parent[x] for x in part], pa.int64())], names=["u", "v"])

    return links.select("u", "v").mapInArrow(run, "u long, v long")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "least")  # written, so a hub's rows can be split in the join
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).filter("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = materialize(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _stamp(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): for every node of ``links`` (u long, v long) the smallest id it is connected with.

    Nulls and self-links are ignored; repeated links and both directions are
    allowed. A component's smallest node is listed with itself. The rounds
    end when the links no longer change (their number is logarithmic).
    """
    clean = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u is not null and v is not null and u <> v").distinct()
    now = materialize(local_forest(clean), "links")
    stamp = _stamp(now)
    while stamp[0]:
        now = materialize(_small_star(_large_star(now)), "links")
        last, stamp = stamp, _stamp(now)
        if stamp == last:
            break
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
