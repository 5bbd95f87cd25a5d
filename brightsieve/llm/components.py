"""Connected components of a table of links, by alternating star contraction.

Each round points every node's larger neighbours, then its smaller ones, at
the least neighbour (Kiveris et al., "Connected components in MapReduce and
beyond"), until nothing changes. Rounds are written to the shared folder, so a
lost executor costs one round at most, and no link reaches the driver.

Before the rounds each task contracts slices of its links to stars, which shortens
chains. Where all links are no more than one SLICE, that is the answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightsieve.llm.base import drop_written, lean, written

#: Parts over which the rows of one node or component are dealt where they are joined.
SALT = 8
#: Links that a task contracts at once (2 MB of them).
SLICE = 1 << 17


def _salted(few: DataFrame) -> DataFrame:
    """``few`` once for each part, ``salt``."""
    return few.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALT)])))


def _salt(column: str):
    return F.pmod(F.xxhash64(column), F.lit(SALT)).cast("int")


def _star(both: DataFrame) -> DataFrame:
    """Each node's least neighbour (itself included) beside all its links; ``both`` has u, v."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    dealt = both.withColumn("part", _salt("v"))
    return dealt.join(_salted(least), (F.col("u") == F.col("k")) & (F.col("part") == F.col("salt"))).select("u", "v", "m")


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links u, v that aren't the least of their component, and that least one."""
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    x, y = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
        x, y = root[x], root[y]
        apart = x != y
        x, y = x[apart], y[apart]
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _contracted(edges: DataFrame) -> DataFrame:
    """``edges`` with slices of each partition's links as stars: they connect the same nodes."""

    @lean
    def run(batches):
        held, n = [], 0

        def told():
            u, v = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in stars(u, v)], ["u", "v"])

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                if n + part.num_rows > SLICE:
                    yield told()
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if held:
            yield told()

    return edges.mapInArrow(run, "u long, v long")


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of ``links`` that isn't itself the least of its component."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges = written(edges, "links")
    slices = -(-edges.count() // SLICE)
    before, edges = edges, written(_contracted(edges.coalesce(max(slices, 1))), "links")
    drop_written(before)
    if slices <= 1:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_star(both).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        small = _star(large)
        before, edges = edges, written(
            small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.where("u != m").select("u", F.col("m").alias("v"))).distinct(),
            "links",
        )
        drop_written(before)
        drop_written(large)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def class_names(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, class_id``: the least ``least`` of the nodes (node, least) that links (a, b) connect; a component's rows are dealt over SALT parts."""
    roots = connected(links, "a", "b").select(F.col("node").alias("rn"), "root")
    rooted = written(nodes.join(roots, F.col("node") == F.col("rn"), "left").select("node", "least", F.coalesce("root", "node").alias("root")), "rooted")
    names = rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.count(F.lit(1)).alias("n"))
    alone, shared = names.where("n = 1"), names.where("n > 1")
    held = rooted.withColumn("part", _salt("node"))
    dealt = shared.select(F.col("root").alias("cr"), "class_id")
    several = held.join(_salted(dealt), (F.col("root") == F.col("cr")) & (F.col("part") == F.col("salt"))).select("node", "class_id")
    return several.unionByName(alone.select(F.col("root").alias("node"), "class_id"))
