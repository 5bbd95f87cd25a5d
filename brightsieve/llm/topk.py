"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are dealt to the nearest of some pivots (chosen farthest first from a
bounded sample: they are the top of the tree and drop no row), a pivot's rows into blocks of bounded size.
A block is one row that holds its points and the cover tree over
them, built once and stored: a node is a point with a level; its children, itself
the first, are points more than 2^(level - 1) apart that cover its points
within 2^(level - 1); its covering radius is the distance of its farthest
point. Queries are blocks with trees of their own. Traversal of both trees
drops a pair of nodes when

    <q, p> + r_q |p| + r_p |q| + r_q r_p

(points q and p of the nodes, radii r) is below the worst k-th score that the
query node's points have so far (Curtin and Ram, "Dual-tree fast exact
max-kernel search"). The same bound prunes above the blocks: a query block meets
first the block that looks best for it, which gives scores to beat, then the
pivots, then (in an equi-join by pivot) the blocks' own roots. Only what is left
is a pair, a row of two block numbers; blocks join it by their numbers.

Scores are exact integers: 64-bit floats carry them while every possible sum is
below 2^53, Python integers beyond. Defined cases: null vectors, and vectors
with null or non-finite components or of another length than the most common
one take no part; rows with a null id neither; ties go to the smaller id;
repeated ids are separate candidates, but a query never meets its own id, and of
queries with equal ids the one with the least vector is asked; fewer
candidates than k give them all; an empty table gives an empty result; scores
beyond 64 bits are held at the bounds of a long. Other columns aren't read.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightsieve.llm.base import lean, written

#: Rows of the sample that pivots are chosen from, and pivots at most.
SAMPLE, PIVOTS = 8_192, 1_024
DATA_BLOCK, QUERY_BLOCK, LEAF = 2_048, 256, 16
#: Leaves that a group of queries meets at once.
SOME = 8


def _away(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(points - at).sum(axis=1))


class CoverTree:
    """Nodes over the points in tree order: ``point`` (its place), ``radius``, ``first`` and ``last`` of its points, ``kid`` and ``kids`` (its children follow each other)."""

    FIELDS = np.dtype([("point", "<i4"), ("radius", "<f8"), ("first", "<i4"), ("last", "<i4"), ("kid", "<i4"), ("kids", "<i4")])

    def __init__(self, points: np.ndarray, nodes: np.ndarray):
        self.points, self.nodes = points, nodes
        self.at, self.radius = points[nodes["point"]], nodes["radius"]
        self.size = np.sqrt(np.square(self.at).sum(axis=1))

    @classmethod
    def grown(cls, points: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """The tree, and the order in which it holds the points."""
        order = np.arange(len(points))
        made = [None]
        start = int(_away(points, points.mean(axis=0)).argmin()) if len(points) else 0
        todo = [(0, 0, len(points), start, _away(points, points[start]) if len(points) else np.empty(0))]
        while todo:
            node, first, last, point, away = todo.pop()
            rows = order[first:last]
            radius = float(away.max(initial=0.0))
            if len(rows) <= LEAF or radius == 0.0:
                made[node] = (point, radius, first, last, 0, 0)
                continue
            reach = 2.0 ** (np.ceil(np.log2(radius)) - 1)  # radius <= 2^level, children cover half of that
            if reach >= radius:
                reach = radius / 2
            groups, left, near = [], np.arange(len(rows)), away
            while True:
                inside = near <= reach
                groups.append((point, left[inside], near[inside]))
                left, away_left = left[~inside], near[~inside]
                if not len(left):
                    break
                pick = left[int(away_left.argmax())] if len(groups) == 1 else left[0]
                point = int(rows[pick])
                near = _away(points[rows[left]], points[point])
            made[node] = (groups[0][0], radius, first, last, len(made), len(groups))
            order[first:last] = np.concatenate([rows[g] for _, g, _ in groups])
            at = first
            for p, g, d in groups:
                todo.append((len(made), at, at + len(g), p, d))
                made.append(None)
                at += len(g)
        place = np.empty(len(points), np.int64)
        place[order] = np.arange(len(points))
        nodes = np.array([(place[p] if len(place) else 0, *rest) for p, *rest in made], cls.FIELDS)
        return cls(points[order], nodes), order


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of whole-numbered float rows, exact."""
    most = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * a.shape[1]
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])(a) @ np.vectorize(int, otypes=[object])(b).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


class Best:
    """The k best candidates of each query so far; ``worst`` is the k-th score, or the floor given."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.score, self.ids = k, [np.empty(0, np.int64)] * n, [np.empty(0, np.int64)] * n
        self.worst, self.scored = floor.astype(np.float64), 0

    def meet(self, rows: np.ndarray, own: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of the queries ``rows`` (ids ``own``) with candidates ``ids``."""
        self.scored += scores.size
        able = (scores >= self.worst[rows, None]) & (ids[None, :] != own[:, None])
        for i in np.flatnonzero(able.any(axis=1)):
            q, found = rows[i], np.flatnonzero(able[i])
            score, names = np.r_[self.score[q], scores[i][found]], np.r_[self.ids[q], ids[found]]
            if len(score) > 4 * self.k:  # of many, those that reach the k-th score
                kth = np.partition(score, len(score) - self.k)[len(score) - self.k]
                score, names = score[score >= kth], names[score >= kth]
            kept = np.lexsort((names, ~score))[: self.k]  # ~score falls as the score rises, without overflow
            self.score[q], self.ids[q] = score[kept], names[kept]
            if len(kept) == self.k:
                self.worst[q] = max(self.worst[q], float(score[kept[-1]]))


def _bound(dot, rq, sq, rp, sp):
    most = dot + rq * sp + rp * sq + rq * rp
    return most + np.abs(most) * 1e-9 + 1e-6


def search(queries: CoverTree, query_ids: np.ndarray, data: CoverTree, data_ids: np.ndarray, best: Best) -> None:
    """Traverses both trees and adds to ``best`` (by query row) all that can matter."""
    q, d = queries.nodes, data.nodes
    queries_size = np.sqrt(np.square(queries.points).sum(axis=1))
    todo = [(0, np.array([0]))]
    while todo:
        a, some = todo.pop()
        rows = np.arange(q["first"][a], q["last"][a])
        if not len(rows) or not len(data.points):
            continue
        most = _bound(data.at[some] @ queries.at[a], queries.radius[a], queries.size[a], data.radius[some], data.size[some])
        able = most >= best.worst[rows].min()
        some, most = some[able], most[able]
        if not len(some):
            continue
        kids = np.arange(q["kid"][a], q["kid"][a] + q["kids"][a])
        if len(kids) and not q["kids"][kids].any():
            _together(rows, queries.points[rows], queries_size[rows], query_ids[rows], some, data, data_ids, best)
            continue
        if len(kids) and (queries.radius[a] >= data.radius[some].max() or not d["kids"][some].any()):
            todo += [(c, some) for c in kids]
            continue
        leaf = d["kids"][some] == 0
        inner = some[~leaf]
        if len(inner):
            # the likeliest half of the children comes off the stack first
            kids = np.concatenate([np.arange(k, k + n) for k, n in zip(d["kid"][inner], d["kids"][inner])])
            likely = np.argsort(-(data.at[kids] @ queries.at[a]), kind="stable")
            half = max(1, len(kids) // 8)
            todo += [(a, kids[likely[half:]]), (a, kids[likely[:half]])] if len(kids) > half else [(a, kids)]
        if leaf.any():
            own = np.concatenate([np.arange(f, n) for f, n in zip(d["first"][some[leaf]], d["last"][some[leaf]])])
            best.meet(rows, query_ids[rows], _dots(queries.points[rows], data.points[own]), data_ids[own])


def _together(rows, points, sizes, own, some, data: CoverTree, data_ids, best: Best) -> None:
    """The queries of a node whose children are leaves against data nodes: their bounds at once, each query's own (its radius is zero)."""
    todo = [some]
    while todo:
        some = todo.pop()
        most = _bound(points @ data.at[some].T, 0.0, sizes[:, None], data.radius[some], data.size[some])
        able = most >= best.worst[rows, None]
        near = able.any(axis=0)
        some, able, most = some[near], able[:, near], most[:, near]
        if not len(some):
            continue
        kids = data.nodes["kids"][some]
        inner = np.flatnonzero(kids > 0)
        if len(inner):
            below = np.concatenate([np.arange(k, k + n) for k, n in zip(data.nodes["kid"][some[inner]], kids[inner])])
            todo.append(below)
        leaf = np.flatnonzero(kids == 0)
        if len(leaf):
            first = leaf[np.argsort(-most[:, leaf].max(axis=0), kind="stable")]
            for at in range(0, len(first), SOME):  # the likeliest leaves raise the scores to beat for the others
                part = first[at : at + SOME]
                part = part[(most[:, part] >= best.worst[rows, None]).any(axis=0)]
                if not len(part):
                    continue
                asks = np.flatnonzero((most[:, part] >= best.worst[rows, None]).any(axis=1))
                held = np.concatenate([np.arange(f, n) for f, n in zip(data.nodes["first"][some[part]], data.nodes["last"][some[part]])])
                best.meet(rows[asks], own[asks], _dots(points[asks], data.points[held]), data_ids[held])


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, v``: floor(scale * x) as doubles, without the rows that take no part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and v is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("v") == (common.n if common else 0))

    def whole(x):
        y = x * float(scale)
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole numbers

    return rows.select("id", F.transform("v", whole).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.empty((0, 0))


def packed(points: np.ndarray) -> tuple[bytes, str]:
    """Whole numbers in the narrowest type that holds them."""
    most = np.abs(points).max(initial=0.0)
    kind = "<i1" if most < 2**7 else "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8"
    return points.astype(kind).tobytes(), kind


def unpacked(m: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(m, kind).reshape(n, -1).astype(np.float64)


def _pivots(rows: DataFrame) -> np.ndarray:
    """Farthest-first points of a bounded sample (the rows of least hash), as many as blocks are needed at most."""
    need = min(PIVOTS, max(1, -(-rows.count() // (DATA_BLOCK // 2))))
    got = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    points = np.array([r.v for r in got])
    if not len(points):
        return points
    picked, near = [0], _away(points, points[0])
    while len(picked) < min(need, len(points)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, _away(points, points[picked[-1]]))
    return points[picked]


_BLOCK = "pivot int, part int, ids binary, m binary, kind string, nodes binary, centre binary, radius double"


def _blocks(rows: DataFrame, pivots: np.ndarray, per: int, what: str) -> DataFrame:
    """``block`` and _BLOCK: rows packed by nearest pivot, about ``per`` to a block, each with its cover tree; ``block`` numbers them."""

    @lean
    def assign(batches):
        size = np.square(pivots).sum(axis=1)
        for batch in batches:
            v = _matrix(batch.column(1))
            near = size[None, :] - 2 * (v @ pivots.T) if len(v) else np.empty((0, 1))
            m = pa.array([x.tobytes() for x in v], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near.argmin(axis=1).astype(np.int32)), m], ["id", "pivot", "m"])

    dealt = written(rows.mapInArrow(assign, "id long, pivot int, m binary"), f"{what}-dealt")
    counts = {r.pivot: r["count"] for r in dealt.groupBy("pivot").count().collect()}  # a row for each pivot
    crowded = {p: -(-n // per) for p, n in counts.items() if n > per}
    parts = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in crowded.items() for x in pair]), F.col("pivot")), F.lit(1)) if crowded else F.lit(1)
    keyed = dealt.withColumn("part", F.pmod(F.xxhash64("id", "m"), parts).cast("int"))
    # copies of one row would fill one part: those of a part beyond its size are dealt once more
    again = {(r.pivot, r.part): -(-r["count"] // per) for r in keyed.groupBy("pivot", "part").count().where(F.col("count") > 2 * per).limit(PIVOTS).collect()}
    for (p, part), n in again.items():
        own = F.lit(1_000_000 + 1000 * part) + F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int")
        keyed = keyed.withColumn("part", F.when((F.col("pivot") == p) & (F.col("part") == part), own).otherwise(F.col("part")))

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        first = np.argsort(ids, kind="stable")
        raw = table.column("m").to_pylist()
        tree, order = CoverTree.grown(np.frombuffer(b"".join(raw[i] for i in first), np.float64).reshape(len(ids), -1))
        m, kind = packed(tree.points)
        row = [table.column("pivot")[0].as_py(), table.column("part")[0].as_py(), ids[first][order].tobytes(), m, kind, tree.nodes.tobytes(), tree.at[0].tobytes(), float(tree.radius[0])]
        names = [x.split()[0] for x in _BLOCK.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.binary(), pa.float64()]
        return pa.table({n: pa.array([x], k) for n, x, k in zip(names, row, kinds)})

    made = keyed.groupBy("pivot", "part").applyInArrow(pack, _BLOCK)
    return written(made.withColumn("block", F.struct("pivot", "part")), what)


class Trees:
    """The trees of the last few blocks that a task met."""

    def __init__(self):
        self.held: dict = {}

    def of(self, block, ids: bytes, m: bytes, kind: str, nodes: bytes) -> tuple[np.ndarray, CoverTree]:
        if block not in self.held:
            if len(self.held) >= 8:
                self.held.clear()
            names = np.frombuffer(ids, np.int64)
            self.held[block] = names, CoverTree(unpacked(m, kind, len(names)), np.frombuffer(nodes, CoverTree.FIELDS))
        return self.held[block]


def top_k(data: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best rows of ``data`` other than those with its own id."""
    rows = written(whole_vectors(data, id_col, vector_col, scale), "vectors")
    asking = written(whole_vectors(queries, id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v")), "asking")
    pivots = _pivots(rows)
    if not len(pivots):
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = _blocks(rows, pivots, DATA_BLOCK, "blocks")
    # pivots were chosen farthest first: the first of them are pivots for fewer blocks
    few = max(1, -(-asking.count() // (QUERY_BLOCK // 2)))
    asked = _blocks(asking.select("id", "v"), pivots[:few], QUERY_BLOCK, "queries")
    summary = written(blocks.select("block", "pivot", "part", "centre", "radius"), "summary")

    def far(batches):
        for batch in batches:
            out = [(p, float(_away(np.frombuffer(c, np.float64)[None], pivots[p])[0] + r)) for p, c, r in zip(*(batch.column(n).to_pylist() for n in ("pivot", "centre", "radius")))]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([x for _, x in out], pa.float64())], ["pivot", "far"])

    # for each pivot: how far its rows reach, and its first block
    reach = {r.pivot: (r.far, r.part) for r in summary.mapInArrow(far, "pivot int, far double").groupBy("pivot").agg(F.max("far").alias("far")).join(summary.groupBy("pivot").agg(F.min("part").alias("part")), "pivot").collect()}
    names = sorted(reach)
    middles, fars = pivots[names], np.array([reach[p][0] for p in names])
    sizes = np.sqrt(np.square(middles).sum(axis=1))
    shape = "pivot int, part int"

    def opening(batches):
        # the first block of the pivot with which the query block's middle scores most
        for batch in batches:
            best = [names[int((middles @ np.frombuffer(c, np.float64)).argmax())] for c in batch.column(1).to_pylist()]
            to = [pa.array(best, pa.int32()), pa.array([reach[p][1] for p in best], pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.StructArray.from_arrays(to, ["pivot", "part"])], ["asks", "block"])

    def meet(batches):
        trees, asking_trees = Trees(), Trees()
        for batch in batches:
            for at in range(len(batch)):
                row = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                own, q = asking_trees.of(json.dumps(row["asks"]), row["qids"], row["qm"], row["qkind"], row["qnodes"])
                ids, d = trees.of(json.dumps(row["block"]), row["ids"], row["m"], row["kind"], row["nodes"])
                best = Best(len(own), k, np.frombuffer(row["floor"], np.float64) if row["floor"] else np.full(len(own), -np.inf))
                search(q, own, d, ids, best)
                who = np.repeat(own, [len(x) for x in best.ids])
                values = [row["asks"], row["block"], best.worst.tobytes(), who.tobytes(), np.concatenate(best.ids).tobytes(), np.concatenate(best.score).tobytes()]
                kinds = [pa.struct([("pivot", pa.int32()), ("part", pa.int32())])] * 2 + [pa.binary()] * 4
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], ["asks", "block", "floor", "who", "found", "score"])

    own = asked.select(F.col("block").alias("asks"), F.col("ids").alias("qids"), F.col("m").alias("qm"), F.col("kind").alias("qkind"), F.col("nodes").alias("qnodes"))
    inner = blocks.select("block", "ids", "m", "kind", "nodes")
    met = f"asks struct<{shape.replace(' int', ':int')}>, block struct<{shape.replace(' int', ':int')}>, floor binary, who binary, found binary, score binary"
    opened = asked.select("block", "centre").mapInArrow(opening, "asks struct<pivot:int,part:int>, block struct<pivot:int,part:int>")
    first = written(opened.withColumn("floor", F.lit(None).cast("binary")).join(own, "asks").join(inner, "block").mapInArrow(lean(meet), met), "first")

    def able(batches):
        # the pivots with whose rows any query of the block can still reach its k-th score
        for batch in batches:
            for at in range(len(batch)):
                asks, centre, radius, floor = (batch.column(n)[at].as_py() for n in ("asks", "centre", "radius", "floor"))
                c, least = np.frombuffer(centre, np.float64), np.frombuffer(floor, np.float64).min()
                most = _bound(middles @ c, radius, np.sqrt(c @ c), fars, sizes)
                to = [names[i] for i in np.flatnonzero(most >= least)]
                if to:
                    told = [pa.array([v] * len(to), t) for v, t in ((asks, pa.struct([("pivot", pa.int32()), ("part", pa.int32())])), (centre, pa.binary()), (radius, pa.float64()), (float(least), pa.float64()))]
                    yield pa.RecordBatch.from_arrays([*told, pa.array(to, pa.int32())], ["asks", "c", "r", "least", "pivot"])

    def still(batches):
        # of those, the blocks whose own root can
        for batch in batches:
            c, p = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.float64).reshape(len(batch), -1) for n in ("c", "centre"))
            r, radius, least = (batch.column(n).to_numpy() for n in ("r", "radius", "least"))
            most = _bound((c * p).sum(axis=1), r, np.sqrt(np.square(c).sum(axis=1)), radius, np.sqrt(np.square(p).sum(axis=1)))
            yield batch.select(["asks", "block"]).filter(pa.array(most >= least))

    tops = asked.select(F.col("block").alias("asks"), "centre", "radius").join(first.select("asks", "floor"), "asks")
    near = tops.mapInArrow(able, "asks struct<pivot:int,part:int>, c binary, r double, least double, pivot int").join(summary, "pivot")
    pairs = near.mapInArrow(still, "asks struct<pivot:int,part:int>, block struct<pivot:int,part:int>")
    pairs = written(pairs.join(first.select("asks", "block"), ["asks", "block"], "left_anti"), "pairs")
    rest = pairs.join(first.select("asks", "floor"), "asks").join(own, "asks").join(inner, "block").mapInArrow(lean(meet), met)

    def given(batches):
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("who", "found", "score"))):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, np.int64)) for x in row], ["query_id", "vec_id", "score"])

    every = first.unionByName(rest).select("who", "found", "score").mapInArrow(given, "query_id long, vec_id long, score long")
    ranked = every.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


SQL = {
    "op6_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
}
