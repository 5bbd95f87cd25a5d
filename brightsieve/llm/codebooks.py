"""Vector code compression: product codebooks fitted by the filtering form of Lloyd's algorithm.

A vector's components become integers, floor(SCALE * x); it is cut into equal parts,
each of which has a codebook of its own. Every task cuts its vectors into
blocks of BLOCK rows and builds for each part position a kd-tree over the
block's parts, with the bounding box, the sum, the sum of squares and the count of each node (Kanungo et
al., "An efficient k-means clustering algorithm"). Blocks are written once and read by
each round. A round starts with all entries at each root. At a node, the entry
nearest to the box's middle, z, drops an entry y if even the corner of the
box that lies farthest towards y is nearer to z (or as near, where z comes
first); a node with one entry left is assigned as a whole from its sums, others
hand their entries on to their children, and only leaves look at single parts.
All nodes of a level, of all part positions, are done at once. A task hands on
one row of sums for each entry and component that it has used, so that what is shuffled and
what reaches the driver has the size of the codebooks.

All is exact: 64-bit integers where no square or sum can leave them, Python's
integers elsewhere; ties go to the lower entry, and means are floors. Defined
cases: null vectors, and vectors that are empty, hold null or non-finite components or have
another length than the most common one (the shorter at a tie) take no part; if that
length can't be cut into equal parts, ValueError; ids that are repeated count
each time, ties among the first ids go by the vector, null ids come last; fewer
vectors than entries give smaller codebooks; components beyond 2^160 and errors
beyond 64 bits are held at those bounds; null labels are one label; an empty table gives an empty result. Other columns
aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightsieve.llm.base import lean, new_path, remove, written

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Rows of a block, and parts of a leaf at most.
BLOCK, LEAF = 4_096, 16
#: Labels whose sums are broadcast at most; more are joined by shuffle, each dealt over SALT parts.
LABELS, SALT = 100_000, 16
_MOST, _HELD = (1 << 63) - 1, 2.0**160
_LIMB = 1 << 64
_FIELDS = ("ids", "labels", "size", "width", "kind", "points", "order", "low", "high", "total", "square")


def _safe(n: int, width: int, most: float) -> bool:
    """Whether sums of n squared distances between components of up to ``most`` stay within 64 bits."""
    return n * width * (2.0 * most + 2) ** 2 < 2.0**62


def _most(*arrays: np.ndarray) -> float:
    return max((float(max(abs(a.max()), abs(a.min()))) for a in arrays if a.size), default=0.0)


def _whole(points: np.ndarray, safe: bool) -> np.ndarray:
    """Whole-numbered floats as 64-bit or, beyond them, Python's integers."""
    return points.astype(np.int64) if safe else np.vectorize(int, otypes=[object])(points)


def shape(n: int) -> list[np.ndarray]:
    """The levels of a balanced tree over n places: each the nodes' bounds, in order; all leaves are on the last."""
    levels = [np.array([0, n])]
    while n and np.diff(levels[-1]).max() > LEAF:
        at = levels[-1]
        levels.append(np.sort(np.r_[at, (at[:-1] + at[1:]) // 2]))
    return levels


class Trees:
    """kd-trees over ``points`` (part position, row, component), all of one shape; ``order`` has the rows in tree order."""

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: tuple | None = None):
        self.points, self.order, self.levels = points, order, shape(points.shape[1])
        self.low, self.high, self.total, self.square = nodes or self._nodes()

    @classmethod
    def grown(cls, parts: np.ndarray) -> Trees:
        """``parts`` as floats: (row, part position, component)."""
        n, positions, width = parts.shape
        points = np.ascontiguousarray(parts.transpose(1, 0, 2))
        order = np.tile(np.arange(n), (positions, 1))
        for at, below in zip(shape(n), shape(n)[1:]):
            held = np.take_along_axis(points, order[:, :, None], 1)
            spread = np.maximum.reduceat(held, at[:-1], axis=1) - np.minimum.reduceat(held, at[:-1], axis=1)
            axis = np.repeat(spread.argmax(axis=2), np.diff(at), axis=1)
            value = np.take_along_axis(held, axis[:, :, None], 2)[:, :, 0]
            node = np.repeat(np.arange(len(at) - 1), np.diff(at))
            for p in range(positions):
                order[p] = order[p][np.lexsort((value[p], node))]
        held = np.take_along_axis(points, order[:, :, None], 1)
        return cls(_whole(held, _safe(n, width, _most(held))), order)

    def _nodes(self):
        """For each level: least and greatest components, sums and sums of squares."""
        out = []
        for at in self.levels:
            own = [f.reduceat(self.points, at[:-1], axis=1) for f in (np.minimum, np.maximum, np.add)]
            out.append((*own, np.add.reduceat((self.points * self.points).sum(axis=2), at[:-1], axis=1)))
        return tuple(list(x) for x in zip(*out))

    def filtered(self, books: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Whole assignments (part position, entry, first, last, sum, error) to ``books`` (part position, entry, component), several at a time."""
        positions, entries, _ = books.shape
        part, node = np.arange(positions), np.zeros(positions, np.int64)
        start = np.arange(positions) * entries  # where a node's entries begin in ``entry``
        entry = np.tile(np.arange(entries), positions)
        for depth, at in enumerate(self.levels):
            if not len(part):
                return
            sizes = np.diff(np.r_[start, len(entry)])
            own = np.repeat(np.arange(len(part)), sizes)
            low, high = self.low[depth][part, node], self.high[depth][part, node]
            z = books[part[own], entry]
            away = ((2 * z - (low + high)[own]) ** 2).sum(axis=1)
            near = np.lexsort((entry, away, own))[start]  # the first of each node's entries by distance, then number
            best, best_z = entry[near][own], z[near][own]
            corner = np.where(z > best_z, high[own], low[own])
            apart = ((z - corner) ** 2).sum(axis=1) - ((best_z - corner) ** 2).sum(axis=1)
            stays = (apart < 0) | ((apart == 0) & (entry <= best))
            left = np.add.reduceat(stays.astype(np.int64), start)
            done = left == 1
            if done.any():
                p, k, c = part[done], node[done], best[start][done]
                total, square = self.total[depth][p, k], self.square[depth][p, k]
                z1, n = books[p, c], at[k + 1] - at[k]
                yield p, c, at[k], at[k + 1], total, square - 2 * (z1 * total).sum(axis=1) + n * (z1 * z1).sum(axis=1)
            open_ = ~done
            entry, part, node, left = entry[stays & open_[own]], part[open_], node[open_], left[open_]
            if depth + 1 < len(self.levels):
                # both children have the entries that are left; children lie side by side
                start = np.cumsum(np.repeat(left, 2)) - np.repeat(left, 2)
                first = np.repeat(np.cumsum(left) - left, 2)
                entry = entry[_ranges(first, np.repeat(left, 2))]
                part, node = np.repeat(part, 2), np.repeat(2 * node, 2) + np.tile([0, 1], len(node))
            elif len(part):
                yield from self._leaves(books, part, at[node], at[node + 1], entry, left)

    def _leaves(self, books, part, first, last, entry, left):
        """Each part of the leaves against what entries are left there."""
        n = last - first
        row, p, k = _ranges(first, n), np.repeat(part, n), np.repeat(left, n)
        entry = entry[_ranges(np.repeat(np.cumsum(left) - left, n), k)]
        own = np.repeat(np.arange(len(row)), k)
        away = ((self.points[p[own], row[own]] - books[p[own], entry]) ** 2).sum(axis=1)
        near = np.lexsort((entry, away, own))[np.cumsum(k) - k]
        yield p, entry[near], row, row + 1, self.points[p, row], away[near]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _packed(trees: Trees) -> tuple:
    """kind, points, order and, where they are 64-bit integers, the nodes: as bytes."""
    order = trees.order.astype("<u2" if trees.order.shape[1] <= 1 << 16 else "<u4")
    if trees.points.dtype == object:
        return "<f8", trees.points.astype("<f8").tobytes(), order.tobytes(), None, None, None, None
    most = _most(trees.points)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    flat = [np.concatenate(x, axis=1) for x in (trees.low, trees.high, trees.total, trees.square)]
    return kind, trees.points.astype(kind).tobytes(), order.tobytes(), flat[0].astype(kind).tobytes(), flat[1].astype(kind).tobytes(), flat[2].astype("<i8").tobytes(), flat[3].astype("<i8").tobytes()


def _unpacked(row: dict, positions: int, books: np.ndarray) -> Trees:
    """A block's trees in numbers that hold its distances to ``books``."""
    n, width, kind = row["size"], row["width"], row["kind"]
    points = np.frombuffer(row["points"], kind).reshape(positions, n, width)
    order = np.frombuffer(row["order"], "<u2" if n <= 1 << 16 else "<u4").reshape(positions, n).astype(np.int64)
    safe = kind != "<f8" and _safe(n, width, max(_most(points), _most(books)))
    if not safe:
        return Trees(_whole(points, False), order)
    cut = np.cumsum([len(x) - 1 for x in shape(n)])[:-1]
    kinds = {"low": kind, "high": kind, "total": "<i8", "square": "<i8"}
    nodes = tuple(np.split(np.frombuffer(row[f], k).astype(np.int64).reshape(positions, -1, *([width] if f != "square" else [])), cut, axis=1) for f, k in kinds.items())
    return Trees(points.astype(np.int64), order, nodes)


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(len(batch)):
        yield {name: batch.column(place)[at].as_py() if name not in ("ids", "labels") else batch.column(place)[at].values for place, name in enumerate(_FIELDS)}


def vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """``id, label, v`` of the rows that take part; v is an array of doubles."""
    rows = df.select(F.col(id_col).alias("id"), (F.col(label_col) if label_col else F.lit(None).cast("int")).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.where((F.size("v") > 0) & ~bad)


def _length(rows: DataFrame) -> int | None:
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return most.n if most else None


def blocks(rows: DataFrame, length: int, parts: int = PARTS, scale: float = SCALE) -> DataFrame:
    """A row for each block of up to BLOCK vectors of that length: ids, labels and trees."""
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        some = pa.Table.from_batches(held).combine_chunks()
        v = some.column(2).chunk(0)
        numbers = np.clip(np.floor(v.values.to_numpy(zero_copy_only=False)[v.offset * length :][: len(v) * length] * float(scale)), -_HELD, _HELD)
        trees = Trees.grown(numbers.reshape(len(v), parts, length // parts))
        values = [some.column(0).to_pylist(), some.column(1).to_pylist(), len(v), length // parts, *_packed(trees)]
        types = [pa.list_(some.schema.field(0).type), pa.list_(some.schema.field(1).type), pa.int32(), pa.int32(), pa.string(), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, types)], list(_FIELDS))

    @lean
    def run(batches):
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < len(batch):
                some = batch.slice(at, BLOCK - n)
                held.append(some)
                at, n = at + len(some), n + len(some)
                if n == BLOCK:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    kinds = dict(rows.dtypes)
    schema = f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, size int, width int, kind string, points binary, `order` binary, low binary, high binary, total binary, square binary"
    return rows.where(F.size("v") == length).mapInArrow(run, schema)


def first_books(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, scale: float = SCALE) -> np.ndarray:
    """The parts of the vectors with the least ids (``entries`` of them): (part position, entry, component), Python's integers."""
    first = rows.where(F.size("v") == length).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    numbers = np.clip(np.floor(np.array([r.v for r in first], float).reshape(len(first), length) * float(scale)), -_HELD, _HELD)
    return _whole(numbers, False).reshape(len(first), parts, length // parts).transpose(1, 0, 2)


def _numbers(books: np.ndarray, trees: Trees) -> np.ndarray:
    return books if trees.points.dtype == object else books.astype(np.int64)


def improved(held: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: ``books`` with each entry that is used replaced by the floor of its parts' mean."""
    positions, entries, width = books.shape

    @lean
    def run(batches):
        count = np.zeros((positions, entries), np.int64)
        total = np.zeros((positions, entries, width), object)
        for row in (r for batch in batches for r in _each(batch)):
            trees = _unpacked(row, positions, books)
            own = np.zeros((positions, entries, width), trees.points.dtype)
            for p, c, first, last, sums, _ in trees.filtered(_numbers(books, trees)):
                np.add.at(own, (p, c), sums)
                np.add.at(count, (p, c), last - first)
            total += own
        at = np.nonzero(count)
        if len(at[0]):
            flat = [int(x) for x in total[at].reshape(-1)]
            columns = [np.repeat(at[0], width), np.repeat(at[1], width), np.tile(np.arange(width), len(at[0])), np.repeat(count[at], width)]
            limbs = [pa.array([Decimal(x) for x in limb], pa.decimal128(38, 0)) for limb in ([x // _LIMB for x in flat], [x % _LIMB for x in flat])]
            yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int64)) for c in columns], *limbs], ["part", "entry", "place", "n", "upper", "lower"])

    sums = held.mapInArrow(run, "part long, entry long, place long, n long, upper decimal(38,0), lower decimal(38,0)")
    out = books.copy()
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("upper").alias("upper"), F.sum("lower").alias("lower")).collect():
        out[r.part, r.entry, r.place] = (int(r.upper) * _LIMB + int(r.lower)) // r.n
    return out


def coded(held: DataFrame, books: np.ndarray) -> DataFrame:
    """``id, label, code, error`` of every vector of the blocks."""
    positions, entries, _ = books.shape
    digits = np.array([f"{i:02x}" for i in range(entries)])

    @lean
    def run(batches):
        for row in (r for batch in batches for r in _each(batch)):
            trees = _unpacked(row, positions, books)
            code = np.zeros((positions, row["size"]), np.int64)
            error = np.zeros(row["size"], trees.points.dtype)
            for p, c, first, last, _, _ in trees.filtered(_numbers(books, trees)):
                n = last - first
                code[np.repeat(p, n), trees.order[np.repeat(p, n), _ranges(first, n)]] = np.repeat(c, n)
            own = _numbers(books, trees)
            for p in range(positions):
                error[trees.order[p]] += ((trees.points[p] - own[p][code[p][trees.order[p]]]) ** 2).sum(axis=1)
            names = ["".join(x) for x in digits[code.T]]
            yield pa.RecordBatch.from_arrays([row["ids"], row["labels"], pa.array(names), pa.array([min(int(e), _MOST) for e in error], pa.int64())], ["id", "label", "code", "error"])

    kinds = {f.name: f.dataType.elementType.simpleString() for f in held.schema.fields[:2]}
    return held.mapInArrow(run, f"id {kinds['ids']}, label {kinds['labels']}, code string, error long")


def restored(codes: DataFrame, books: np.ndarray, scale: float = SCALE) -> DataFrame:
    """``id, vector``: what the codes stand for, in the vectors' own scale."""
    entries = [[[int(x) for x in e] for e in part] for part in books]

    @lean
    def run(batches):
        for batch in batches:
            made = [[x / scale for p, part in enumerate(entries) for x in part[int(c[2 * p : 2 * p + 2], 16)]] for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.float64()))], ["id", "vector"])

    return codes.select("id", "code").mapInArrow(run, f"id {dict(codes.dtypes)['id']}, vector array<double>")


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label") -> tuple[DataFrame, np.ndarray]:
    """The codes (``id, label, code, error``, written) of all vectors, and the codebooks fitted to all of them in ``rounds`` rounds."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    spark, rows = df.sparkSession, vectors(df, id_col, vector_col, label_col)
    length = _length(rows)
    if length is None:
        return spark.createDataFrame([], f"id {dict(rows.dtypes)['id']}, label {dict(rows.dtypes)['label']}, code string, error long"), np.zeros((parts, 0, 0), object)
    made = blocks(rows, length, parts, scale)
    path = new_path(spark, "trees")
    made.write.parquet(path)
    held = spark.read.schema(made.schema).parquet(path)
    books = first_books(rows, length, parts, entries, scale)
    for _ in range(rounds):
        books = improved(held, books)
    codes = written(coded(held, books), "codes")
    remove(spark, path)
    return codes, books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with the sum of the errors of all rows of equal label, nulls together."""
    sums = codes.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    if sums.count() <= LABELS:
        few = F.broadcast(sums.withColumnRenamed("label", "own"))
        return codes.join(few, F.col("label").eqNullSafe(F.col("own"))).drop("own")
    dealt = sums.withColumnRenamed("label", "own").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    part = codes.withColumn("part", F.pmod(F.xxhash64("id", "code"), F.lit(SALT)).cast("int"))
    return part.join(dealt, F.col("label").eqNullSafe(F.col("own")) & (F.col("part") == F.col("salt"))).drop("own", "part", "salt")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(x) for x in books.reshape(-1)).encode()).hexdigest()


def op13_codes(spark, sf_dir: str) -> DataFrame:
    codes, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_label_error(codes).select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """Lloyd's rounds as common table expressions: b0 .. b2 are codebooks, a0 .. a2 the nearest entries of every part."""
    out = [f"""
v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, label, part, list_slice(w, part * (len(w) // {PARTS}) + 1, (part + 1) * (len(w) // {PARTS})) AS u FROM v, range({PARTS}) r(part)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {ENTRIES}),
b0 AS (SELECT part, entry, u FROM p JOIN f USING (vec_id))"""]
    for k in range(ROUNDS + 1):
        out.append(f"""
a{k} AS (SELECT vec_id, label, part, u, min((d, entry)) AS near FROM (SELECT p.*, b.entry, list_sum(list_transform(list_zip(p.u, b.u), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d
  FROM p JOIN b{k} b USING (part)) GROUP BY vec_id, label, part, u)""")
        if k < ROUNDS:
            out.append(f"""
m{k} AS (SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) - CASE WHEN CAST(floor(s / n) AS BIGINT) * n > s THEN 1 ELSE 0 END ORDER BY place) AS u
  FROM (SELECT part, near[2] AS entry, place, sum(u[place]) AS s, count(*) AS n FROM a{k}, range(1, len(u) + 1) r(place) GROUP BY 1, 2, 3) GROUP BY part, entry),
b{k + 1} AS (SELECT part, entry, coalesce(m.u, b.u) AS u FROM b{k} b LEFT JOIN m{k} m USING (part, entry))""")
    return "WITH" + ",".join(out) + f""",
c AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', near[2]), '' ORDER BY part) AS code, CAST(sum(near[1]) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(u, ','), ',' ORDER BY part, entry)) FROM b{ROUNDS}) AS codebooks_sha256 FROM c"""


SQL = {"op13_codes": _sql()}
