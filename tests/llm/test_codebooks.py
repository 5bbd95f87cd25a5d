import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightsieve.llm import codebooks as C


def plain(rows, parts, entries, rounds, scale=256):
    """(id, vector, label): codes, errors, label errors and codebooks by Python's integers, one part at a time."""
    held = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(v) for _, v, _ in held]
    if not held:
        return [], []
    n = min(set(lengths), key=lambda k: (-lengths.count(k), k))
    held = [h for h in held if len(h[1]) == n]
    w = n // parts
    cut = lambda v, p: tuple(v[p * w : (p + 1) * w])
    first = sorted(held, key=lambda h: (h[0] is None, h[0] or 0, h[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(u, book):
        return min((sum((a - b) ** 2 for a, b in zip(u, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in held:
                groups.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            for k, members in groups.items():
                books[p][k] = tuple(sum(x) // len(members) for x in zip(*members))
    out = []
    for i, v, label in held:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    sums = {}
    for _, _, e, label in out:
        sums[label] = sums.get(label, 0) + e
    return [(*r[:3], sums[r[3]]) for r in out], books


def got(df, **k):
    codes, books = C.compress(df, **k)
    return sorted((r.id is None, r.id or 0, r.code, r.error, r.label_error) for r in C.with_label_error(codes).collect()), books.tolist()


def check(spark, rows, parts, entries, rounds):
    df = spark.createDataFrame([(i, v, label, 0, "x", 1) for i, v, label in rows], "vec_id long, embedding array<double>, label int, part int, code string, own int").repartition(3)
    found, books = got(df, parts=parts, entries=entries, rounds=rounds)
    want, made = plain(rows, parts, entries, rounds)
    assert found == sorted((r[0] is None, r[0] or 0, *r[1:]) for r in want)
    assert books == [[list(e) for e in part] for part in made]


@pytest.mark.parametrize("seed", range(3))
def test_as_by_hand(spark, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2 * seed) for c in rng.choice(centres)], rng.choice([0, 1, None])) for i in range(300)]
    if seed == 2:  # ties: few distinct whole numbers
        rows = [(i, [round(x) / 128 for x in v], label) for i, v, label in rows]
    check(spark, rows, 4, 16, 2)


def test_defined_cases(spark):
    rng = random.Random(7)
    v = lambda: [rng.uniform(-1, 1) for _ in range(4)]
    nan, inf = float("nan"), float("inf")
    rows = [(i, v(), i % 3) for i in range(40)] + [(3, v(), None), (3, v(), None), (None, v(), 1), (50, None, 1), (51, [1.0, None, 2.0, 3.0], 1), (52, [nan, 0.0, 0.0, 0.0], 1), (53, [0.0, inf, 0.0, 0.0], 1), (54, [], 1), (55, [1.0, 2.0], 1)]
    rows += [(60, [0.5, 0.5, 0.5, 0.5], None)] * 30
    check(spark, rows, 2, 8, 3)
    check(spark, rows[:3], 4, 8, 2)  # fewer vectors than entries
    with pytest.raises(ValueError):
        C.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), parts=3)
    with pytest.raises(ValueError):
        C.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), parts=2, entries=257)
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert C.with_label_error(C.compress(nothing)[0]).count() == 0


def test_numbers_beyond_64_bits_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.choice([0, 5, 12, 20, 38]) for _ in range(4)], None) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(2)
    codes, books = C.compress(df, parts=2, entries=8, rounds=2)
    want, made = plain(rows, 2, 8, 2)
    assert books.tolist() == [[list(e) for e in part] for part in made]
    assert sorted((r.id, r.code, r.error) for r in codes.collect()) == [(i, c, min(e, (1 << 63) - 1)) for i, c, e, _ in want]
    assert {r.label_error for r in C.with_label_error(codes).collect()} == {(1 << 63) - 1}


def test_filtering_assigns_as_all_distances_do_and_looks_at_fewer():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 100, (40, 3))
    parts = np.floor(centres[rng.integers(0, 40, (3_000, 2))] + rng.normal(0, 4, (3_000, 2, 3)))
    trees = C.Trees.grown(parts)
    books = np.floor(np.stack([centres + rng.normal(0, 3, centres.shape), rng.normal(0, 100, centres.shape)])).astype(np.int64)
    whole, code, error = 0, np.full((2, 3_000), -1), np.zeros((2,), np.int64)
    for p, c, first, last, sums, own in trees.filtered(books):
        for k in range(len(p)):
            code[p[k], trees.order[p[k], first[k] : last[k]]] = c[k]
            assert (trees.points[p[k], first[k] : last[k]].sum(axis=0) == sums[k]).all()
        np.add.at(error, p, own)
        whole += int((last - first > 1).sum())
    away = ((parts.astype(np.int64).transpose(1, 0, 2)[:, :, None] - books[:, None]) ** 2).sum(axis=3)
    assert (code == away.argmin(axis=2)).all() and (error == away.min(axis=2).sum(axis=1)).all()
    assert whole > 50  # whole subtrees


def test_packed_trees_are_the_same(monkeypatch):
    rng = np.random.default_rng(2)
    for size in (3, 300, 200_000, 1e9, 1e25):
        trees = C.Trees.grown(np.floor(rng.normal(0, size, (77, 2, 3))))
        row = dict(zip(C._FIELDS, (None, None, 77, 3, *C._packed(trees))))
        again = C._unpacked(row, 2, np.zeros((2, 4, 3), object))
        assert (again.points == trees.points).all() and (again.order == trees.order).all()
        for x, y in ((trees.low, again.low), (trees.high, again.high), (trees.total, again.total), (trees.square, again.square)):
            assert len(x) == len(y) and all((p == q).all() for p, q in zip(x, y))


def test_labels_by_shuffle(spark, monkeypatch):
    codes = spark.range(500).selectExpr("id", "CAST(IF(id % 7 = 0, NULL, id % 5) AS INT) AS label", "'00' AS code", "id AS error")
    want = sorted(map(tuple, C.with_label_error(codes).collect()))
    monkeypatch.setattr(C, "LABELS", 1)
    assert sorted(map(tuple, C.with_label_error(codes).collect())) == want and len(want) == 500


def test_restored_vectors_are_near(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    codes, books = C.compress(df)
    near = C.restored(codes, books).join(df, F.col("id") == F.col("vec_id")).select("vector", "embedding").collect()
    lost = np.mean([np.square(np.array(r.vector) - np.array(r.embedding)).sum() for r in near])
    assert len(near) == df.count() and lost < 0.5 * np.mean([np.square(r.embedding).sum() for r in near])
