import random

import pytest

from brightsieve.llm import topk as T


def floor64(x):
    return int(__import__("math").floor(64 * x))


def brute(rows, queries, k):
    import math

    ok = [(i, [floor64(x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in [(i, v) for i, v in ok if queries(i)]:
        s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("block", [2048, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(T, "DATA_BLOCK", block)
    monkeypatch.setattr(T, "QUERY_BLOCK", 5)
    monkeypatch.setattr(T, "LEAF", 8)
    rng = random.Random(block)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [rng.gauss(c, 0.1) for c in rng.choice(centres)]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2001, []), (2002, [1.0, None] * 3), (2003, [float("nan")] * 6), (2004, [float("inf")] * 6), (None, rows[0][1]), (2005, [1e15] * 6)]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, label int, id int")
    got = T.top_k(df, df.where("vec_id % 20 = 0"), 20)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == [(q, r, i, max(min(s, 2**63 - 1), -(2**63))) for q, r, i, s in brute(rows, lambda i: i % 20 == 0, 20)]


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (20, [-1.0])], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in T.top_k(df, df.where("vec_id % 20 = 0"), 20).collect())
    assert got == [(0, 1, 1, 8192), (0, 2, 20, -4096), (20, 1, 0, -4096), (20, 2, 1, -8192)]
    assert T.top_k(df.where("false"), df, 5).count() == 0 and T.top_k(df, df.where("false"), 5).count() == 0


def shares(vectors, queries, k):
    """Scores computed by the traversal over all block pairs after the root bound, as a share of all pairs, and the results."""
    import numpy as np

    def blocks(points, ids, per):
        # as the operator deals them: by the nearest of farthest-first pivots
        pivots, near = [0], T._away(points, points[0])
        while len(pivots) < -(-len(vectors) // T.DATA_BLOCK) * 2 and near.max() > 0:
            pivots.append(int(near.argmax()))
            near = np.minimum(near, T._away(points, points[pivots[-1]]))
        owner = np.argmin([T._away(points, points[p]) for p in pivots], axis=0)
        for p in range(len(pivots)):
            rows = np.flatnonzero(owner == p)
            for at in range(0, len(rows), per):
                tree, order = T.CoverTree.grown(points[rows[at : at + per]])
                yield tree, ids[rows[at : at + per]][order]

    ids = np.arange(len(vectors))
    data = list(blocks(vectors, ids, T.DATA_BLOCK))
    scored, found = 0, {}
    for q, own in blocks(vectors[queries], ids[queries], T.QUERY_BLOCK):
        best = T.Best(len(own), k, np.full(len(own), -np.inf))
        for d, names in sorted(data, key=lambda x: -float(x[0].at[0] @ q.at[0])):
            T.search(q, own, d, names, best)
        scored += best.scored
        found.update({int(i): list(zip((-best.score[j]).tolist(), best.ids[j].tolist())) for j, i in enumerate(own)})
    return scored / (len(vectors) * len(queries)), found


def test_cover_tree_holds_its_laws():
    import numpy as np

    rng = np.random.default_rng(2)
    for points in (np.floor(rng.normal(0, 50, (700, 5))), np.zeros((90, 3)), np.floor(rng.normal(0, 3, (400, 2)))):
        tree, order = T.CoverTree.grown(points)
        assert sorted(order.tolist()) == list(range(len(points))) and (points[order] == tree.points).all()
        for n in tree.nodes:
            own = tree.points[n["first"] : n["last"]]
            assert abs(T._away(own, tree.points[n["point"]]).max() - n["radius"]) < 1e-9
            kids = tree.nodes[n["kid"] : n["kid"] + n["kids"]]
            if len(kids):
                assert kids["first"][0] == n["first"] and kids["last"][-1] == n["last"] and (kids["first"][1:] == kids["last"][:-1]).all()
                assert kids["point"][0] == n["point"] and kids["radius"].max() <= n["radius"] / 1.9 + n["radius"] * 0.5
                at = tree.points[kids["point"]]
                apart = np.sqrt(np.square(at[:, None] - at[None]).sum(axis=2))[np.triu_indices(len(at), 1)]
                assert len(apart) == 0 or apart.min() > kids["radius"].max() - 1e-9  # separation: no child covers another's point


def test_clustered_vectors_are_pruned(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(1)
    middles = rng.normal(0, 1, (40, 64)) * 40
    vectors = np.floor(middles[rng.integers(0, 40, 8000)] + rng.normal(0, 1.5, (8000, 64)))
    share, found = shares(vectors, np.arange(0, 8000, 20), 20)
    assert share < 0.12
    for i in range(0, 8000, 1000):
        s = vectors @ vectors[i]
        want = sorted((-int(x), j) for j, x in enumerate(s) if j != i)[:20]
        assert found[i] == want


def test_vectors_of_the_table(sf_dir):
    """The share of the scores that the traversal computes on the query's own vectors."""
    import duckdb
    import numpy as np

    v = np.floor(64 * np.array(duckdb.sql("SELECT embedding FROM '/root/testdata/sf0.1/embeddings.parquet' ORDER BY vec_id").fetchnumpy()["embedding"].tolist(), np.float64))
    share, found = shares(v, np.arange(0, len(v), 20), 20)
    s = v @ v[0]
    assert share < 0.25 and found[0] == sorted((-int(x), j) for j, x in enumerate(s) if j)[:20]
