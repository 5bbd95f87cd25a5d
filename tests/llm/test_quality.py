import numpy as np
import pytest

from brightsieve.llm import quality as Q


def test_indicators():
    texts = [b"", b"ab", "Été, 12 été".encode(), b"x x x x", b"ab", b"q" * 3_000_000]
    rows = list(Q.indicators(texts))
    assert len(rows) == 6 and not len(rows[0]) and np.array_equal(rows[1], rows[4])
    assert set(range(3)) <= set(rows[3].tolist()) and 0 not in rows[2]
    # a text's indicators don't depend on its neighbours
    assert all(np.array_equal(r, next(Q.indicators([t]))) for t, r in zip(texts, rows))


def test_descent_separates():
    rng = np.random.default_rng(0)
    good = rng.integers(0, 2, 400)
    rows = [np.unique(np.r_[rng.integers(100, 5000, 30), 10 + g]).astype(np.int32) for g in good]
    model = Q.fit(rows, good)
    m = [Q.margin(r, model["weights"] * model["ratio"], np.square(model["ratio"]), model["bias"]) for r in rows]
    assert ((np.array(m) > 0) == (good == 1)).mean() > 0.99 and model["a"] > 0


def test_held_out(spark, sf_dir):
    rows = Q.op1_quality(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 1000 and np.mean([p == y for p, y in held]) > 0.95


@pytest.mark.parametrize("labels, score", [([], 1.0), ([(1, 1)], 1.0), ([(1, 0), (None, 1), (5, None)], 0.0)])
def test_edges(spark, docs, nothing, labels, score):
    known = spark.createDataFrame([(i, y, "t") for i, y in labels], "doc_id long, quality int, text string")
    model = Q.train(docs, known)
    assert {r.score for r in Q.score(docs, model).collect()} == {score} and Q.score(nothing, model).count() == 0
    kept = Q.keep_scored(docs, model)
    assert kept.columns == docs.columns and kept.count() == (docs.count() if score else 0)


def test_all_rows_scored(spark, docs, texts):
    known = spark.createDataFrame([(i, i % 2) for i in range(1, 13)] * 2, "doc_id long, quality int")
    rows = Q.score(docs, Q.train(docs, known)).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1


def test_ratio_and_descent_against_a_plain_solver(monkeypatch):
    monkeypatch.setattr(Q, "EPOCHS", 3000)
    rng = np.random.default_rng(3)
    good = rng.integers(0, 2, 60)
    rows = [np.unique(np.r_[rng.integers(0, 40, 8), 50 + g * (rng.random() < 0.7)]).astype(np.int32) for g in good]
    ratio = Q._ratio(rows, good)
    counts = [[1 + sum(b in r for r, g in zip(rows, good) if g == k) for b in range(60)] for k in (0, 1)]
    rest = (1 << Q.LOG_BUCKETS) - 60
    for b in range(60):
        want = np.log(counts[1][b] / (sum(counts[1]) + rest)) - np.log(counts[0][b] / (sum(counts[0]) + rest))
        assert abs(ratio[b] - want) < 1e-9
    w, bias = Q._descend(rows, good, ratio)
    x = np.zeros((60, 61))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r]
        x[i] /= max(np.sqrt(x[i] @ x[i]), 1e-9)
    x[:, 60] = 1  # the bias
    y = np.where(good == 1, 1.0, -1.0)
    cost = 0.5 / np.where(good == 1, good.mean(), 1 - good.mean())
    primal = lambda v: v @ v / 2 + (cost * np.maximum(0, 1 - y * (x @ v))).sum()
    # projected gradient ascent on the dual: slow, plain, and with a gap that tells how far it is from the best
    q = (y[:, None] * x) @ (y[:, None] * x).T
    a = np.zeros(60)
    for _ in range(60_000):
        a = np.clip(a + (1 - q @ a) / np.linalg.norm(q, 2), 0, cost)
    best = primal((a * y) @ x)
    assert best - (a.sum() - a @ q @ a / 2) < 1e-3 * best
    assert abs(primal(np.r_[w[:60], bias]) - best) < 2e-3 * best


def test_repeated_documents_and_long_texts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(Q, "SAMPLE_BYTES", 200_000)
    rng = np.random.default_rng(0)
    long = " ".join(f"w{i}" for i in rng.integers(0, 10**6, 150_000))
    docs = [(1, "good text here")] * 40 + [(2, "BAD BAD BAD")] * 40 + [(3, long), (4, "good words here"), (5, "BAD BAD")]
    known = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 1), (5, 0)] * 3, "doc_id long, quality int")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = Q.train(df, known)
    got = Q.score(df, model).collect()
    assert len(got) == len(docs) and all(len({r.score for r in got if r.doc_id == i}) == 1 for i in range(1, 6))
