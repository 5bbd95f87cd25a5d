"""Quality classifier: naive Bayes support vectors (Wang and Manning).

Indicators of byte 4-grams, tokens and token pairs, hashed into 2^18 buckets,
are scaled by the log ratio of their counts in the two classes, brought to
unit length, and a linear hinge-loss model is fitted to them by dual coordinate
descent. Platt's sigmoid, fitted to margins of rows that the model did not see,
turns margins into probabilities.

The fit takes at most SAMPLE_ROWS labels (those with the least hash of their
id) and, in that order, as many of their texts as have SAMPLE_BYTES of
indicators, in one task; every text is scored whole, in the task that reads it.
The same rows give the same model.

Defined cases: null and empty texts have no indicators and get the score of
the bias alone, as any text does if the labels lack a class (then 1.0 where all
labels are 1 or there are none, else 0.0); rows with a null id or label don't
teach; a repeated label teaches once, and of documents that share an id one
teaches (with the least indicators); an empty table gives an empty result;
repeated documents get equal scores, so ties stay ties; extra columns aren't
read.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightsieve.llm.base import lean, slices, texts_of

SAMPLE_ROWS, SAMPLE_BYTES = 8_000, 32 << 20
LOG_BUCKETS = 18
#: Bytes of text whose indicators are made at once.
SLICE = 1 << 19
EPOCHS, COST = 10, 1.0
PREDICT_AT = 0.3

_CLASS = np.ones(256, np.uint8)
_CLASS[:128] = 3
for _chars, _kind in ((b" \t\n\r\x0b\x0c", 0), (bytes(range(65, 91)) + bytes(range(97, 123)), 1), (b"0123456789", 2)):
    _CLASS[list(_chars)] = _kind
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
#: Buckets 0 to 6: a token 2 to 8 times in a row.
_RUNS = 7


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h * _SPREAD) >> np.uint64(64 - LOG_BUCKETS)).astype(np.int32)


def indicators(texts: list[bytes]):
    """The distinct buckets of each text, in order, as an int32 array."""
    seen = np.zeros(1 << LOG_BUCKETS, bool)
    for at in _slices(texts):
        group = texts[at[0] : at[1]]
        raw = np.frombuffer(b"\n".join(group) + b"\n", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in group]) - 1
        starts = np.r_[0, ends[:-1] + 1]
        kind = _CLASS[raw]
        with np.errstate(over="ignore"):
            edge = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1], True])
            first, last = edge[:-1], edge[1:]
            word = kind[first] != 0
            first, last = first[word], last[word]
            total = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw)))]
            token = (total[last] - total[first]) * _powers(_INVERSE, len(raw) + 1)[first]
            pair = token[:-1] * _BASE + (token[1:] ^ (token[1:] >> np.uint64(31)))
            same = token[:-1] == token[1:]
            one, two = _bucket(token ^ (token >> np.uint64(29))), _bucket(pair ^ (pair >> np.uint64(29)))
            wide = raw.astype(np.uint64)
            grams = _bucket((wide[:-3] | wide[1:-2] << np.uint64(8) | wide[2:-1] << np.uint64(16) | wide[3:] << np.uint64(24)) + np.uint64(1)) if len(raw) > 3 else np.empty(0, np.int32)
        lo, hi = np.searchsorted(first, starts), np.searchsorted(first, ends)
        for s, e, a, b in zip(starts, ends, lo, hi):
            seen[grams[s : max(s, e - 3)]] = True
            seen[one[a:b]] = True
            if b - a > 1:
                seen[two[a : b - 1]] = True
                again = same[a : b - 1]
                for k in range(_RUNS):
                    if not again.any():
                        break
                    seen[k] = True
                    again = again[:-1] & same[a + k + 1 : b - 1]
            found = np.flatnonzero(seen).astype(np.int32)
            seen[found] = False
            yield found


def _slices(texts: list[bytes]):
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= SLICE:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _ratio(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """The log ratio of the classes' smoothed indicator counts."""
    counts = np.ones((2, 1 << LOG_BUCKETS))
    for row, label in zip(rows, good.tolist()):
        counts[label][row] += 1  # a row's buckets are distinct
    shares = np.log(counts / counts.sum(axis=1, keepdims=True))
    return shares[1] - shares[0]


def _descend(rows, good, ratio, seed=0):
    """Dual coordinate descent (Hsieh et al.) for the L2-regularised hinge loss; the last weight is the bias.

    Each dual variable lies between 0 and its class's cost, which makes up for unequal classes.
    """
    y = np.where(good == 1, 1.0, -1.0)
    share = np.array([max((good == 0).sum(), 1), max((good == 1).sum(), 1)]) / len(good)
    cost = COST * 0.5 / np.where(good == 1, share[1], share[0])
    ratio = ratio.astype(np.float32)
    length = [max(float(np.sqrt(np.square(ratio[r]).sum())), 1e-9) for r in rows]
    w, alpha, bias = np.zeros(1 << LOG_BUCKETS, np.float32), np.zeros(len(rows)), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            x = ratio[r] / np.float32(length[i])
            slope = y[i] * (float(w[r] @ x) + bias) - 1
            step = min(max(alpha[i] - slope / (float(x @ x) + 1), 0.0), cost[i]) - alpha[i]
            if step:
                alpha[i] += step
                w[r] += np.float32(step * y[i]) * x
                bias += step * y[i]
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return w, bias


def margin(row: np.ndarray, scaled: np.ndarray, squares: np.ndarray, bias: float) -> float:
    """``scaled`` is weights times ratio, ``squares`` the ratio squared."""
    return float(scaled[row].sum(dtype=np.float64) / max(np.sqrt(squares[row].sum(dtype=np.float64)), 1e-9) + bias)


def scores(texts: list[bytes], model: dict) -> list[float]:
    """The probability of label 1 for each text."""
    if model["only"] is not None:
        return [model["only"]] * len(texts)
    scaled, squares = model["weights"] * model["ratio"], np.square(model["ratio"])
    logits = np.array([model["a"] * margin(r, scaled, squares, model["bias"]) + model["b"] for r in indicators(texts)])
    return (1 / (1 + np.exp(-np.clip(logits, -30, 30)))).tolist()


def _platt(m: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid by Newton steps on smoothed targets."""
    n1, n0 = (good == 1).sum(), (good == 0).sum()
    t = np.where(good == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, np.log((n1 + 1) / (n0 + 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g, h = p - t, np.maximum(p * (1 - p), 1e-9)
        j = np.array([[np.sum(h * m * m) + 1e-6, np.sum(h * m)], [np.sum(h * m), np.sum(h) + 1e-6]])
        step = np.linalg.solve(j, [np.sum(g * m), np.sum(g)])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], good: np.ndarray) -> dict:
    """A model: ratio and weights (float32), bias, and the sigmoid's slope and offset."""
    if len(set(good.tolist())) < 2:
        only = 1.0 if not len(good) or good[0] == 1 else 0.0
        return {"only": only, "ratio": np.zeros(1, np.float32), "weights": np.zeros(1, np.float32), "bias": 0.0, "a": 0.0, "b": 0.0}
    taught, judged = np.arange(len(rows)) % 4 != 3, np.arange(len(rows)) % 4 == 3
    if len(set(good[taught].tolist())) < 2 or len(set(good[judged].tolist())) < 2:
        taught = judged = np.ones(len(rows), bool)
    part = [rows[i] for i in np.flatnonzero(taught)]
    ratio = _ratio(part, good[taught])
    w, bias = _descend(part, good[taught], ratio)
    a, b = _platt(np.array([margin(rows[i], w * ratio, np.square(ratio), bias) for i in np.flatnonzero(judged)]), good[judged])
    return {"only": None, "ratio": ratio.astype(np.float32), "weights": w.astype(np.float32), "bias": float(bias), "a": a, "b": b}


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> dict:
    """A model from at most ``rows`` labelled documents."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)").distinct()
    sample = known.orderBy(F.xxhash64("id"), "id", "y").limit(rows)
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    taught = text.join(F.broadcast(sample), "id").select("id", "text", "y")  # the sample is bounded by rows

    @lean
    def features(batches):
        for batch in batches:
            for part in slices(batch, 1):
                kept = [r.tobytes() for r in indicators(texts_of(part, 1))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(kept, pa.binary())], ["id", "y", "rows"])

    @lean
    def learn(batches):
        found, good, held = [], [], 0
        for batch in batches:
            for y, r in zip(batch.column("y").to_pylist(), batch.column("rows")):
                held += len(r.as_buffer() or b"")
                if held > SAMPLE_BYTES and found:
                    break
                good.append(y)
                found.append(np.frombuffer(r.as_py(), np.int32))
            if held > SAMPLE_BYTES and found:
                break
        for _ in batches:  # what is over the bound is read past
            pass
        model = fit(found, np.array(good, np.int32))
        said = json.dumps({k: v for k, v in model.items() if k not in ("ratio", "weights")})
        yield pa.RecordBatch.from_arrays([pa.array([said]), pa.array([model["ratio"].tobytes()]), pa.array([model["weights"].tobytes()])], ["said", "ratio", "weights"])

    kind = dict(text.dtypes)["id"]
    # one row for each label of the sample, whatever number of documents shares its id: the last task's input is bounded
    made = taught.mapInArrow(features, f"id {kind}, y int, rows binary").groupBy("id", "y").agg(F.min("rows").alias("rows"))
    made = made.withColumn("h", F.xxhash64("id")).repartition(1).sortWithinPartitions("h", "id", "y").select("y", "rows")
    got = made.mapInArrow(learn, "said string, ratio binary, weights binary").first()
    if got is None:
        return fit([], np.empty(0, np.int32))
    return json.loads(got.said) | {"ratio": np.frombuffer(got.ratio, np.float32), "weights": np.frombuffer(got.weights, np.float32)}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # two megabytes, whatever the corpus

    @lean
    def run(batches):
        m = held.value
        for batch in batches:
            for part in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores(texts_of(part, 1), m), pa.float64())], ["doc_id", "score"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def _fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def op1_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels.where(~_fold()))
    return score(docs, model).select("doc_id", _fold().alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go; the others keep all columns and values.

    A null or empty text is scored as empty, as ``scores`` has it; repeated rows stay or go together; an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.where(~_fold()))
    return keep_scored(docs, model)


def keep_scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``PREDICT_AT``, filtered where they are read: nothing is shuffled."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    @lean
    def run(batches):
        m = held.value
        for batch in batches:
            kept = [p >= PREDICT_AT for part in slices(batch, place) for p in scores(texts_of(part, place), m)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
