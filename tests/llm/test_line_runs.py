import hashlib
import random
import re
import string

import pytest

from brightsieve.llm import line_runs as L
from brightsieve.llm.base import written

UPPER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain(rows):
    """(doc_id, text) -> sorted (doc_id, n_lines, n_dropped, kept); a null id comes after all others."""
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(UPPER)
    last, holders = 1 << 70, {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(last if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == (last if i is None else i)]
        out.append((i is None, i or 0, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_dropped, r.kept) for r in df.collect())


@pytest.fixture(scope="module")
def rows(texts):
    rng = random.Random(3)
    lines = [f"Common line {i} " + "x" * (i % 7) for i in range(30)] + ["short", "", "  \t", "123456789", "1234567890", "ÄÖÜäöüßéèà", "äöüäöüßéèà", " ten chars \r", "TEN chars!!", "\x0bten CHARS!!\x0c", " not a blank"]
    made = [(rng.choice([i, i, -i]), "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(20, 140)]
    hot = [(i, "the line that all have\n" + rng.choice(lines) + "\nthe line that all have") for i in range(200, 320)]
    return texts + made + hot + hot[:5] + [(7, "Common line 3 xxx\nCommon line 3 xxx"), (None, "the line that all have"), (None, "the line that all have\nown line of nobody else"), (5, None)]


@pytest.fixture(scope="module")
def docs11(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "k", 0, 0) for i, t in rows], "doc_id long, text string, h1 long, owner long, key string, pos int, doc int").repartition(5)


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_as_by_hand(docs11, rows, batches):
    assert got(L.dedup(docs11, batches)) == plain(rows)


def test_defined_cases(docs, texts, nothing, spark):
    assert got(L.dedup(docs)) == plain(texts)
    assert L.dedup(nothing).count() == 0
    blank = [(1, None), (2, ""), (None, None)]
    assert got(L.dedup(spark.createDataFrame(blank, "doc_id long, text string"))) == plain(blank)


def test_runs_are_levelled_reopened_and_used(spark, tmp_path):
    folder, seen, held = f"file://{tmp_path}/runs", [], []
    for k in range(7):
        rows = [(100 * k + i, "\n".join(f"line number {n}" for n in range(3 * i + k, 3 * i + k + 4))) for i in range(6)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        store = L.LineRuns(spark, folder, 4)  # opened anew for each batch
        assert store.next == k and store.buckets == 4
        if len(store.runs) > 1:  # merge joins with runs move only the batch
            keys = spark.table(store.runs[0][2]).join(spark.table(store.runs[1][2]).select(*L.KEY).hint("merge"), L.KEY, "left_anti")
            assert "Exchange hashpartitioning" not in keys._jdf.queryExecution().toString()
        gone = store.add(written(L.key_rows(docs)))
        held.append([(a, b) for a, b, _ in store.runs])
        store.close()
        seen += rows
        assert got(L.kept(docs, gone)) == [r for r in plain(seen) if r[1] >= 100 * k]
    assert held == [[(0, 0)], [(0, 1)], [(0, 1), (2, 2)], [(0, 3)], [(0, 3), (4, 4)], [(0, 3), (4, 5)], [(0, 3), (4, 5), (6, 6)]]
    # a writer that ended half-way, and a merge whose inputs were not removed yet
    last = L.LineRuns(spark, folder)
    half, merged = tmp_path / "runs" / "run-7-7-4", tmp_path / "runs" / "run-4-6-4"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half")
    both = spark.table(last.runs[1][2]).unionByName(spark.table(last.runs[2][2])).repartition(4, *L.KEY)
    last._write(both, f"file://{merged}")
    again = L.LineRuns(spark, folder)
    assert [(a, b) for a, b, _ in again.runs] == [(0, 3), (4, 6)] and again.next == 7 and not half.exists()
    docs = spark.createDataFrame([(5_000, "line number 5\nline number 999")], "doc_id long, text string")
    assert got(L.kept(docs, again.add(written(L.key_rows(docs)))))[0][3:] == (1, "line number 999")
    again.close(keep=False)
    assert not [p for p in (tmp_path / "runs").iterdir() if p.name.startswith("run-0")]


def test_hot_lines_go_by_broadcast(spark):
    many = spark.range(6_000).selectExpr("id AS doc_id", "concat('one line that all have\n', 'line of document ', id, '\nshared by ten ', id div 10) AS text")
    out = L.dedup(many, 2).select("doc_id", "n_dropped", "kept").collect()
    assert sum(r.n_dropped for r in out) == 5_999 + 5_400 and len(out) == 6_000
    assert next(r.kept for r in out if r.doc_id == 11) == "line of document 11"


def test_no_python_on_the_path(docs11):
    plan = L.dedup(docs11)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query_digests(spark, sf_dir):
    out = L.op11_line_dedup(spark, sf_dir).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for _, i, n, d, t in plain(docs)]
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in out) == want
