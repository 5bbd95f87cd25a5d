import random

from pyspark.sql import functions as F

from brightsieve.operators import dedup
from brightsieve.plans import catalogue


def sequential(rows):
    """Leaders in order: a row joins the leader that has its e-mail, else its phone."""
    by, out, n = [{}, {}], {}, 0
    for ix, *keys in rows:
        hit = None
        for col, k in enumerate(keys):
            if k and k.strip().lower() in by[col]:
                hit = by[col][k.strip().lower()]
        if hit is None:
            n += 1
            hit = n
            for col, k in enumerate(keys):
                if k and k.strip():
                    by[col][k.strip().lower()] = n
            out[ix] = (False, n)
        else:
            out[ix] = (True, hit)
    return out


def test_exact_against_the_sequential_scan(spark):
    rng = random.Random(5)
    key = lambda p, n: rng.choice([None, "", *[f"{p}{rng.randrange(n)}" for _ in range(8)]])
    rows = [(i, key("P", 40), key(" e", 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "row_ix long, phone string, email string")
    want = sequential(rows)
    for r in dedup.mark_exact(df).collect():
        assert (r.is_duplicate, int(r.duplicate_cluster_id[8:])) == want[r.row_ix], r


def check(df, rows):
    want = sequential(rows)
    got = {r.row_ix: (r.is_duplicate, int(r.duplicate_cluster_id[8:])) for r in dedup.mark_exact(df).select("row_ix", "is_duplicate", "duplicate_cluster_id").collect()}
    assert got == want


def test_small_ranges_and_frequent_keys(spark, monkeypatch):
    monkeypatch.setattr(dedup, "RANGE", 30)
    monkeypatch.setattr(dedup, "HOT", 20)
    rng = random.Random(6)
    for peel in (0, 1, 4):
        monkeypatch.setattr(dedup, "PEEL", peel)
        key = lambda p, n: rng.choice([None, f"{p}hot", f"{p}hot", f"{p}{rng.randrange(n)}", f"{p}{rng.randrange(n)}", f"{p}{rng.randrange(n)}"])
        rows = [(i, key("P", 60), key("e", 60)) for i in range(400)]
        check(spark.createDataFrame(rows, "row_ix long, phone string, email string").repartition(3), rows)


def test_a_long_chain_and_a_key_of_a_million_rows(spark, monkeypatch):
    """Rows that wait for each other end in a bounded number of rounds, and so does a key that most rows have."""
    n, rounds = 100_000, []
    chain = spark.range(n).selectExpr("id AS row_ix", "concat('p', id div 2) AS phone", "concat('e', (id + 1) div 2) AS email")
    true = dedup._scanned
    monkeypatch.setattr(dedup, "RANGE", 30_000)
    monkeypatch.setattr(dedup, "_scanned", lambda *a: (rounds.append(1), true(*a))[1])
    got = dedup.mark_exact(chain)
    assert got.where("is_duplicate <> (row_ix % 2 = 1)").count() == 0 and got.count() == n
    assert 3 <= len(rounds) <= 5
    hot = spark.range(1_000_000).selectExpr("id AS row_ix", "IF(id % 10 < 8, 'hot', concat('p', id)) AS phone", "IF(id % 3 = 0, NULL, concat('e', id % 250000)) AS email")
    got = dedup.mark_exact(hot)
    assert got.where("phone = 'hot' AND NOT is_duplicate").select("row_ix").collect() == [(0,)]
    rows = spark.range(20_000).selectExpr("id", "IF(id % 10 < 8, 'hot', concat('p', id))", "IF(id % 3 = 0, NULL, concat('e', id % 5000))").collect()
    check(spark.createDataFrame(rows, "row_ix long, phone string, email string"), [tuple(r) for r in rows])


def test_golden(spark):
    df = spark.createDataFrame([(1, "p1", None), (2, "p1", "e1"), (3, None, "e1")], "row_ix long, phone string, email string")
    got = [(r.row_ix, r.duplicate_cluster_id, r.is_duplicate) for r in dedup.mark_exact(df).orderBy("row_ix").collect()]
    assert got == [(1, "cluster_000001", False), (2, "cluster_000001", True), (3, "cluster_000002", False)]
    s = dedup.summary(dedup.mark_exact(df)).first()
    assert (s.total_records, s.duplicate_records, s.clusters, s.duplicate_rate) == (3, 1, 2, 33.33)


def test_empty(spark):
    assert dedup.mark_exact(spark.createDataFrame([], "row_ix long, phone string, email string")).count() == 0


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_fuzzy_loses_no_pair(spark):
    rng = random.Random(2)
    names = []
    for _ in range(60):
        base = "".join(rng.choice("abcde ") for _ in range(rng.randrange(1, 25)))
        for _ in range(3):
            s = list(base)
            for _ in range(rng.randrange(3)):
                s.insert(rng.randrange(len(s) + 1), rng.choice("abcde"))
            names.append("".join(s))
    rows = [(i, n, rng.choice(["1 main", "1 mainn", "2 oak"])) for i, n in enumerate(names)]
    rows += [(1000, None, None), (1001, "", "")]
    got = {(r.ix1, r.ix2): r.score for r in dedup.fuzzy_pairs(spark.createDataFrame(rows, "row_ix long, company string, address1 string")).collect()}
    ratio = lambda a, b: 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 0
    want = {}
    for i, (x, c, a) in enumerate(rows):
        for y, d, b in rows[i + 1 :]:
            s, t = ratio((c or "").strip().lower(), (d or "").strip().lower()), ratio((a or "").strip(), (b or "").strip())
            if s >= 0.85 and t >= 0.9:
                want[x, y] = (s + t) / 2
            elif s >= 0.95:
                want[x, y] = s
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_pairs_of_many_equal_rows(spark, monkeypatch):
    """8,000 rows of few companies and addresses: no pair of rows goes to Python."""
    monkeypatch.setattr(dedup, "PIECE", 300)
    monkeypatch.setattr(dedup, "LOAD", 500_000)
    rows = [(i, ["northside care 1", "northside care 11", "westside care 7"][i % 3], ["1 main street", "2 oak", None, "11 main street"][i // 3 % 4]) for i in range(8_000)]
    found = dedup.fuzzy_pairs(spark.createDataFrame(rows, "row_ix long, company string, address1 string"))
    assert "indel(" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.c, r.d): (r.n, r.s) for r in found.where("ix1 < ix2").groupBy((F.col("ix1") % 12).alias("c"), (F.col("ix2") % 12).alias("d")).agg(F.count("*").alias("n"), F.avg("score").alias("s")).collect()}
    ratio = lambda a, b: 2 * lcs(a, b) / (len(a) + len(b))
    want = {}
    for i in range(12):
        for j in range(12):
            (_, c, a), (_, d, b) = rows[i], rows[j]
            s, t = ratio(c, d), ratio(a, b) if a and b else 0
            n = sum((8_000 - 1 - x - (j - i) % 12) // 12 + ((j - i) % 12 > 0) for x in range(i, 8_000, 12) if x + ((j - i) % 12 or 12) < 8_000)
            if s >= 0.85 and t >= 0.9:
                want[i, j] = (n, (s + t) / 2)
            elif s >= 0.95:
                want[i, j] = (n, s)
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in got)


def test_arbitration(spark):
    pairs = spark.createDataFrame([(1, 2, 0.8), (1, 3, 0.9), (2, 3, 0.72)], "ix1 long, ix2 long, score double")
    assert sorted(r.score for r in dedup.arbitrate(pairs, lambda df: F.col("ix1") == 2).collect()) == [0.72, 0.9]


def test_the_query_keeps_pairs_of_like_companies_alone(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_size").collect()
    name = {r.p_partkey: f"{r.p_name} {r.p_size}".lower().strip() for r in parts}
    near = {(x, y) for x in name for y in name if x < y and 2 * lcs(name[x], name[y]) >= 0.95 * (len(name[x]) + len(name[y]))}
    assert near and near <= {(r.ix1, r.ix2) for r in catalogue.d03(spark, sf_dir).collect()}
