import hashlib
import re

import corpus_pipeline
from pyspark.sql import functions as F

from brightsieve.llm import bpe, quality
from test_decontaminate import brute as windows_in
from test_pii import brute as personal
from test_simhash import survivors


def test_stages(spark, tmp_path):
    """Each stage's rows against a brute-force version of its operator over the rows before it."""
    sf_dir = "/root/testdata/sf0.001"
    stages = [s for _, s in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for k, stage in enumerate(stages):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        kept.append((docs.collect(), docs := spark.read.parquet(f"{tmp_path}/{k}")))
        assert docs.columns == columns or k == 4
    rows = [(before, after.collect()) for before, after in kept]

    # 1: the scores of the model that the labelled rows teach
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels.where(~quality._fold()))
    before, after = rows[0]
    scores = quality.scores([(r.text or "").encode() for r in before], model)
    assert sorted(map(str, after)) == sorted(str(r) for r, p in zip(before, scores) if p >= quality.PREDICT_AT) and 0 < len(after) < len(before)

    # 2: one row of each component, the least id
    before, after = rows[1]
    least = sorted(min(g)[1] for g in survivors([(r.doc_id, r.text) for r in before]))
    assert sorted(r.doc_id for r in after) == least and len(after) < len(before)

    # 3: rows without any benchmark window
    before, after = rows[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = [r for r in before if not windows_in(r.text, items)[1]]
    assert sorted(map(str, after)) == sorted(map(str, clean)) and len(clean) < len(before)

    # 4: every row stays, without personal data, and as it was where there was none (but for terms)
    before, after = rows[3]
    by = {r.doc_id: r for r in after}
    assert len(by) == len(before) and any(personal(r.text) for r in before)
    for r in before:
        new = by[r.doc_id]
        assert not [p for p in personal(new.text)] and new.n_chars == len(new.text) and (new.lang, new.source) == (r.lang, r.source)
        if not personal(r.text):
            assert new.text == r.text

    # 5: what the library encodes and decodes
    before, after = rows[4]
    known = bpe.Pieces(bpe.tokenizer_path()).tokenizer
    by = {r.doc_id: r for r in after}
    for r in before:
        ids = known.encode(r.text or "", add_special_tokens=False).ids
        said = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(known.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (by[r.doc_id].n_tokens, by[r.doc_id].ids_sha256, by[r.doc_id].decoded_sha256) == (len(ids), *said)
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(str, rows[4][1]))


CLASH = ("__row", "__th", "__id", "__ID2", "__near", "__order", "__terms", "component_id", "n_hit", "term", "start", "xth")


def test_odd_rows_and_clashing_names(spark, tmp_path):
    """Null, empty, repeated and blank rows, and columns named as the operators name their own: all stages keep their values."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    some = [tuple(r) for r in docs.orderBy("doc_id").limit(60).collect()]
    odd = [(None, some[3][1], None, None, None), (None, None, "en", "s", None), (9_000, None, None, None, None), (9_001, "", "en", "s", 0), (9_002, " \n", None, "s", 2), some[5], some[5], (9_003, "mail me: some.one@example.org or +1 222 333 4444 " + some[7][1], "en", "s", None)]
    own = {c: f"v{i}" for i, c in enumerate(CLASH)}
    rows = spark.createDataFrame(some + odd, docs.schema).withColumns({c: F.concat(F.lit(v), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c, v in own.items()})
    names = rows.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows.collect()
        stage(spark, rows, sf_dir).write.parquet(f"{tmp_path}/{k}")
        rows = spark.read.parquet(f"{tmp_path}/{k}")
        after = rows.collect()
        if k == 4:
            assert len(after) == len(before)
            break
        assert rows.columns == names and len(after) > 20
        for r in after:
            assert all(r[c] == v + ("none" if r.doc_id is None else str(r.doc_id)) for c, v in own.items())
        was = {str(r) for r in before}
        if k != 3:
            assert all(str(r) in was for r in after)
        if k == 3:
            assert len(after) == len(before)
            assert not any("some.one@example.org" in (r.text or "") for r in after)


def test_empty_table_stays_empty(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, sf_dir)
        assert rows.count() == 0


def test_entry_points(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {re.match("op[0-9]+", k)[0] for k in names if k.startswith("op")} and "pipeline" in names
