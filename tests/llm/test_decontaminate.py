import random
import re

import pytest

from brightsieve.llm import decontaminate as D


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        for win in {tuple(b[i : i + 10]) for i in range(max(1, len(b) - 9))} if b else ():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found.add(str(item))
    return len(w), len(hit), ",".join(sorted(found))


@pytest.mark.parametrize("broadcast", [True, False])
def test_against_brute_force(spark, texts, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    rng = random.Random(2)
    vocabulary = ["the", "of", "ein", "Été", "x1", "a"]
    say = lambda n: rng.choice(["", "!", " "]) + rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 9, 10, 11, 14]))) for i in range(12)] + [(50, None), (51, "..."), (52, " ".join(texts[0][1].split()[5:25])), (53, "the unseenword")]
    docs = [*texts, *((200 + i, say(rng.randrange(1, 60))) for i in range(60)), (300, say(30) + " " + items[9][1] + " " + say(5)), (300, "other text")]
    df = spark.createDataFrame([(i, t, 0, "w") for i, t in docs], "doc_id long, text string, th int, found string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, wid int")
    tokens = D.index(df)
    hits = {(r.doc_id, r.th): (r.n_hit, ",".join(r["items"])) for r in D.matches(df, tokens, bench).collect()}
    counts = sorted(((r.doc_id, r.n_words, *hits.get((r.doc_id, r.th), (0, ""))) for r in tokens.collect()), key=str)
    assert counts == sorted(((i, *brute(t, items)) for i, t in docs), key=str)


def test_edges(spark, docs, nothing, tmp_path):
    bench = spark.createDataFrame([(1, "lora mise")], "item_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.matches(docs, D.index(docs), empty).count() == 0 and D.matches(nothing, D.index(nothing), bench).count() == 0
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = D.stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {2, 3, 4, 6, 7, 8, 13}


def test_proximity(spark):
    df = spark.createDataFrame([(1, "zeta one two alpha three beta"), (2, "alpha " + "x " * 50 + "beta zeta")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "alpha three beta zeta one")], "item_id long, text string")
    found = D.proximity(df, bench, span=8).collect()
    assert {r.doc_id for r in found} == {1}
