import random

import numpy as np
import pytest

from brightsieve.llm import passages as P


def test_compact_windows():
    rng = np.random.default_rng(0)
    v, starts = rng.integers(0, 2**63, 700).astype(np.uint64), np.array([0, 300, 310, 700])
    got = set(zip(*(x.tolist() for x in P.compact_windows(v, starts, 20))))
    cut, want = np.uint64(10), set()
    for a, b in zip(starts, starts[1:]):
        for c in range(a, b):
            l, r = c, c
            while l > a and v[l - 1] >> cut > v[c] >> cut:
                l -= 1
            while r < b - 1 and v[r + 1] >> cut >= v[c] >> cut:
                r += 1
            if r - l + 1 >= 20:
                want.add((l, c, r))
    assert got == want


def test_shingles_don_t_depend_on_neighbours():
    texts = [b"", "Été a b c d e f".encode(), b"one two three", b"A, B. c d E f!", b"a b c d e f"]
    (at, hashes, starts), = P.shingles(texts)
    assert at == 0 and np.diff(starts).tolist() == [0, 3, 0, 2, 2]
    assert np.array_equal(hashes[starts[3] : starts[4]], hashes[starts[4] :])
    for i, t in enumerate(texts):
        assert np.array_equal(next(P.shingles([t]))[1], hashes[starts[i] : starts[i + 1]])


def jaccard(a, b):
    s, t = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b))
    return len(s & t) / len(s | t)


def test_planted_passages(spark, docs, texts, nothing):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    rows, group = [], {}
    for g in range(60):
        base = say(rng.choice([52, 75, 160]))
        kin = [list(base)]
        for _ in range(rng.choice([1, 2, 4])):
            q = list(base)
            if g % 2 and len(q) > 100:
                q[rng.randrange(len(q))] = f"e{rng.randrange(10**6)}"
                assert jaccard(base, q) >= 0.8
            kin.append(q)
        for q in kin:
            group[1000 + len(rows)] = g
            rows.append((1000 + len(rows), " ".join(say(rng.randrange(150)) + q + say(rng.randrange(150)))))
    line = say(30)  # too short a passage
    for g in range(60, 200):
        group[1000 + len(rows)] = g
        rows.append((1000 + len(rows), " ".join(say(100) + (line if g % 2 else say(30)) + say(100))))
    got = {r.doc_id: r for r in P.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    for i, g in group.items():
        first.setdefault(g, i)
    right = sum(got[i].class_id == first[g] for i, g in group.items())
    assert right / len(group) >= 0.99 and all(got[i].class_id == i for i, g in group.items() if g >= 60)


def test_edges(docs, texts, nothing):
    rows = P.classes(docs).collect()
    assert len(rows) == len(texts) and P.classes(nothing).count() == 0
    by = {r.doc_id: r for r in rows}
    assert by[11].class_id == by[12].class_id == by[1].class_id == 1 and by[10].class_id == by[9].class_id == 9
    assert all(by[i].class_id == i and by[i].n_links == 0 for i in (3, 4, 5, 6, 7, 8, 13)) and by[1].n_copies == 3


def words_of(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def edited(rng, base, edits):
    q = list(base)
    for k in edits:
        q[k] = f"e{rng.randrange(10**9)}"
    return q


def joined(spark, pairs):
    """Whether each pair of texts (lists of words) comes into one class, all in one table."""
    rows = [(2 * k + s, " ".join(t)) for k, pair in enumerate(pairs) for s, t in enumerate(pair)]
    got = {r.doc_id: r.class_id for r in P.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return [got[2 * k] == got[2 * k + 1] for k in range(len(pairs))], got


def test_whichever_word_is_changed_at_the_threshold(spark):
    rng, pairs, true = random.Random(1), [], []
    for n, edits in [(50, [[k] for k in range(50)]), (51, [[k] for k in range(51)]), (75, [[k] for k in range(0, 75, 5)]), (100, [[k, 99 - k] for k in range(0, 45, 4)]),
                     (160, [[20, 60, 120], [35, 80, 125]]), (300, [[40, 85, 130, 175, 220, 265]]), (60, [[24, 25], [30, 31]]), (58, [[27, 28]])]:
        for e in edits:
            base = words_of(rng, n)
            q = edited(rng, base, e)
            pairs.append([words_of(rng, rng.randrange(60)) + x + words_of(rng, rng.randrange(60)) for x in (base, q)])
            true.append(jaccard(base, q) >= 0.8)
    for extra in (1, 2, 3, 6):  # words put in, with as many words as make up for them
        base = words_of(rng, max(50, 4 * (8 + extra) + 8))
        k = len(base) // 2
        q = base[:k] + words_of(rng, extra) + base[k:]
        pairs.append([words_of(rng, 30) + x + words_of(rng, 30) for x in (base, q)])
        true.append(jaccard(base, q) >= 0.8)
    told, got = joined(spark, pairs)
    assert sum(true) > 100 and all(t for t, want in zip(told, true) if want)
    assert len({got[2 * k] for k in range(len(pairs))}) == len(pairs)  # no two pairs are joined


def brute(x, y):
    """Whether any passages of 50 to 56 words are alike."""
    s, t = ([tuple(w[i : i + 5]) for i in range(len(w) - 4)] for w in (x, y))
    for n in range(46, 53):
        for i in range(len(s) - n + 1):
            p = set(s[i : i + n])
            for m in (n - 1, n, n + 1):
                for j in range(len(t) - m + 1 if m >= 46 else 0):
                    q = set(t[j : j + m])
                    if 5 * len(p & q) >= 4 * len(p | q):
                        return True
    return False


def test_against_all_pairs(spark):
    """Components of short texts that share parts of a few passages, against brute force over all pairs."""
    rng, rows = random.Random(9), []
    stock = [words_of(rng, 55) for _ in range(4)]
    for k in range(36):
        part = rng.choice(stock)
        a = rng.randrange(0, 12)
        part = edited(rng, part[a : a + rng.randrange(38, 55)], [rng.randrange(30)] * (k % 3 == 0))
        rows.append(words_of(rng, rng.randrange(6)) + part + words_of(rng, rng.randrange(10, 20)))
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and brute(rows[i], rows[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in P.classes(df).collect()}
    assert [got[i] for i in range(len(rows))] == root and 3 < len(set(root)) < len(rows)


@pytest.mark.parametrize("few", [64, 4])
def test_common_lines_hide_no_passage(spark, monkeypatch, few):
    """Pairs that share a passage around a line of L words that many other texts have, too."""
    monkeypatch.setattr(P, "FEW", few)
    rng, rows, want = random.Random(4), [], {}
    for size in (15, 20, 30, 38, 44):
        line = words_of(rng, size)
        for _ in range(90 if few == 64 else 24):
            rows.append(words_of(rng, 40) + line + words_of(rng, 40))
        for k in range(12):
            before, after = words_of(rng, 6 + (40 - size) // 2 * (size < 40)), words_of(rng, 10 + (40 - size) // 2 * (size < 40))
            passage = before + line + after
            other = edited(rng, passage, [len(before) + size + 4] if k % 2 and size < 38 else [])
            if jaccard(passage, other) < 0.8 or len(passage) < 50:
                continue
            want[len(rows)] = len(rows) + 1
            rows += [words_of(rng, 30) + passage + words_of(rng, 30), words_of(rng, 30) + other + words_of(rng, 30)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in P.classes(df).collect()}
    assert len(want) > 40 and all(got[a] == got[b] == a for a, b in want.items())
    assert all(got[i] == i for i in range(len(rows)) if i not in want.values())  # a line alone joins none


@pytest.mark.parametrize("few", [64, 3])
def test_large_groups_of_one_passage(spark, monkeypatch, few):
    """A passage of 52 words in many texts, some with a word changed, and a line of 45 words in others: all are one class."""
    monkeypatch.setattr(P, "FEW", few)
    rng = random.Random(6)
    passage = words_of(rng, 52)
    rows = [words_of(rng, 40) + edited(rng, passage, [k] if k < 12 else []) + words_of(rng, 40) for k in range(100)]
    rows += [words_of(rng, 40) + passage[5:50] + words_of(rng, 40) for _ in range(100)]
    rows += [words_of(rng, 40) + passage[5:45] + words_of(rng, 40) for _ in range(10)]  # 40 words: Jaccard 36 / 56
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in P.classes(df).collect()}
    assert all(got[i].class_id == 0 and got[i].n_links for i in range(200)) and all(got[i].class_id == i and not got[i].n_links for i in range(200, 210))


def test_stuttering_texts(spark):
    rng = random.Random(2)
    stutter = [w for _ in range(6) for w in [f"s{rng.randrange(10**6)}"] * 30]
    rows = [stutter * 2, words_of(rng, 10) + stutter + words_of(rng, 20), ["a"] * 80, ["b"] + ["a"] * 70, ["a", "b"] * 60, words_of(rng, 60)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(rows)], "doc_id long, text string")
    got = [r.class_id for r in P.classes(df).orderBy("doc_id").collect()]
    assert got == [0, 0, 2, 2, 4, 5]
