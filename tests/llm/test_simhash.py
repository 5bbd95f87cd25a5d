import random
import re

import numpy as np
import xxhash

from brightsieve.llm import simhash as S


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_index_finds_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(10):
        f = [int(b) for b in rng.integers(0, 2**63, 4, dtype=np.uint64)]
        for _ in range(150):
            x = f[rng.integers(len(f))]
            for _ in range(rng.integers(0, 6)):
                x ^= 1 << int(rng.integers(64))
            f.append(x)
        f = np.unique(np.array(f, np.uint64))
        g = rng.integers(0, 3, len(f))
        ix = S.GrayIndex(g, f)
        got = {tuple(sorted((a, b))) for i, j in ix.pairs(3) for a, b in zip(ix.order[i].tolist(), ix.order[j].tolist())}
        assert got == {(i, j) for i in range(len(f)) for j in range(i + 1, len(f)) if g[i] == g[j] and int(f[i] ^ f[j]).bit_count() <= 3}


def test_masks_leave_one_whole():
    rng = random.Random(3)
    for n in (1, 1 << 25, 1 << 33):
        masks = S.route_masks(n, 3)
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(not diff & m for m in masks)


def test_components(spark, docs, texts, nothing, monkeypatch):
    monkeypatch.setattr(S, "HOT", 2)  # the way of crowded groups
    rng = random.Random(7)
    base = [f"w{rng.randrange(400)}" for _ in range(400)]
    more = [(100 + k, " ".join([*base[:k], f"new{k}", *base[k:]])) for k in range(0, 60)]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    every = [*texts, *more]
    prints = [fingerprint(t) for _, t in every]
    root = list(range(len(every)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(every)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(every):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(every, prints))), key=str)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.components(df).collect()), key=str)
    assert got == want
    assert S.components(nothing).count() == 0


def survivors(rows):
    """By brute force: of each component of (id, text) the row with the least id, rows without one last."""
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    groups = {}
    for (d, t), r in zip(rows, root):
        groups.setdefault(r, []).append((d is None, d or 0, t))
    return groups.values()


def test_stage(spark, docs, texts, nothing):
    kept = S.keep_one(spark, docs, "")
    assert kept.columns == docs.columns and S.keep_one(spark, nothing, "").count() == 0
    got = [(r.doc_id, r.text) for r in kept.collect()]
    groups = survivors(texts)
    assert len(got) == len(groups) and len(set(got)) == len(got)
    for g in groups:  # rows with one id and unlike texts tie: either may stay
        least = min(g, key=lambda x: x[:2])[:2]
        assert len({(None if no else d, t) for no, d, t in g if (no, d) == least} & set(got)) == 1
    assert [d for d, _ in got].count(1) == 1  # repeated rows: one stays
