import zlib
from collections import defaultdict

import numpy as np

from brightsieve.llm import sharding as S


def jump(key, n):
    b, j = -1, 0
    key &= (1 << 64) - 1
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(500)]
    for n in (1, 2, 24, 25, 1000):
        got = S.jump_hash(np.array(keys, np.int64), n)
        assert got.tolist() == [jump(k, n) for k in keys]
    a, b = S.jump_hash(np.arange(5000), 24), S.jump_hash(np.arange(5000), 25)
    assert set(b[a != b]) == {24} and 100 < (a != b).sum() < 320


def test_slots(docs, texts, nothing, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 1)
    rows = S.shard(docs, 3).collect()
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.shard == jump(r.doc_id or 0, 3) and r.grown_shard in (r.shard, 3)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((i or 0, 8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in rows) == want
    assert S.shard(nothing, 3).count() == 0
