import hashlib
import random
from collections import Counter, defaultdict, deque

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from brightsieve.llm import align as A
from brightsieve.llm.base import new_path, written

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


PRINTABLE = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
OTHERS = [x for x in range(256) if x not in PRINTABLE]


class Plain:
    """Whole texts by the libraries, groups and links one by one."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def tokens(self, text):
        if not text:
            return [], []
        raw = (" " + text).encode()
        a, at = [], 0
        for token in self.a.encode(" " + text, add_special_tokens=False).ids:
            byte = self.a_bytes(token)
            a.append((token, at, at + len(byte), byte))
            at += len(byte)
        b, at = [], 0
        for token in self.b.encode(text):
            piece = self.b.id_to_piece(token)
            byte = bytes([int(piece[3:5], 16)]) if self.b.is_byte(token) else piece.replace("▁", " ").encode()
            b.append((token, at, at + len(byte), byte))
            at += len(byte)
        if b"".join(x[3] for x in a) != raw or b"".join(x[3] for x in b) != raw:
            return [], []
        return a, b

    def a_bytes(self, token):
        return bytes(ord(c) if ord(c) < 256 else OTHERS[ord(c) - 256] for c in self.a.id_to_token(token))

    def groups(self, text):
        a, b = self.tokens(text)
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        out, a, b = [], deque(a), deque(b)
        for end in ends:
            own = ([], [])
            for tokens, group in zip((a, b), own):
                while tokens and tokens[0][2] <= end:
                    group.append(tokens.popleft()[0])
            out.append(own)
        return out

    def rows(self, texts):
        found = [self.groups(t) for t in texts]
        counts = Counter()
        for g in found:
            counts.update({(x, y) for a, b in g for x in a for y in b})
        best = defaultdict(int)
        for (x, _), n in counts.items():
            best[x] = max(best[x], n)
        out = []
        for g in found:
            linked = [(x, y) for a, b in g for x in a for y in b]
            name = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(linked), sum(counts[p] == best[p[0]] for p in linked), sum(counts[p] for p in linked), hashlib.sha256(name.encode()).hexdigest() if g else ""))
        return out


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(8)
    bits = ["the", " ", "  ", "\n", "\r\n", "\t", " ", "　", "é", "日本語", "a▁b", "don't", "123", "!?", "<|endoftext|>", "<s>", "<0x0A>", "\x00", "\x1c", "😀", "ﬁ", "é", "Straße", "x" * 40, "foo_bar", ";\r", " ", "\x85", "naïve", "HELLO", "​", "﻿"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(300)]
    plain = [x for x in bits if "▁" not in x]
    made += ["".join(rng.choice(plain) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    return made + ["", " ", "\n", "\n\n a", "a ", "a  ", "▁", None, "y" * 5_000, "1" * 3_000, "word " * 2_000]


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, *(r[n] for n in NAMES)) for r in df.collect())


def test_odd_texts_as_by_the_libraries(spark, odd):
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").repartition(3)
    assert got(A.align(df, A_PATH, B_PATH)) == sorted((False, i, *r) for i, r in enumerate(Plain().rows(odd)))


def test_table(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(A.op12_alignment(spark, sf_dir)) == sorted((False, i, *r) for (i, _), r in zip(texts, Plain().rows([t for _, t in texts])))


def test_defined_cases(docs, texts, nothing):
    short = [(i, t) for i, t in texts if len(t or "") < 5_000]
    some = docs.where("text IS NULL OR length(text) < 5000")
    want = Plain().rows([t for _, t in short])
    assert got(A.align(some, A_PATH, B_PATH)) == sorted((i is None, i or 0, *r) for (i, _), r in zip(short, want))
    assert A.align(nothing, A_PATH, B_PATH).count() == 0
    long = {r.doc_id: r for r in A.align(docs, A_PATH, B_PATH, spelt=True).collect()}
    assert long[5].n_a > 30_000 and long[5].groups.count(";") == long[5].n_groups - 1 and long[13].n_a > 0


def test_small_bounds_change_nothing(odd):
    """Pieces of texts, listing large groups by their distinct pairs and sums that are taken early; here within one process."""
    known = A.both(A_PATH, B_PATH)
    texts = [t for t in odd if t]
    want = [known.encode(t) for t in texts]
    whole = [x for x in want if x is not None]

    def linked():
        columns = [pa.array([x[k].tobytes() for x in whole], pa.binary()) for k in (0, 1)]
        return A.Linked(known, *columns)

    def counted(found, sums):
        for s, e in zip(found.cut, found.cut[1:]):
            sums.add(np.unique(found.keys[s:e]))
        batch = sums.taken()
        return dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))

    first = linked()
    counts = counted(first, A.Summed())
    links = Counter(first.keys.tolist())
    held, piece, listed = A.PAIRS_HELD, A.PIECE, A.LISTED
    try:
        A.PAIRS_HELD, A.PIECE, A.LISTED = 3, 7, 4
        assert [None if x is None else (x[0].tolist(), x[1].tolist()) for x in map(known.encode, texts)] == [None if x is None else (x[0].tolist(), x[1].tolist()) for x in want]
        second = linked()
        assert counted(second, A.Summed()) == counts
        again = Counter()
        for k, n in zip(second.keys.tolist(), second.often.tolist()):
            again[k] += n
        assert again == links and len(second.keys) < len(first.keys)
    finally:
        A.PAIRS_HELD, A.PIECE, A.LISTED = held, piece, listed


def test_either_library_gives_the_same_ids(odd):
    known, plain = A.both(A_PATH, B_PATH), Plain()
    assert known.quick is not None
    for t in odd:
        if t and not A._BEYOND_LATIN.search(t):
            assert known.quick.encode_ordinary(" " + t) == plain.a.encode(" " + t, add_special_tokens=False).ids


def test_shards_are_sorted_and_looked_up(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randint(0, 40) << 32 | rng.randint(0, 40), rng.randint(1, 5)) for _ in range(5_000)]
    want = Counter()
    for k, n in rows:
        want[k] += n
    shards, highest = A.count_shards(spark.createDataFrame(rows, "pair long, n long"), f"file://{tmp_path}/shards")
    assert sum(s[3] for s in shards) == len(want) and all(a[2] < b[1] for a, b in zip(shards, shards[1:]))
    assert highest == {i: max(n for k, n in want.items() if k >> 32 == i) for i in {k >> 32 for k in want}}
    best = np.zeros(41, np.int64)
    best[list(highest)] = list(highest.values())
    keys = np.array([k for k, _ in rows])
    found, top = A.Counts(shards, best).of(keys)
    assert found.tolist() == [want[k] for k, _ in rows] and top.tolist() == [want[k] == highest[k >> 32] for k, _ in rows]
    found, top = A.Counts(shards, best).of(np.array([41 << 32, rows[0][0]]))
    assert found.tolist() == [0, want[rows[0][0]]] and not top[0]


def test_shards_of_other_texts_are_refused(spark):
    one, two = (spark.createDataFrame([(1, t)], "doc_id long, text string") for t in ("some words", "quite other things"))
    shards, highest = A.count_shards(written(A.pair_counts(A.tokens(one, A_PATH, B_PATH), A_PATH, B_PATH)), new_path(spark, "pair-shards"))
    with pytest.raises(Exception, match="shards are of other texts"):
        A.aligned(A.tokens(two, A_PATH, B_PATH), shards, highest, A_PATH, B_PATH).collect()
