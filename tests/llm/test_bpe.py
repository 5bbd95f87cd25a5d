import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from brightsieve.llm import bpe, records

ODD = ["a", "B", " ", "\n", "'s", "'", "É", "é", "\u0301", "İ", "ß", "Σ", "ς", "1", "٣", "<|endoftext|>", "<|", "😀", "\u00a0", "\x1f", "\u2003", "ﬁ", "中", "'LL ", "Aé ", "--", "ſ", "\x00", "word ", "The ", "x" * 300]


@pytest.fixture(scope="module")
def known():
    return bpe.Pieces(bpe.tokenizer_path())


def test_agrees_with_the_library(known, texts, monkeypatch):
    monkeypatch.setattr(bpe, "MASK_BITS", 4)  # many joins
    rng = random.Random(1)
    cases = ["".join(rng.choice(ODD) for _ in range(rng.choice([0, 1, 5, 50, 300]))) for _ in range(400)] + [t or "" for _, t in texts]
    encoder, decode = bpe.ChunkEncoder(known), bpe.decoder(known)
    many = known.many(cases)
    for case, packed in zip(cases, many):
        want = known.tokenizer.encode(case, add_special_tokens=False).ids
        assert known.unpack(encoder.encode(case)).tolist() == want == known.unpack(known.ids(case)).tolist() == known.unpack(packed).tolist()
        assert decode(want) == known.tokenizer.decode(want, skip_special_tokens=False)


def test_small_tables(texts, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_HELD", 3)
    monkeypatch.setattr(bpe, "BYTES_HELD", 50)
    monkeypatch.setattr(bpe, "CHUNKS_HELD", 1)
    own = bpe.Pieces(bpe.tokenizer_path())
    encoder = bpe.ChunkEncoder(own)
    for _, t in texts:
        want = own.tokenizer.encode(t or "", add_special_tokens=False).ids
        assert own.unpack(encoder.encode(t or "")).tolist() == want == own.unpack(own.many([t or ""])[0]).tolist()


def test_rows(docs, texts, nothing, known):
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encoded(docs, bpe.tokenizer_path(), digests=True).collect()), key=str)
    want = []
    for i, t in texts:
        ids = known.tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(known.tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    plain = bpe.encoded(docs, bpe.tokenizer_path()).where("doc_id = 8").first()
    assert plain.ids == known.tokenizer.encode("a b", add_special_tokens=False).ids and plain.decoded == "a</w> b</w>"
    assert bpe.encoded(nothing, bpe.tokenizer_path()).count() == 0


def test_records(spark, docs, texts, nothing, known, monkeypatch, tmp_path):
    monkeypatch.setattr(records, "FILE_BYTES", 20_000)
    manifest = records.write(docs, f"file://{tmp_path}/out", bpe.tokenizer_path(), 2)
    rows = records.read(spark, manifest, with_ids=True).orderBy("start").collect()
    assert len(rows) == len(texts) and len(manifest) > 1
    assert [r.doc_id for r in rows] == sorted((i for i, _ in texts), key=lambda i: -1 if i is None else i)
    upto = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (upto, len(r.ids)) and r.ids[-1] == 2
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids))
        upto += r.n_tokens
    by_text = {tuple(known.tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,) for _, t in texts}
    assert {tuple(r.ids) for r in rows} == by_text
    file, count, _, _ = manifest[-1]
    assert records.read_record(file, count - 1)[1].tolist() == rows[-1].ids
    empty = records.write(nothing, f"file://{tmp_path}/none", bpe.tokenizer_path(), 2)
    assert empty == [] and records.read(spark, empty).count() == 0


def test_damage_is_seen():
    good = records.frame(b"payload")
    assert records.unframe(good) == (b"payload", len(good))
    for i in range(len(good)):
        with pytest.raises(ValueError):
            records.unframe(good[:i] + bytes([good[i] ^ 1]) + good[i + 1 :])
    assert records.masked(b"") == 0xA282EAD8 and np.uint32(records.masked(b"a")) != records.masked(b"b")


def test_texts_without_spaces_take_linear_time(known):
    """Ideographs and base64: twice the text takes about twice the time, and the library's ids."""
    rng = random.Random(3)
    for chars in ("".join(chr(c) for c in range(0x4E00, 0x9000)), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
        took = []
        for n in (100_000, 200_000, 400_000):
            text = "".join(rng.choice(chars) for _ in range(n))
            encoder = bpe.ChunkEncoder(known)
            began = time.process_time()
            got = encoder.encode(text)
            took.append(time.process_time() - began)
            began = time.process_time()
            want = known.tokenizer.encode(text, add_special_tokens=False).ids
            took.append(time.process_time() - began)
            assert known.unpack(got).tolist() == want
        # no worse than the library beside a constant factor, at any length
        assert all(own < 3 * library + 0.5 for own, library in zip(took[::2], took[1::2])), took


def test_words_whose_hashes_agree_are_told_apart(texts, monkeypatch):
    own = bpe.Pieces(bpe.tokenizer_path())
    monkeypatch.setattr(bpe, "_hash", lambda byte, first, last: np.zeros(len(first), np.uint64))
    for _, t in texts[:9]:
        assert own.unpack(own.many([t or ""])[0]).tolist() == own.tokenizer.encode(t or "", add_special_tokens=False).ids
