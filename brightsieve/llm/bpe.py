"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash of the last 16 characters cuts texts where its top bits are
zero, so that texts that share a passage share the chunks inside it. A task
encodes each distinct chunk once and keeps its ids, within a bound of memory.
A chunk's ids hold only between its first and last *safe* places (white space
followed by an ASCII letter or digit: neither normalisation, special tokens
nor pre-tokenisation reach over one). Where two chunks meet, the stretch from
the last word of the left one's core to the first word of the right one's is
encoded again; its ids must begin and end with what the chunks hold for those
words, and until they do, the two chunks are made one and encoded as a whole.

Pieces are encoded by the tokenizers library, or come from a table of words
that it has encoded. The table serves texts of ASCII and Latin letters only,
where lower-casing and pre-tokenisation are certain; any other stretch goes to
the library as it is.

Defined cases: a null text is empty and has no ids; white space alone has none
either; strings of special tokens become those tokens, as the library has it;
texts of any length are encoded whole; repeated rows get equal results; extra
columns aren't read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightsieve.llm.base import lean, slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

WINDOW, MASK_BITS = 16, 10
#: Entries of a task's tables of words and chunks, and bytes of the texts and ids in each.
WORDS_HELD, CHUNKS_HELD, BYTES_HELD = 300_000, 4_096, 6_000_000
#: Characters at least that are given to the table or the library at once.
STRETCH = 256
SEPARATOR = " "

_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ſ"
#: What lower-casing and pre-tokenisation are certain for: no NFC changes, no upper case that grows.
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LATIN}]*\Z")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\sa-z0-9ß-öø-ſ]+")
_SAFE = re.compile(r"(?<=[ \n\t\r])(?=[A-Za-z0-9])")


#: Classes of bytes of plain text: white space, letters, digits (each a word), others.
_KIND = np.full(256, 3, np.uint8)
_KIND[list(b"\t\n\r ")] = 0
_KIND[97:123] = _KIND[128:] = 1
_KIND[48:58] = 2
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=2)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """2^bits powers of an odd number modulo 2^64, and of its inverse."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(1 << bits, b, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _hash(byte: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of byte[first:last]: polynomials from running sums, then mixed."""
    up, down = _powers(int(_BASE), len(byte).bit_length())
    total = np.empty(len(byte) + 1, np.uint64)
    total[0] = 0
    np.cumsum((byte.astype(np.uint64) + np.uint64(1)) * up[: len(byte)], out=total[1:])
    x = (total[last] - total[first]) * down[first]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + sizes[i], one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _bare(tokenizer: str) -> str:
    parts = json.loads(tokenizer)
    parts["normalizer"] = None
    parts["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
    return json.dumps(parts)


class Pieces:
    """Ids of stretches between safe places, packed as little-endian integers of ``width`` bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.width = self.kind.itemsize
        #: Two generations of words: a word found in the older one moves to the newer.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: The same for words as UTF-8.
        self.spelt: dict[bytes, bytes] = {}
        #: For words cut and lower-cased already: the same model, without the regular expressions before it.
        self.bare = Tokenizer.from_str(_bare(self.tokenizer.to_str()))
        #: Which ids end a word.
        self.ending = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(self.size)])
        table = "Split" in repr(self.tokenizer.pre_tokenizer) and "'s|'t|'re|'ve|'m|'ll|'d" in repr(self.tokenizer.pre_tokenizer)
        lower = "Lowercase" in repr(self.tokenizer.normalizer)
        self.fast = table and lower and self.tokenizer.post_processor is None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _plain(self, text: str) -> bool:
        return self.fast and _PLAIN.match(text) is not None and not any(s in text for s in self.special)

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def unpack(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, self.kind)

    def library(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        """As the library encodes ``text`` without adding special tokens."""
        if self._plain(text):
            return self._by_words(text)
        out, at = [], 0
        for cut in [*(m.start() for m in _SAFE.finditer(text)), len(text)]:
            if cut - at >= STRETCH or cut == len(text):
                part, at = text[at:cut], cut
                out.append(self._by_words(part) if self._plain(part) else self.library(part))
        return b"".join(out)

    def many(self, texts: list[str]) -> list[bytes]:
        """``ids`` of each text; of the words of plain texts each distinct one is looked up once."""
        # an apostrophe can begin a contraction, which the regular expression sees to
        easy = [i for i, t in enumerate(texts) if "'" not in t and self._plain(t)]
        out = dict(zip(easy, self._hashed([texts[i] for i in easy])))
        return [out[i] if i in out else self.ids(t) for i, t in enumerate(texts)]

    def _hashed(self, texts: list[str]) -> list[bytes]:
        raw = "\n".join(texts).lower().encode() + b"\n"
        byte = np.frombuffer(raw, np.uint8)
        kind = _KIND[byte]
        ends = np.flatnonzero(byte == 10)
        if len(ends) != len(texts):  # lines within texts: their own ends are counted instead
            ends = np.cumsum([len(t.lower().encode()) + 1 for t in texts]) - 1
        edge = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == 2), True])
        first, last = edge[:-1], edge[1:]
        word = kind[first] != 0
        first, last = first[word], last[word]
        if not len(first):
            return [b""] * len(texts)
        with np.errstate(over="ignore"):
            hashes = _hash(byte, first, last)
        _, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        sizes = last - first
        if (sizes != sizes[at][back]).any() or (byte[_ranges(first, sizes)] != byte[_ranges(first[at][back], sizes)]).any():
            return [self._by_words(t) for t in texts]  # unlike words with one hash
        names = [raw[s:e] for s, e in zip(first[at].tolist(), last[at].tolist())]
        entries = list(map(self.spelt.get, names))
        if None in entries:
            new = [i for i, e in enumerate(entries) if e is None]
            if len(self.spelt) + len(new) > WORDS_HELD:
                self.spelt = {}
            for i, ids in zip(new, self._encoded([names[i].decode() for i in new])):
                entries[i] = self.spelt[names[i]] = ids
        flat = self.unpack(b"".join(entries))
        own = np.fromiter(map(len, entries), np.int64, len(entries)) // self.width
        begins, size = (np.cumsum(own) - own)[back], own[back]
        upto = np.cumsum(size)
        ids = flat[_ranges(begins, size)].tobytes()
        cut = (np.r_[0, upto][np.searchsorted(first, ends)] * self.width).tolist()
        return [ids[s:e] for s, e in zip([0, *cut], cut)]

    def _by_words(self, text: str) -> bytes:
        words = _PARTS.findall(text.lower())
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            self._learn(set(words))
        return b"".join(map(self.words.__getitem__, words))

    def _learn(self, words: set[str]) -> None:
        """Afterwards the table has all of ``words``."""
        if len(self.words) > WORDS_HELD // 2:
            self.words, self.older = {}, self.words
        missing = words.difference(self.words)
        moved = {w: ids for w in missing if (ids := self.older.get(w)) is not None}
        self.words.update(moved)
        new = [w for w in missing if w not in moved]
        self.words.update(zip(new, self._encoded(new)))

    def _encoded(self, words: list[str]) -> list[bytes]:
        """The library's ids of single words."""
        out: list[bytes] = []
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            # one call for many words: each ends with a token that ends a word
            ids = np.array(self.bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.ending[ids]) + 1
            if len(ends) == len(some):
                cut, packed = (ends * self.width).tolist(), ids.tobytes()
                out += [packed[a:b] for a, b in zip([0, *cut], cut)]
            else:
                out += [self.pack(e.ids) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return out


    def forget(self) -> None:
        """Empties the tables of words."""
        self.words, self.older, self.spelt = {}, {}, {}
        _powers.cache_clear()


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The tokenizer at ``path``, loaded once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def cuts(text: str) -> list[int]:
    """Places where the rolling hash of the last WINDOW characters ends a chunk; the text's end is the last."""
    units = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    h = (units + np.uint32(1)) * np.uint32(2654435761)
    h ^= h >> np.uint32(15)
    h *= np.uint32(2246822519)
    for span in (1, 2, 4, 8):  # h[i] becomes the sum of the last 2 * span units, each shifted by its distance
        h[span:] += h[:-span] << np.uint32(span)
    found = (np.flatnonzero(h >> np.uint32(32 - MASK_BITS) == 0) + 1).tolist()
    if not found or found[-1] != len(text):
        found.append(len(text))
    return found


class Chunk:
    """A chunk's ids between its outermost safe places, and the words at the core's ends."""

    __slots__ = ("core", "first", "head", "last", "tail", "text")

    def __init__(self, text: str, known: Pieces):
        self.text = text
        safe = [m.start() for m in _SAFE.finditer(text)]
        if len(safe) < 3:
            self.core = None
            return
        self.head, self.tail = text[: safe[0]], text[safe[-1] :]
        self.first, self.last = text[safe[0] : safe[1]], text[safe[-2] : safe[-1]]
        self.core = known.ids(text[safe[0] : safe[-1]])


class ChunkEncoder:
    """Encodes texts by their chunks, each distinct one once while the bounds hold it."""

    def __init__(self, known: Pieces):
        self.known, self.held, self.older, self.size = known, {}, {}, 0

    def chunk(self, text: str) -> Chunk:
        found = self.held.get(text)
        if found is None:
            if len(self.held) >= CHUNKS_HELD or self.size > BYTES_HELD:  # two generations: what is met again stays
                self.held, self.older, self.size = {}, self.held, 0
            found = self.held[text] = self.older.get(text) or Chunk(text, self.known)
            self.size += 2 * len(text) + len(found.core or b"")
        return found

    def seam(self, left: Chunk | None, right: Chunk | None) -> bytes | None:
        """The ids between two cores (or a core and the text's end); None if they don't agree with the cores."""
        ids = self.known.ids
        before = ids(left.last) if left else b""
        after = ids(right.first) if right else b""
        found = ids((left.last + left.tail if left else "") + (right.head + right.first if right else ""))
        if len(found) < len(before) + len(after) or found[: len(before)] != before or found[len(found) - len(after) :] != after:
            return None
        return found[len(before) : len(found) - len(after)]

    def encode(self, text: str) -> bytes:
        done: list[tuple[Chunk, bytes]] = []

        def place(right: Chunk) -> None:
            while (between := self.seam(done[-1][0] if done else None, right)) is None:
                if not done:  # no word to agree on: the text as a whole is left
                    right.core = None
                    break
                right = Chunk(done.pop()[0].text + right.text, self.known)
            done.append((right, between))

        at, waiting, safe = 0, [], 0
        for cut in cuts(text) if text else ():
            piece, at = text[at:cut], cut
            if not waiting:
                right = self.chunk(piece)
                if right.core is not None:
                    place(right)
                    continue
            # pieces without three safe places wait until together they have them, and are cut anew only then
            safe += len(_SAFE.findall((waiting[-1][-1:] if waiting else "") + piece))
            waiting.append(piece)
            if safe >= 3:
                right = self.chunk("".join(waiting))
                waiting, safe = ([], 0) if right.core is not None else ([right.text], safe)
                if right.core is not None:
                    place(right)
        if waiting and done:
            place(Chunk(done.pop()[0].text + "".join(waiting), self.known))
        end = self.seam(done[-1][0], None) if done else None
        if end is None or any(c.core is None for c, _ in done):
            return self.known.ids(text)
        return b"".join(x for c, between in done for x in (between, c.core)) + end


def decoder(known: Pieces):
    """As the library decodes ids with special tokens kept; without a decoder of its own, tokens joined by blanks."""
    if known.tokenizer.decoder is not None:
        return lambda ids: known.tokenizer.decode(ids, skip_special_tokens=False)
    names = [known.tokenizer.id_to_token(i) for i in range(known.size)]
    if any(n is None for n in names):
        return lambda ids: known.tokenizer.decode(ids, skip_special_tokens=False)
    return lambda ids: SEPARATOR.join(map(names.__getitem__, ids))


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """``doc_id, ids, decoded`` for every row, or with ``digests`` ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""

    @lean
    def run(batches):
        known = pieces(path)
        encoder, decode = ChunkEncoder(known), decoder(known)
        decimals = [str(i) for i in range(known.size)]

        def digest(text: str) -> str:
            return hashlib.sha256(text.encode()).hexdigest()

        try:
            for part in (p for batch in batches for p in slices(batch, 1, 1 << 18)):
                texts = part.column(1).to_pylist()
                made = []
                for t in texts:
                    ids = known.unpack(encoder.encode(t or "")).tolist()
                    if digests:
                        made.append((len(ids), digest(" ".join(map(decimals.__getitem__, ids))), digest(decode(ids))))
                    else:
                        made.append((ids, decode(ids)))
                kinds = (pa.int64(), pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "ids", "decoded"])
        finally:
            known.forget()

    kind = dict(docs.dtypes)[id_col]
    shape = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, {shape}")


def tokenizer_path() -> str:
    """The public vocabulary of the registered queries; any other is a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path(), digests=True)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: digests of each document's ids and of what they decode to; a null text counts as empty, every row stays."""
    return encoded(docs, tokenizer_path(), digests=True)
