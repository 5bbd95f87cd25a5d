"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes, and how often over the corpus.

Both tokenizers encode a blank and the text. Byte offsets where a token of either ends cut
them into groups; every token of A in a group is linked to every token of B in
it. A link is an id pair packed into 64 bits, A's id above B's.

Texts are encoded once, and their ids written. Counting: a task keeps ``np.unique``
counts of the pairs of its documents, each document's distinct ones, and hands
them on as rows (several times if they outgrow DISTINCT_HELD). These are range
partitioned by pair, so that each partition is a run of the sorted pairs; equal
pairs follow each other there and are summed run by run into a shard, two files
of sorted 64-bit pairs and their counts. A shard's task also tells the greatest
count of each A id that it saw; over all shards these are as many numbers as A
has ids. Looking up: workers map shards into memory (where the shared folder
isn't a file system of theirs, a shard is read, and the last few are kept) and
find pairs by ``searchsorted``. Links are listed for a batch of documents at once.

A long text is encoded in pieces that begin where white space of CUTS follows something
else: neither tokenizer joins anything over such a place (``Both`` checks that
against the vocabularies). A's ids come from tiktoken where the vocabulary's ids are its
merges in order and a text has no character beyond Latin letters, for which the regular expressions
of both libraries are sure to agree; else from the tokenizers library.

Defined cases: a null or empty text, and one that the tokens of A or B do not spell
byte for byte, has no tokens: zeros and an empty digest; texts of any length are
encoded whole; strings of special tokens are plain text; rows with equal ids or
texts are documents of their own; an empty table gives an empty result; other columns aren't
read; counts that tie for an A id's highest all count as best.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightsieve.llm.base import lean, new_path, remove, slices, written

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters of a text that are encoded at once; bytes of ids whose links are listed at once.
PIECE, IDS_HELD = 1 << 19, 1 << 18
#: Pairs, repeats included, that a task holds before it sums them, and distinct ones before it hands them on.
PAIRS_HELD, DISTINCT_HELD = 1 << 21, 1 << 20
#: Bytes of shards that a worker keeps where it can't map them.
READ_HELD = 64 << 20
#: Links of one group up to which they are listed one by one.
LISTED = 1 << 16
CUTS = " \n\t"
BLANK = "▁"
#: How byte-level BPE cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BEYOND_LATIN = re.compile("[^\\x00-\u024f]")


def _unescape() -> dict[str, int]:
    """Byte-level BPE's printable stand-ins: printable bytes stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Both:
    """Tokenizers A (byte-level BPE) and B (pieces with byte fallback), and what each id spells."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        stand = _unescape()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.a_bytes = [bytes(map(stand.__getitem__, n)) if all(c in stand for c in n) else n.encode() for n in names]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        ids = range(self.b.get_piece_size())
        pieces = [self.b.id_to_piece(i) for i in ids]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in zip(ids, pieces)]
        self.blank = self.b.piece_to_id(BLANK)
        spelt = [p.replace(BLANK, " ") for i, p in zip(ids, pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        #: White space that no piece has after something else; but for the blank itself, no piece has it beside anything.
        cuts = "".join(c for c in CUTS if not any(c in p[1:] and re.search(rf"[^{c}]{c}", p) or c != " " and c in p and len(p) > 1 for p in spelt))
        if " " not in cuts or self.blank == self.b.unk_id():
            raise ValueError("pieces of B go over blanks")
        self.place = re.compile(rf"(?<=\S)(?=[{cuts}])")
        self.a_size, self.b_size = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        self.kind = np.dtype("<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4")
        self.quick = self._quick(a_path)

    def _quick(self, path: str):
        """tiktoken with A's vocabulary, if that is bytes and then the merges in order, and words are cut as it can cut them."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        vocab, plain = model["vocab"], before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        odd = spec.get("normalizer") or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges")
        if model["type"] != "BPE" or not plain or odd or [vocab.get(x + y) for x, y in merges] != list(range(256, 256 + len(merges))) or len(vocab) != 256 + len(merges):
            return None
        import tiktoken

        ranks = {self.a_bytes[i]: i for i in range(len(vocab))}
        return tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == len(vocab) else None

    def pieces(self, text: str) -> Iterator[str]:
        """``text`` in parts that can be encoded one by one."""
        at = 0
        while at < len(text):
            found = self.place.search(text, at + PIECE) if len(text) - at > PIECE else None
            to = found.start() if found else len(text)
            yield text[at:to]
            at = to

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a blank and ``text``; None if they don't spell it."""
        a, b = [], []
        for piece in self.pieces(" " + text):
            own = self.quick.encode_ordinary(piece) if self.quick and not _BEYOND_LATIN.search(piece) else self.a.encode_batch_fast([piece], add_special_tokens=False)[0].ids
            # B adds a blank: the piece's own first one, or one that goes again
            other = self.b.encode(piece[1:] if piece[0] == " " else piece) if piece != " " else [self.blank]
            other = other if piece[0] == " " else other[1:]
            if not self.spells(piece, own, other):
                return None
            a += own
            b += other
        return np.array(a, self.kind), np.array(b, self.kind)

    def spells(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = text.encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw


_LOADED: dict[tuple[str, str], Both] = {}


def both(a_path: str, b_path: str) -> Both:
    """The tokenizers, loaded once in each Python worker."""
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Both(a_path, b_path)
    return _LOADED[a_path, b_path]


def groups(known: Both, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For tokens that spell the same bytes: where each group begins among those of A, and of B; their ends come last."""
    a_end, b_end = np.cumsum(known.a_size[a]), np.cumsum(known.b_size[b])
    at = np.searchsorted(b_end, a_end)
    both_end = np.flatnonzero(b_end[at] == a_end) if len(a_end) else np.empty(0, np.int64)
    return np.r_[0, both_end + 1], np.r_[0, at[both_end] + 1]


def links(a: np.ndarray, b: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed pairs, how often each is linked, and where each group's begin; a large group's equal pairs are told once."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    n_a, n_b = np.diff(a_at), np.diff(b_at)
    if (n_a * n_b).max(initial=0) <= LISTED:
        n = n_a * n_b
        upto = np.cumsum(n)
        place = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - n, n)
        wide = np.repeat(n_b, n)
        keys = a[np.repeat(a_at[:-1], n) + place // np.maximum(wide, 1)] << 32 | b[np.repeat(b_at[:-1], n) + place % np.maximum(wide, 1)]
        return keys, np.ones(len(keys), np.int64), np.r_[0, upto]
    keys, often, starts = [], [], [0]
    for k in range(len(n_a)):
        x, x_n = np.unique(a[a_at[k] : a_at[k + 1]], return_counts=True)
        y, y_n = np.unique(b[b_at[k] : b_at[k + 1]], return_counts=True)
        keys.append((x[:, None] << 32 | y).reshape(-1))
        often.append((x_n[:, None] * y_n).reshape(-1))
        starts.append(starts[-1] + len(keys[-1]))
    return np.concatenate(keys), np.concatenate(often), np.array(starts)


class Summed:
    """Pairs and counts, kept sorted and distinct once they are many."""

    def __init__(self):
        self.keys, self.counts, self.new, self.waiting = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def add(self, keys: np.ndarray) -> None:
        self.new.append(keys)
        self.waiting += len(keys)
        if self.waiting > PAIRS_HELD:
            self.sum()

    def sum(self) -> None:
        keys, back = np.unique(np.concatenate([self.keys, *self.new]), return_inverse=True)
        counts = np.bincount(back[len(self.keys) :], minlength=len(keys)).astype(np.int64)
        counts[back[: len(self.keys)]] += self.counts
        self.keys, self.counts, self.new, self.waiting = keys, counts, [], 0

    def taken(self) -> pa.RecordBatch:
        self.sum()
        out = pa.RecordBatch.from_arrays([pa.array(self.keys), pa.array(self.counts)], ["pair", "n"])
        self.__init__()
        return out


def tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, a, b`` of every row: ids of either tokenizer as little-endian integers, null where there are none."""

    @lean
    def run(batches):
        known = both(a_path, b_path)
        for part in (p for batch in batches for p in slices(batch, 1, 1 << 20)):
            made = [known.encode(t) if t else None for t in part.column(1).to_pylist()]
            columns = [pa.array([None if x is None else x[k].tobytes() for x in made], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "a", "b"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, a binary, b binary")


class Linked:
    """The links of a batch of ``tokens`` rows that have tokens."""

    def __init__(self, known: Both, a: pa.Array, b: pa.Array):
        self.rows = np.flatnonzero(a.is_valid().to_numpy(zero_copy_only=False))
        flat, cuts = [], []
        for column in (a, b):
            packed = [x for x in column.to_pylist() if x is not None]
            flat.append(np.frombuffer(b"".join(packed), known.kind).astype(np.int64))
            cuts.append(np.cumsum([0, *map(len, packed)]) // known.kind.itemsize)
        (self.a, self.b), (self.a_cut, self.b_cut) = flat, cuts
        self.a_at, self.b_at = groups(known, self.a, self.b)
        self.group_cut = np.searchsorted(self.a_at, self.a_cut)  # every document ends a group
        self.keys, self.often, at = links(self.a, self.b, self.a_at, self.b_at)
        self.cut = at[self.group_cut]

    def spelt(self, names: list[str]) -> Iterator[str]:
        """Each document's groups as text; ``names`` has each id with a comma, a bar and a semicolon after it."""
        n_a, n_b = np.diff(self.a_at), np.diff(self.b_at)
        out = np.empty(len(self.a) + len(self.b), np.int64)
        for ids, at, own, other, end in ((self.a, self.a_at, n_a, self.b_at[:-1], 1), (self.b, self.b_at, n_b, self.a_at[1:], 2)):
            value = 3 * ids
            value[at[1:] - 1] += end
            out[np.arange(len(ids)) + np.repeat(other, own)] = value
        for s, e in zip(self.a_cut + self.b_cut, (self.a_cut + self.b_cut)[1:]):
            yield "".join(map(names.__getitem__, out[s:e].tolist()))[:-1]


def pair_counts(held: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``pair, n``: each task's counts of documents by pair, in parts, from ``tokens`` rows."""

    @lean
    def run(batches):
        known, sums = both(a_path, b_path), Summed()
        for part in (p for batch in batches for p in slices(batch, 0, IDS_HELD)):
            found = Linked(known, part.column(0), part.column(1))
            for s, e in zip(found.cut, found.cut[1:]):
                sums.add(np.unique(found.keys[s:e]))
            if len(sums.keys) > DISTINCT_HELD:
                yield sums.taken()
        yield sums.taken()

    return held.select("a", "b").mapInArrow(run, "pair long, n long")


def _opened(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri)


def count_shards(partial: DataFrame, folder: str) -> tuple[list[tuple[str, int, int, int]], dict[int, int]]:
    """Sums ``pair, n`` (a written table) into sorted shards in ``folder``: (file, first pair, last pair, pairs) of each, in order, and the highest count of each A id."""

    @lean
    def run(batches):
        name = f"{folder}/{uuid.uuid4().hex}"
        fs, path = _opened(folder)
        files, last, many, first, best = None, None, 0, None, {}

        def put(keys: np.ndarray, counts: np.ndarray) -> None:
            nonlocal files, many, first
            if files is None:
                fs.create_dir(path, recursive=True)
                own = f"{path}/{name.rsplit('/', 1)[1]}"
                files, first = (fs.open_output_stream(f"{own}.pairs"), fs.open_output_stream(f"{own}.counts")), int(keys[0])
            files[0].write(keys.astype("<i8").tobytes())
            files[1].write(counts.astype("<i8").tobytes())
            many += len(keys)
            ids, at = np.unique(keys >> 32, return_index=True)
            for i, n in zip(ids.tolist(), np.maximum.reduceat(counts, at).tolist()):
                best[i] = max(n, best.get(i, 0))

        for batch in batches:
            if not len(batch):
                continue
            keys, counts = (batch.column(k).to_numpy() for k in (0, 1))
            if last is not None:
                keys, counts = np.r_[last[0], keys], np.r_[last[1], counts]
            at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            keys, counts = keys[at], np.add.reduceat(counts, at)
            last = int(keys[-1]), int(counts[-1])  # the next batch may go on with it
            if len(keys) > 1:
                put(keys[:-1], counts[:-1])
        if last is not None:
            put(np.array(last[:1]), np.array(last[1:]))
            for f in files:
                f.close()
            ids = sorted(best)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([first]), pa.array([last[0]]), pa.array([many]), pa.array([ids], pa.list_(pa.int64())), pa.array([[best[i] for i in ids]], pa.list_(pa.int64()))],
                ["file", "first", "last", "pairs", "ids", "best"],
            )

    parts = int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = partial.repartitionByRange(parts, "pair").sortWithinPartitions("pair").select("pair", "n")
    manifest = written(ordered.mapInArrow(run, "file string, first long, last long, pairs long, ids array<long>, best array<long>"), "shards")
    found, highest = [], {}
    for r in sorted(manifest.collect(), key=lambda r: r.first):
        found.append((r.file, r.first, r.last, r.pairs))
        for i, n in zip(r.ids, r.best):
            highest[i] = max(n, highest.get(i, 0))
    return found, highest


class Counts:
    """Looks packed pairs up in sorted shards."""

    def __init__(self, shards: list[tuple[str, int, int, int]], highest: np.ndarray):
        self.shards, self.highest = shards, highest
        self.last = np.array([s[2] for s in shards], np.int64)
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _shard(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in self.open:
            name, n = self.shards[k][0], self.shards[k][3]
            where = urlparse(name)
            if where.scheme in ("", "file"):
                self.open[k] = tuple(np.memmap(f"{where.path}.{what}", "<i8", "r", shape=(n,)) for what in ("pairs", "counts"))
            else:
                fs, path = _opened(name)
                while self.open and 16 * (n + sum(len(x) for x, _ in self.open.values())) > READ_HELD:
                    self.open.pop(next(iter(self.open)))
                self.open[k] = tuple(np.frombuffer(fs.open_input_stream(f"{path}.{what}").read(), "<i8") for what in ("pairs", "counts"))
        return self.open[k]

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each pair's count (0: no document with tokens has it), and whether it is the highest of its A id."""
        distinct, back = np.unique(keys, return_inverse=True)
        found = np.empty(len(distinct), np.int64)
        found[:] = 0
        if not self.shards:
            return found[back], np.zeros(len(keys), bool)
        shard = np.minimum(np.searchsorted(self.last, distinct), len(self.shards) - 1)
        at = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else []
        for s, e in zip(at, [*at[1:], len(shard)]):
            pairs, counts = self._shard(int(shard[s]))
            place = np.searchsorted(pairs, distinct[s:e])
            place = np.minimum(place, len(pairs) - 1)
            found[s:e] = np.where(pairs[place] == distinct[s:e], counts[place], 0)
        return found[back], (found == self.highest[np.minimum(distinct >> 32, len(self.highest) - 1)])[back]


def aligned(held: DataFrame, shards: list[tuple[str, int, int, int]], highest: dict[int, int], a_path: str, b_path: str, spelt: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``tokens``, and with ``spelt`` the groups themselves."""
    best = np.zeros(max(highest, default=0) + 1, np.int64)
    best[list(highest)] = list(highest.values())

    @lean
    def run(batches):
        known, counts = both(a_path, b_path), Counts(shards, best)
        names = [f"{i}{c}" for i in range(max(len(known.a_bytes), len(known.b_bytes))) for c in ",|;"]
        for part in (p for batch in batches for p in slices(batch, 1, IDS_HELD)):
            linked = Linked(known, part.column(1), part.column(2))
            numbers, texts = np.zeros((len(NAMES), len(part)), np.int64), [""] * len(part)
            if len(linked.rows):
                found, top = counts.of(linked.keys)
                if not found.all():
                    raise ValueError("a linked pair has no count: the shards are of other texts")
                sums = [np.add.reduceat(x, linked.cut[:-1]) for x in (linked.often, linked.often * top, linked.often * found)]
                numbers[:, linked.rows] = [np.diff(linked.a_cut), np.diff(linked.b_cut), np.diff(linked.group_cut), *sums]
                for k, text in zip(linked.rows.tolist(), linked.spelt(names)):
                    texts[k] = text
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
            columns = [part.column(0), *map(pa.array, numbers), pa.array(digests), *([pa.array(texts)] if spelt else [])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *NAMES, "groups_sha256", "groups"][: 8 + spelt])

    schema = f"doc_id {dict(held.dtypes)['doc_id']}, " + ", ".join(f"{n} long" for n in NAMES) + ", groups_sha256 string" + ", groups string" * spelt
    return held.select("doc_id", "a", "b").mapInArrow(run, schema)


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align(docs: DataFrame, a_path: str, b_path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", spelt: bool = False) -> DataFrame:
    """Encodes ``docs`` into a written table, counts its pairs into shards in ``folder`` and returns ``aligned`` rows that read both."""
    spark, path, pairs = docs.sparkSession, new_path(docs.sparkSession, "tokens"), new_path(docs.sparkSession, "pairs")
    made = tokens(docs, a_path, b_path, id_col, text_col)
    made.write.option("compression", "zstd").parquet(path)
    held = spark.read.schema(made.schema).parquet(path)
    pair_counts(held, a_path, b_path).write.parquet(pairs)
    shards, highest = count_shards(spark.read.schema("pair long, n long").parquet(pairs), folder or new_path(spark, "pair-shards"))
    remove(spark, pairs)
    return aligned(held, shards, highest, a_path, b_path, spelt)


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
