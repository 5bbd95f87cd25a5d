"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprints: a bit is 1 where over half of a text's 3-word shingles have it in
their XXH64. Linking: fingerprints within 3 bits agree wholly on at least one
choice of blocks of the 64 bits (three differences spoil at most three
blocks), so each distinct fingerprint is routed once for every choice. Within
a route, fingerprints are sorted by Gray rank, which puts like ones side by
side; runs of them form nodes that hold the bits all members share (mask and
pattern), runs of nodes form upper nodes. A search adds up differences on the
bits that a node shares beyond its parent's and drops the whole group once
they exceed the limit. Links found are joined up where they are found, so that
a group of m copies leaves m - 1 links, and components are closed over routes.

Defined cases: null and wordless texts have fingerprint 0 and link like any
other; texts of fewer than three words are one shingle; equal fingerprints are
one node; repeated rows come back as given; a null id takes no part in
choosing a component's id but gets it. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightsieve.llm.base import lean, sheltered, slices, texts_of, written
from brightsieve.llm.components import class_names

WORDS, SEED, BITS = 3, 42, 3
#: Children of a node of the index.
FAN = 16
#: Links compared at once.
FRONT = 1 << 20
#: Rows of a route beyond which it is routed once more by its remaining bits.
HOT = 20_000


def fingerprint(text: bytes | None) -> int:
    """The 64-bit SimHash of UTF-8 text."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and white space is \x20 and \x09-\x0D
    if not words:
        return 0
    if len(words) <= WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: 1 - WORDS].tolist()
    ends = (ends[WORDS - 1 :] - 1).tolist()
    total, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 1 << 16):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed long) for each row."""

    @lean
    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t) for part in slices(batch, 1) for t in texts_of(part, 1)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each 64-bit word in the reflected Gray code."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """The index over groups of fingerprints: rows are sorted by (group, Gray rank)."""

    def __init__(self, group: np.ndarray, fps: np.ndarray):
        self.order = np.lexsort((gray_rank(fps), group))
        self.fps, owner = fps[self.order], group[self.order]
        self.levels = [(self.fps, np.full(len(fps), ~np.uint64(0)), None, owner)]
        while True:
            pat, mask, _, own = self.levels[-1]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            if len(self.levels) > 1 and len(first) == len(own):
                break
            within = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
            cut = np.flatnonzero(within % FAN == 0)
            sizes = np.diff(np.r_[cut, len(own)])
            shared = np.bitwise_and.reduceat(mask, cut) & ~np.bitwise_or.reduceat(pat ^ np.repeat(pat[cut], sizes), cut)
            self.levels.append((pat[cut] & shared, shared, np.r_[cut, len(own)], own[cut]))
        _, top = np.unique(owner, return_inverse=True)
        self.top = top

    def pairs(self, limit: int):
        """Blocks of (i, j), i < j, of rows in order within ``limit`` bits in the same group."""
        x = self.fps
        # last leaf below every node, to leave out what lies before the query
        lasts = [np.arange(len(x))]
        for _, _, kids, _ in self.levels[1:]:
            lasts.append(lasts[-1][kids[1:] - 1])
        todo = [(len(self.levels) - 1, np.arange(len(x)), self.top, np.zeros(len(x), np.int64), None)]
        while todo:
            level, q, node, acc, above = todo.pop()
            if len(q) > FRONT:
                half = len(q) // 2
                todo += [(level, q[s], node[s], acc[s], None if above is None else above[s]) for s in (slice(0, half), slice(half, None))]
                continue
            pat, mask, kids, _ = self.levels[level]
            news = mask[node] if above is None else mask[node] & ~above
            acc = acc + np.bitwise_count((x[q] ^ pat[node]) & news)
            keep = (acc <= limit) & (lasts[level][node] > q)
            q, node, acc = q[keep], node[keep], acc[keep]
            if not len(q):
                continue
            if level == 0:
                yield q, node
                continue
            lo, n = kids[node], kids[node + 1] - kids[node]
            child = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            todo.append((level - 1, np.repeat(q, n), child, np.repeat(acc, n), np.repeat(mask[node], n)))


def join_up(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unites i and j in ``parent``, whose entries are roots (each root the least of its set)."""
    while True:
        a, b = parent[i], parent[j]
        odd = a != b
        if not odd.any():
            return
        i, j, a, b = i[odd], j[odd], a[odd], b[odd]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def link_groups(group: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each group: pairs of fingerprints."""
    index = GrayIndex(group, fps)
    parent = np.arange(len(fps))
    for i, j in index.pairs(limit):
        join_up(parent, i, j)
    far = np.flatnonzero(parent != np.arange(len(fps)))
    return index.fps[far], index.fps[parent[far]]


def _cuts(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` runs of the given bit places."""
    edges = [round(k * len(bits) / parts) for k in range(parts + 1)]
    return [sum(1 << b for b in bits[s:e]) for s, e in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def route_masks(n: int, limit: int) -> list[int]:
    """Masks of which at least one is whole between any two words within ``limit`` bits.

    The finer the masks, the smaller the groups and the more copies of a row: the
    first choice under which evenly spread words make groups of 64 at most.
    """
    for parts in range(limit + 1, 2 * limit + 1):
        cuts = _cuts(list(range(64)), parts)
        masks = [sum(c) for c in combinations(cuts, parts - limit)]
        if n >> min(m.bit_count() for m in masks) < 64:
            break
    return masks


def near_links(words: DataFrame, fp: str = "fp", limit: int = BITS) -> DataFrame:
    """``a, b``: links among distinct fingerprints that connect just what all links within ``limit`` bits connect."""
    masks = route_masks(words.count(), limit)
    routed = words.select(
        F.col(fp).alias("fp"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("route"), F.col(fp).bitwiseAND(F.lit(_signed(m))).alias("part")) for k, m in enumerate(masks)])).alias("r"),
    ).select("fp", "r.route", "r.part")
    crowded = routed.groupBy("route", "part").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > HOT)
    told = routed.join(crowded, ["route", "part"], "left")
    finer = F.lit(None)
    for k, m in enumerate(masks):
        rest = _cuts([b for b in range(64) if not m >> b & 1], limit + 1)
        finer = F.when(F.col("route") == k, F.array(*[F.struct(F.lit(s).alias("sub"), F.col("fp").bitwiseAND(F.lit(_signed(c))).alias("piece")) for s, c in enumerate(rest)])).otherwise(finer)
    whole = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("piece")))
    keyed = told.withColumn("d", F.explode(F.when(F.col("held").isNull(), whole).otherwise(finer))).select(
        "fp", F.xxhash64("route", "part", "d.sub", "d.piece").alias("grp")
    )

    @lean
    def run(batches):
        kept_g, kept_f = np.empty(0, np.int64), np.empty(0, np.uint64)

        def out(g, f):
            a, b = link_groups(g, f, limit)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            g = np.r_[kept_g, batch.column(1).to_numpy()]
            f = np.r_[kept_f, batch.column(0).to_numpy().view(np.uint64)]
            cut = int(np.searchsorted(g, g[-1])) if len(g) else 0
            if cut:
                yield out(g[:cut], f[:cut])
            kept_g, kept_f = g[cut:], f[cut:]
        if len(kept_g):
            yield out(kept_g, kept_f)

    return keyed.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "a long, b long")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    words = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "words")
    named = class_names(words.select(F.col("fp").alias("node"), "least"), near_links(words, "fp", limit))
    named = named.select(F.col("node").alias("fp"), F.col("class_id").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    return components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row stays, the one with the smallest id, then the least hash of its text.

    Rows without an id come last in that order, so that such a row stays only where its component has no id, and
    of repeated rows one stays. Null and wordless texts have fingerprint 0 and are one component. Only fingerprints
    are shuffled: the row kept is named by its place in the table, which is written for that.
    """
    return sheltered(docs, _kept)


def _kept(docs: DataFrame) -> DataFrame:
    held = docs.withColumn("__row", F.monotonically_increasing_id())
    names = docs.columns
    held = written(held, "near-dedup")  # a row's number must not change between reads
    found = components(held, "__row").select(F.col("doc_id").alias("__at"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.col("__row"))
    keys = held.select(order.alias("__order"), "__row")
    kept = keys.join(found, F.col("__row") == F.col("__at")).groupBy("component_id").agg(F.min("__order").alias("o")).select(F.col("o.__row").alias("__kept"))
    return held.join(kept, F.col("__row") == F.col("__kept"), "left_semi").select(names)
