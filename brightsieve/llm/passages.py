"""Substring dedup: near-duplicate passages through compact windows.

A passage is at least 50 words long; two are near-duplicates if their sets of
5-word shingles have a Jaccard similarity of 0.8 or more, in the same order.
The Cartesian tree over a text's shingle hashes gives its compact windows (Deng
et al., "Allign"): (l, c, r) such that every passage that begins in l..c and
ends in c..r has its least hash at c.

One hash function is enough, for this reason. A changed, added or missing word
costs at least 9 shingles (4 and 5), so that like passages with t shingles in
common have at most t / 36 breaks, and some run of at least t / (1 + t / 36)
>= 20.5 shingles is the same in both. The windows of 21 shingles or more that
hold that run have their least hash at the same place of it, and the 10
shingles before or after that place are the same, too. Texts that share neither
aren't compared, so that a line of under 15 words brings none together. By the
same count, if a passage of several runs is like another, so is a part of it
that has two runs and one gap, or one run of 46 shingles (or of 41 with 5 more on
either side); a part of it with the place in it lies within REACH shingles of the place. So
whether texts have like passages through a place is told by the run through it
and the next run on either side, for every length of gap that can be made up for.
(Passages that have a sequence of four words twice may be missed by this count.)

Equal passages of 50 words around a place link their texts first, each with the
least, by aggregation. Groups whose texts these links already connect are done;
near copies and their passages are so. In the others all pairs are compared if
they have FEW members at most; how larger ones are split without all pairs and
without a lost link is told at ``_levels``.

Equal texts are one node throughout (64-bit hash). Defined cases: null and
short texts (under 50 words) have no windows, and share a class only with equal
texts; a passage repeated within one text is no link; repeated rows come back
as given; an empty table gives an empty result; a null id gets its class but
names none (ties go to the least id); other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightsieve.llm.base import drop_written, lean, slices, texts_of, written
from brightsieve.llm.components import class_names, connected

PASSAGE, SHINGLE = 50, 5
SIMILAR = 0.8
#: Shingles of an identical passage, of the run that like passages share at least, and on either side of a place in a signature.
CORE, RUN, SIDE = PASSAGE - SHINGLE + 1, 21, 10
#: Shingles in common that a passage of the least length has at least, with what lengthens it counted as apart.
LEAST = 30
#: Shingles that a gap takes in both texts together: beyond, runs that would make up for it hold an identical passage.
GAPS = 2 * CORE // 4
#: Shingles on either side of a place that a passage of two runs can need: four for each of the gap's, and the gap.
REACH = 4 * GAPS + GAPS - 4
#: Members of a group of which all pairs are compared.
FEW = 64
#: Rounds in which larger groups are compared with some of their rows first.
ROUNDS = 2
#: Times FEW rows of a group beyond its largest component that are compared with all of it at once.
OUTSIDERS = 4
SLICE = 1 << 20
#: Hashes up to this many are broadcast to keep other texts out of a shuffle.
BROADCAST_ROWS = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingles(texts: list[bytes]):
    """Slices of texts: (first text, shingle hashes of the slice, where each text's begin; the end is last)."""
    at = 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held + len(texts[to]) < SLICE):
            held += len(texts[to])
            to += 1
        group = texts[at:to]
        with np.errstate(over="ignore"):
            raw = _LOWER[np.frombuffer(b" ".join(group) + b" ", np.uint8)]
            ends = np.cumsum([len(t) + 1 for t in group])
            word = _WORD[raw].astype(np.int8)
            edge = np.diff(np.r_[np.int8(0), word])
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            total = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw)))]
            words = _mix((total[last] - total[first]) * _powers(_INVERSE, len(raw) + 1)[first])
            counts = np.diff(np.r_[0, np.searchsorted(first, ends)])
            joint = np.zeros(max(len(words) - SHINGLE + 1, 0), np.uint64)
            for k in range(SHINGLE):
                joint = joint * _BASE + words[k : k + len(joint)]
            joint = _mix(joint)
        begins = np.r_[0, np.cumsum(counts)[:-1]].astype(np.int64)
        own = np.maximum(counts - SHINGLE + 1, 0)
        keep = np.repeat(begins - np.r_[0, np.cumsum(own)[:-1]], own) + np.arange(own.sum())
        yield at, joint[keep], np.r_[0, np.cumsum(own)]
        at = to


def compact_windows(values: np.ndarray, starts: np.ndarray, least: int):
    """All (l, c, r) at least ``least`` wide of the Cartesian trees over values[starts[i]:starts[i+1]], level by level.

    The position takes a value's low bits, so that a minimum tells its place; the leftmost of equals wins.
    """
    place = np.uint64((1 << len(values).bit_length()) - 1)
    v = np.r_[(values & ~place) | np.arange(len(values), dtype=np.uint64), ~np.uint64(0)]
    lo, hi = starts[:-1].astype(np.int64), starts[1:].astype(np.int64)
    found = []
    while True:
        wide = hi - lo >= least
        lo, hi = lo[wide], hi[wide]
        if not len(lo):
            break
        c = (np.minimum.reduceat(v, np.column_stack((lo, hi)).ravel())[::2] & place).astype(np.int64)
        found.append((lo, c, hi - 1))
        lo, hi = np.column_stack((lo, c + 1)).ravel(), np.column_stack((c, hi)).ravel()
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found))


def _runs_hash(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` shingles that begin at each place of ``at``."""
    total = np.r_[np.uint64(0), np.cumsum(h * _powers(_BASE, len(h)))]
    return _mix((total[at + n] - total[at]) * _powers(_INVERSE, len(h) + 1)[at] + np.uint64(n))


def _steady(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """False where a text stutters (a shingle returns within four places), but for the first place of such a stretch that has CORE / 2 before it."""
    owner, again = np.repeat(np.arange(len(starts) - 1), np.diff(starts)), np.zeros(len(h), bool)
    for k in range(1, SHINGLE):
        again[k:] |= (h[k:] == h[:-k]) & (owner[k:] == owner[:-k])
    at = np.arange(len(h))
    since = at - np.maximum.accumulate(np.where(again, -1, at))
    return ~again | (since == CORE // 2 + SHINGLE)


def windows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``key, sides, core, node, place`` for each compact window that can hold a run of RUN shingles.

    ``key`` is the least shingle, ``sides`` 32 bits each for it with the SIDE shingles before it and those after,
    ``core`` the CORE shingles around it (0: they pass the text's end).
    """

    @lean
    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                nodes = part.column(0).to_numpy()
                _, once = np.unique(nodes, return_index=True)  # equal texts of a batch are read once
                texts = texts_of(part, 1)
                texts, nodes = [texts[i] for i in once], nodes[once]
                for at, h, starts in shingles(texts):
                    with np.errstate(over="ignore"):
                        values = _mix(h + _BASE)
                        _, c, _ = compact_windows(values, starts, RUN)
                        owner = np.searchsorted(starts, c, side="right") - 1
                        first, end = starts[owner], starts[owner + 1]
                        able = (end - first > PASSAGE - SHINGLE) & _steady(h, starts)[c]
                        c, owner, first, end = c[able], owner[able], first[able], end[able]
                        if not len(c):
                            continue
                        left = np.where(c - SIDE >= first, _runs_hash(h, np.maximum(c - SIDE, 0), SIDE + 1) >> np.uint64(32) | np.uint64(1), np.uint64(0))
                        right = np.where(c + SIDE < end, _runs_hash(h, np.minimum(c, len(h) - SIDE - 1), SIDE + 1) >> np.uint64(32) | np.uint64(1), np.uint64(0))
                        begin = c - CORE // 2
                        whole = (begin >= first) & (begin + CORE <= end)
                        core = np.where(whole, _runs_hash(h, np.clip(begin, 0, len(h) - CORE), CORE), np.uint64(0))
                    sides = left << np.uint64(32) | right
                    # of a stretch that repeats itself the places with the same surroundings are one
                    order = np.argsort(c)
                    a, b = order[:-1], order[1:]
                    again = (owner[a] == owner[b]) & (c[b] - c[a] < RUN) & (values[c[a]] == values[c[b]]) & (sides[a] == sides[b]) & (core[a] == core[b])
                    keep = np.ones(len(c), bool)
                    keep[b[again]] = False
                    c, owner, first, sides, core = c[keep], owner[keep], first[keep], sides[keep], core[keep]
                    columns = [values[c].view(np.int64), sides.view(np.int64), core.view(np.int64), nodes[at + owner], (c - first).astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "sides", "core", "node", "place"])

    rows = docs.select(F.xxhash64(text_col).alias("node"), F.col(text_col).cast("string").alias("text"))
    return rows.where(F.length("text") >= 2 * PASSAGE - 1).mapInArrow(run, "key long, sides long, core long, node long, place int")


def _shared(rows: DataFrame, by: str, what: str) -> DataFrame:
    """The values of ``by`` that rows of two or more ``what`` have: counted before the shuffle, so that a hot value is a few rows."""
    return rows.groupBy(by).agg(F.min(what).alias("__least"), F.max(what).alias("__most")).where("__least != __most")


def contexts(docs: DataFrame, asked: DataFrame, text_col: str = "text") -> DataFrame:
    """``node, place, ctx``: the shingles within REACH of each asked (node, place), as 32-bit hashes; 0 beyond the text's ends."""
    packed = asked.groupBy("node").agg(F.collect_set("place").alias("places"))  # no more than the text has windows
    packed = written(packed.select(F.col("node").alias("pn"), "places"), "asked")
    text = docs.select(F.xxhash64(text_col).alias("node"), F.col(text_col).cast("string").alias("text"))
    if packed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # eight bytes a row
        text = text.join(F.broadcast(packed.select("pn")), F.col("node") == F.col("pn"), "left_semi")
    text = text.dropDuplicates(["node"])

    @lean
    def cut(batches):
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                nodes, places = part.column(0).to_pylist(), part.column(2).to_pylist()
                for at, h, starts in shingles(texts_of(part, 1)):
                    h = (h >> np.uint64(32)).astype(np.uint32)
                    h[h == 0] = 1
                    for i in range(len(starts) - 1):
                        own = np.r_[np.zeros(REACH, np.uint32), h[starts[i] : starts[i + 1]], np.zeros(REACH, np.uint32)]
                        mine = np.array(places[at + i], np.int32)
                        for lo in range(0, len(mine), 2048):
                            some = mine[lo : lo + 2048]
                            rows = own[some[:, None] + np.arange(2 * REACH + 1)]
                            ctx = pa.array([r.tobytes() for r in rows], pa.binary())
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), nodes[at + i])), pa.array(some), ctx], ["node", "place", "ctx"])

    return text.join(packed, F.col("node") == F.col("pn")).select("node", "text", "places").mapInArrow(cut, "node long, place int, ctx binary")


def _run_length(equal: np.ndarray) -> np.ndarray:
    """How many of each row are true before the first that isn't."""
    return np.where(equal.all(axis=1), equal.shape[1], equal.argmin(axis=1))


#: Gaps in both texts, words changed in place first, short ones first.
_GAPS = sorted(((gx, gy) for gx in range(GAPS + 1) for gy in range(GAPS + 1 - gx) if gx + gy), key=lambda g: (abs(g[0] - g[1]), g))


def _second(x: np.ndarray, y: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Whether a run of ``own`` shingles that ends before column 0 of x and y, a gap, and a second run are like passages."""
    found = np.zeros(len(x), bool)
    need = PASSAGE - SHINGLE + 1
    x, y = x.astype(np.int64), np.where(y == 0, -1, y.astype(np.int64))
    for gx, gy in _GAPS:
        todo = np.flatnonzero(~found & (own + CORE >= 4 * (gx + gy)))
        if not len(todo):
            continue
        begins = x[todo, gx] == y[todo, gy]
        todo = todo[begins]
        if not len(todo):
            continue
        t = own[todo] + _run_length(x[todo, gx : gx + CORE] == y[todo, gy : gy + CORE])
        apart = gx + gy + np.maximum(need - t - gx, 0) + np.maximum(need - t - gy, 0)
        found[todo[t >= SIMILAR * (t + apart) - 1e-9]] = True
    return found


def _in_common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """At least as many as the different shingles that both rows have."""
    both = np.sort(np.concatenate([x, y], axis=1), axis=1)
    return ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] != 0)).sum(axis=1)


def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the contexts in each row of x and y hold like passages through their middle shingle."""
    equal = (x == y) & (x != 0)
    right, left = _run_length(equal[:, REACH:]), _run_length(equal[:, REACH::-1])
    own = right + left - 1
    same = own >= CORE
    short = np.flatnonzero(~same & (own >= RUN) & (right > 0))
    short = short[_in_common(x[short], y[short]) >= LEAST] if len(short) else short
    if len(short):
        x, y, own, left, right = x[short], y[short], own[short], left[short], right[short]
        place = np.arange(len(short))[:, None]
        width = np.arange(CORE + GAPS)
        beyond = np.pad(x, ((0, 0), (0, CORE + GAPS))), np.pad(y, ((0, 0), (0, CORE + GAPS)))
        after = [b[place, REACH + right[:, None] + width] for b in beyond]
        beyond = np.pad(x[:, ::-1], ((0, 0), (0, CORE + GAPS))), np.pad(y[:, ::-1], ((0, 0), (0, CORE + GAPS)))
        before = [b[place, REACH + left[:, None] + width] for b in beyond]
        # a run in a passage of the least length: its distinct shingles against those that are not shared
        many = np.flatnonzero(own >= SIMILAR / (2 - SIMILAR) * (PASSAGE - SHINGLE + 1))
        single = np.zeros(len(short), bool)
        for i in many.tolist():
            kinds = len(np.unique(x[i, REACH - left[i] + 1 : REACH + right[i]]))
            single[i] = kinds >= SIMILAR * (kinds + 2 * (CORE - own[i])) - 1e-9
        same[short] = single | _second(*after, own) | _second(*before, own)
    return same


def _group_links(groups: DataFrame) -> DataFrame:
    """``x, y, cx, cy``: items with like passages, and their components, that connect each group (about FEW rows) as all its pairs would; those of one component aren't compared."""

    def told(rows):
        if not rows[0]:
            return None
        sig, item, comp = (np.array(r, np.int64) for r in rows[:3])
        ctx = np.frombuffer(b"".join(rows[3]), np.uint32).reshape(len(sig), -1)
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        ends = np.repeat(np.r_[starts[1:], len(sig)], np.diff(np.r_[starts, len(sig)]))
        after = ends - np.arange(len(sig)) - 1
        i = np.repeat(np.arange(len(sig)), after)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.r_[0, np.cumsum(after)[:-1]], after)
        odd = comp[i] != comp[j]
        i, j = i[odd], j[odd]
        good = [alike(ctx[i[k : k + 4096]], ctx[j[k : k + 4096]]) for k in range(0, len(i), 4096)]
        keep = np.concatenate(good) if good else np.zeros(0, bool)
        parent, tied = list(range(len(sig))), []
        for a, b in zip(i[keep].tolist(), j[keep].tolist()):  # links that tie what others tie already are left out
            x, y = a, b
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            if x != y:
                parent[max(x, y)] = min(x, y)
                tied.append((a, b))
        a, b = np.array(tied, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (item[a], item[b], comp[a], comp[b])], ["x", "y", "cx", "cy"])

    @lean
    def run(batches):
        held = [[], [], [], []]
        for batch in batches:
            for part in slices(batch, 3, 2 << 20):
                columns = [c.to_pylist() for c in part.columns]
                # rows of the last group wait for the rest of it
                cut = next((k for k in range(len(columns[0]), 0, -1) if columns[0][k - 1] != columns[0][-1]), 0)
                if cut or (held[0] and held[0][-1] != columns[0][0]):
                    for h, c in zip(held, columns):
                        h += c[:cut]
                    made = told(held)
                    if made is not None:
                        yield made
                    held = [[], [], [], []]
                for h, c in zip(held, columns):
                    h += c[cut:]
        made = told(held)
        if made is not None:
            yield made

    rows = groups.select("sig", "item", "comp", "ctx").repartition("sig").sortWithinPartitions("sig")
    return rows.mapInArrow(run, "x long, y long, cx long, cy long")


def _self_alike(items: DataFrame) -> DataFrame:
    """``item`` of the contexts (what their members share; 0 elsewhere) that hold a passage whatever stands at the zeros."""

    @lean
    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, 2 << 20):
                ctx = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(len(part), -1)
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(alike(ctx, ctx)))], ["item"])

    return items.select("item", "ctx").mapInArrow(run, "item long")


def _levels(crowded: DataFrame) -> DataFrame:
    """``x, y``: links within groups of more than FEW rows (sig, item, comp, ctx), without pairing all of them.

    A shingle that FEW members or fewer of a group have makes a group of its own, in which all pairs are compared. What
    the others, frequent ones, link depends on them alone: members with the same frequent shingles at the same places
    are one item with zeros elsewhere, and such items make a group again, until groups are small. Items that are alike
    link all their members, as does an item that is like itself.
    """
    members, found = _pivoted(written(crowded, "crowded"))
    known = None  # item of this level -> first-level item
    while members.limit(1).count():

        @lean
        def opened(batches):
            for batch in batches:
                for part in slices(batch, 2, 1 << 20):
                    ctx = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint32).reshape(len(part), -1)
                    order = np.sort(ctx, axis=1)
                    new = (order != 0) & np.c_[np.ones(len(order), bool), order[:, 1:] != order[:, :-1]]
                    row, at = np.nonzero(new)
                    columns = [part.column(0).take(pa.array(row)), pa.array(order[row, at].view(np.int32)), part.column(1).take(pa.array(row))]
                    yield pa.RecordBatch.from_arrays(columns, ["sig", "s", "item"])

        every = written(members.select("sig", "item", "ctx").mapInArrow(opened, "sig long, s int, item long"), "opened")
        times = every.groupBy("sig", "s").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("item").cast("decimal(38,0)")).alias("who")).where("n > 1")
        times = written(times, "times")
        # shingles with the same holders make one group
        rare = times.where(F.col("n") <= FEW).groupBy("sig", "who", "n").agg(F.min("s").alias("s")).select("sig", "s")
        small = every.join(rare, ["sig", "s"]).join(members, ["sig", "item"]).select(F.xxhash64("sig", "s").alias("sig"), "item", "comp", "ctx")
        links = [_group_links(small).select("x", "y")]
        frequent = every.join(times.where(F.col("n") > FEW).select("sig", "s"), ["sig", "s"], "left_semi")
        frequent = frequent.groupBy("sig", "item").agg(F.collect_set("s").alias("kept"))  # no more than a context has

        @lean
        def masked(batches):
            for batch in batches:
                for part in slices(batch, 3, 1 << 20):
                    rows = []
                    for ctx, kept in zip(part.column(3).to_pylist(), part.column(4).to_pylist()):
                        own = np.frombuffer(ctx, np.uint32)
                        rows.append(np.where(np.isin(own.view(np.int32), np.array(kept or [], np.int32)), own, np.uint32(0)).tobytes())
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(rows, pa.binary())], ["sig", "item", "comp", "ctx"])

        told = members.join(frequent, ["sig", "item"]).select("sig", "item", "comp", "ctx", "kept")
        told = written(told.mapInArrow(masked, "sig long, item long, comp long, ctx binary").withColumn("as", F.xxhash64("sig", "ctx")), "masked")
        items = told.groupBy("as").agg(
            F.min("sig").alias("sig"), F.first("ctx").alias("ctx"), F.count(F.lit(1)).alias("n"), F.min("comp").alias("least"), F.max("comp").alias("most"),
        )
        # items of several components are of none: a name of their own
        items = written(items.select("sig", F.col("as").alias("item"), F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(F.col("as")).alias("comp"), "ctx", "n", "least", "most"), "items")
        below = known
        step = told.select(F.col("as").alias("item"), F.col("item").alias("base"))
        known = written(step if below is None else step.select("item", F.col("base").alias("mid")).join(below.select(F.col("item").alias("mid"), "base"), "mid").select("item", "base").distinct(), "known")
        sizes = items.groupBy("sig").agg(F.count(F.lit(1)).alias("items"))
        before = members.groupBy("sig").agg(F.count(F.lit(1)).alias("held"))
        sizes = written(sizes.join(before, "sig"), "sizes")
        stuck = items.join(sizes.where((F.col("items") > FEW) & (F.col("items") >= F.col("held"))).select("sig"), "sig", "left_semi")
        few = items.join(sizes.where(F.col("items") <= FEW).select("sig"), "sig", "left_semi")
        upper = _group_links(few).select("x", "y")
        if stuck.limit(1).count():  # all have frequent shingles in orders of their own: compared in blocks
            upper = upper.unionByName(_group_links(_blocks(stuck)).select("x", "y"))
        own = _self_alike(items.where("least != most")).select(F.col("item").alias("x"), F.col("item").alias("y"))
        upper = written(upper.unionByName(own), "upper")
        for link in links:
            found.append(written(link if below is None else _expanded(link, below), "links"))
        found.append(written(_expanded(upper, known), "links"))
        again = sizes.where((F.col("items") > FEW) & (F.col("items") < F.col("held"))).select("sig")
        members = written(items.join(again, "sig", "left_semi").select("sig", "item", "comp", "ctx"), "crowded")
    out = found[0] if found else crowded.select(F.col("item").alias("x"), F.col("item").alias("y")).limit(0)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _expanded(links: DataFrame, known: DataFrame) -> DataFrame:
    """Links between items as links of all their members with the first member of the other item."""
    first = known.groupBy("item").agg(F.min("base").alias("first"))
    both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    to = both.join(first.withColumnRenamed("item", "y"), "y").select("x", "first")
    return known.withColumnRenamed("item", "x").join(to, "x").select(F.col("base").alias("x"), F.col("first").alias("y")).where("x != y").distinct()


def _against(members: DataFrame, chosen) -> DataFrame:
    """``members`` (with n, the rows of a sig) as groups in which the chosen rows of a sig meet all its rows: they go to each block of FEW / 2 rows or so."""
    blocks = F.ceil(F.col("n") / (FEW // 2)).cast("int")
    held = members.withColumn("blocks", blocks)
    own = F.array(F.pmod(F.xxhash64("item", F.lit(-1)), F.col("blocks")).cast("int"))
    dealt = held.withColumn("block", F.explode(F.when(chosen, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(own)))
    return dealt.select(F.xxhash64("sig", "block").alias("sig"), "item", "comp", "ctx")


def _pivoted(members: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``members`` with larger components and without the groups that are done, and the links found on the way.

    A group with OUTSIDERS times FEW rows at most beyond its largest component is done by comparing those with all its rows. In the
    others the rows are compared with some FEW / 2 of them, drawn by hash, which joins nearly all in a group of near copies;
    that is done ROUNDS times at most, and what is left after it is for the exact ways of ``_levels``.
    """
    found = []
    for turn in range(ROUNDS + 1):
        per = members.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("sig")
        sizes = written(per.agg(F.sum("k").alias("n"), F.max("k").alias("most"), F.max_by("comp", "k").alias("top")), "sizes")
        held = members.join(sizes.where("n > most"), "sig")
        nearly = F.col("n") - F.col("most") <= OUTSIDERS * FEW
        found.append(written(_group_links(_against(held.where(nearly), F.col("comp") != F.col("top"))).select("x", "y"), "outsiders"))
        members = written(held.where(~nearly).select("sig", "item", "comp", "ctx", "n"), "crowded")
        if turn == ROUNDS or not members.limit(1).count():
            break
        draw = F.pmod(F.xxhash64("item", F.lit(turn)), F.col("n"))
        # what ties a component is found already, so that one link of two is enough: groups of the same texts have many
        new = _group_links(_against(members, draw < FEW // 2)).groupBy(F.least("cx", "cy").alias("cx"), F.greatest("cx", "cy").alias("cy"))
        new = written(new.agg(F.min(F.struct("x", "y")).alias("l")).select("l.x", "l.y", "cx", "cy"), "pivoted")
        if not new.limit(1).count():
            break
        found.append(new.select("x", "y"))
        roots = connected(new, "cx", "cy").select(F.col("node").alias("comp"), "root")
        members = written(members.join(roots, "comp", "left").select("sig", "item", F.coalesce("root", "comp").alias("comp"), "ctx"), "crowded")
    return members.select("sig", "item", "comp", "ctx"), found


def _blocks(items: DataFrame) -> DataFrame:
    """Groups of FEW rows or fewer such that any two rows of a sig and of two components meet in one: pairs of blocks of FEW / 2, but for those of one component."""
    order = W.partitionBy("sig").orderBy("comp", "item")
    held = items.select("sig", "item", "comp", "ctx").withColumn("block", ((F.row_number().over(order) - 1) / (FEW // 2)).cast("int"))
    blocks = held.groupBy("sig", "block").agg(F.min("comp").alias("l"), F.max("comp").alias("m"))
    one, two = (blocks.select("sig", *[F.col(c).alias(f"{c}{k}") for c in ("block", "l", "m")]) for k in (1, 2))
    able = (F.col("block1") <= F.col("block2")) & ~((F.col("l1") == F.col("m1")) & (F.col("l2") == F.col("m2")) & (F.col("l1") == F.col("l2")))
    pairs = one.join(two, "sig").where(able).select("sig", "block1", "block2")
    to = pairs.select("sig", F.xxhash64("sig", "block1", "block2").alias("pair"), F.explode(F.array_distinct(F.array("block1", "block2"))).alias("block"))
    return held.join(to, ["sig", "block"]).select(F.col("pair").alias("sig"), "item", "comp", "ctx")


def links(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``a, b``: texts (by hash) with like passages; together they connect what all pairs would."""
    every = written(windows(docs, text_col), "windows")
    rows = written(every.join(_shared(every, "key", "node").select("key").hint("shuffle_hash"), "key", "left_semi"), "shared")
    drop_written(every)
    # equal passages around a place: each with the first
    cores = _shared(rows.where("core != 0"), "core", "node").select("core", F.col("__least").alias("a"))
    equal = written(rows.join(cores.hint("shuffle_hash"), "core").select("a", F.col("node").alias("b")).where("a != b").distinct(), "equal")
    comps = connected(equal, "a", "b").select(F.col("node").alias("cn"), "root")
    told = rows.select("key", "sides", "node", "place").join(comps, F.col("node") == F.col("cn"), "left")
    side = F.explode(F.array(F.struct(F.lit(0).alias("k"), F.shiftrightunsigned("sides", 32).alias("s")), F.struct(F.lit(1).alias("k"), F.col("sides").bitwiseAND(0xFFFFFFFF).alias("s"))))
    told = told.select("key", "node", "place", F.coalesce("root", "node").alias("comp"), side.alias("d")).where("d.s != 0")
    told = written(told.select(F.xxhash64("key", "d.k", "d.s").alias("sig"), "node", "place", "comp"), "sides")
    meeting = written(told.join(_shared(told, "sig", "comp").select("sig").hint("shuffle_hash"), "sig", "left_semi").distinct(), "meeting")
    drop_written(told)
    around = written(contexts(docs, meeting.select("node", "place").distinct(), text_col).withColumn("ch", F.xxhash64("ctx")), "contexts")
    # equal contexts of a group are one item
    met = meeting.join(around.select("node", "place", "ch"), ["node", "place"]).groupBy("sig", "ch").agg(F.min(F.struct("node", "place", "comp")).alias("m"))
    item = F.xxhash64("m.node", "m.place")
    met = written(met.select("sig", "m.node", "m.place", "m.comp", item.alias("item")), "met")
    sizes = met.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("l"), F.max("comp").alias("m")).where("l != m").select("sig", "n")
    met = met.join(sizes.hint("shuffle_hash"), "sig").join(around, ["node", "place"]).select("sig", "item", "comp", "ctx", "n")
    met = written(met, "groups")
    found = written(_group_links(met.where(F.col("n") <= FEW)).select("x", "y"), "found")
    crowded = met.where(F.col("n") > FEW).drop("n")
    if crowded.limit(1).count():
        found = found.unionByName(_levels(crowded))
    names = written(meeting.select(F.xxhash64("node", "place").alias("item"), "node").distinct(), "names")
    named = found.join(names.select(F.col("item").alias("x"), F.col("node").alias("a")), "x").join(names.select(F.col("item").alias("y"), F.col("node").alias("b")), "y")
    named = named.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return written(named.unionByName(equal.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct(), "links")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, n_links, n_copies`` for every row of ``docs``.

    ``class_id`` is the least doc_id that links and equal texts reach, ``n_links`` the number of other texts
    that the row's text is tied to (those that tie its class, not all pairs), ``n_copies`` the rows with its text.
    """
    found = links(docs, text_col)
    ids = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("node")), "ids")
    nodes = ids.groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies"))
    ends = found.select(F.col("a").alias("e")).unionAll(found.select("b"))
    degree = ends.groupBy("e").agg(F.count(F.lit(1)).alias("n_links"))
    named = class_names(nodes.select("node", "least"), found)
    per = nodes.join(named.withColumnRenamed("node", "nn"), F.col("node") == F.col("nn")).join(degree, F.col("node") == F.col("e"), "left")
    per = per.select(F.col("node").alias("pn"), "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies")
    return ids.join(per, F.col("node") == F.col("pn")).select("doc_id", "class_id", "n_links", "n_copies")


def op10_passages(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
