"""Personal data: exact patterns, and terms that disclose what the patterns protect.

Patterns find the protected entities (e-mail, IP, card, phone). Which further
terms must go is a matter of information (Sanchez and Batet's C-sanitised
documents): a term t discloses an entity e when their pointwise mutual
information over the corpus reaches a share of what e itself tells,

    PMI(t; e) = log2(N n(t,e) / (n(t) n(e)))  >=  DISCLOSE * IC(e) = DISCLOSE * log2(N / n(e)).

A term is any run of letters or digits. It co-occurs with an entity wherever
the same text holds both, however far apart. n(t) counts the different texts of
the corpus that hold t, N all of them; n(t,e) and n(e) count those that hold e,
but texts in which e has the same surroundings (the CONTEXT characters on
either side) once, in n(t) as well, so that neither copies of a document, near
copies included, nor repeats within one are fresh evidence or dilute it. A pair counts if it has SUPPORT such
texts and n(t,e) PMI is EVIDENCE bits: what is so rare by chance is a
disclosure, and a frequent entity's company isn't. Every occurrence of such a
term in a text that holds e, outside the entities, is generalised to its kind
([NAME], [NUMBER], [TERM]), or removed where it gives e away almost fully.

All of it is DataFrame functions; Java's regular expressions are written so
that no text makes them backtrack over a long run or recurse. Defined cases: a
null text is empty; texts of any length are searched whole; terms that tie are
all taken; repeated rows come back as given; an empty table gives an empty
result; other columns are kept by ``redact`` and not read by ``find``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightsieve.llm.base import sheltered, written

KINDS = ("email", "ip", "card", "phone")
#: Equal to the plain patterns of the docstrings of tests/llm/test_pii.py. A look-behind
#: starts a run at its first character, since no later start can succeed where that failed.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text has to have before the pattern is tried.
GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_PARTS = rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"
TERM = r"[\p{L}\p{N}]+"

CONTEXT, SUPPORT, EVIDENCE, DISCLOSE, REMOVE = 160, 3, 30.0, 0.9, 0.98
#: Parts over which the texts of one pair of entity and term are dealt.
SALT = 16
#: Hashes of terms or texts up to this many are broadcast to the pass that reads the texts; with more, they are joined by shuffle.
BROADCAST_TERMS = 1_000_000

_SPANS = "array<struct<start:int,end:int,hit:string>>"


#: Elements of an array that are summed one after the other, and characters of a piece of text.
BLOCK, PIECE = 256, 1_024


def _let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]


def _running(values: Column, op) -> Column:
    """Running results of ``op`` (which has 0 as its unit) over an array of whole numbers: within blocks, then over the blocks' ends."""
    none = F.array().cast("array<int>")

    def ran(some):
        begin = F.struct(F.lit(0).alias("last"), none.alias("out"))
        return F.aggregate(some, begin, lambda acc, x: _let(op(acc["last"], x), lambda y: F.struct(y.alias("last"), F.concat(acc["out"], F.array(y)).alias("out"))), lambda acc: acc["out"])

    def blocks(v):
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda k: ran(F.slice(v, k * BLOCK + 1, F.lit(BLOCK))))
        return _let(cut, joined)

    def joined(b):
        before = F.concat(F.array(F.lit(0)), ran(F.transform(b, lambda x: F.element_at(x, -1))))
        return F.flatten(F.zip_with(b, F.slice(before, 1, F.size(b)), lambda x, base: F.transform(x, lambda y: op(y, base))))

    return _let(values, lambda v: F.when(F.size(v) == 0, none).when(F.size(v) <= BLOCK, ran(v)).otherwise(blocks(v)))


def _add(a: Column, b: Column) -> Column:
    return a + b


def _pieces(text: Column) -> Column:
    """The text in pieces of PIECE characters, so that what lies far down is found without a walk from the beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _part(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to ``end`` of a text in pieces."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor((F.greatest(end, start + 1) - 1) / PIECE).cast("int")
    held = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(held, start - first * PIECE + 1, end - start)).otherwise("")


def _located(text: Column, pattern: str) -> Column:
    """Start, end and text of each match, from the lengths of matches and of what lies between them."""
    def spans(hits):
        between = F.slice(F.transform(F.split(text, pattern, -1), F.length), 1, F.size(hits))
        ends = _running(F.zip_with(between, hits, lambda gap, hit: gap + F.length(hit)), _add)
        return F.zip_with(ends, hits, lambda end, hit: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def worth(i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), worth), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _holds(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(IP_PARTS)
    if kind == "card":
        n = F.length(_digits(hit))
        return F.when(n.between(13, 19), _luhn(_digits(hit))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _keeper(kind: str):
    return lambda s: _holds(kind, s["hit"])


def _with_hit(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"))


def _with_mark(mark: str):
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(mark).alias("put"))


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each kind, in order, as arrays of (start, end, hit); code points, end exclusive."""
    none = F.array().cast(_SPANS)
    return {
        k: F.filter(F.when(text.rlike(GATES[k]), _located(text, PATTERNS[k])).otherwise(none), _keeper(k))
        for k in KINDS
    }


def _term_hashes(text: Column) -> Column:
    """The hashes of a text's different terms, lower-cased (splitting is several times as fast as extracting)."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def located(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """``doc_id, th, email, ip, card, phone, near``: base spans, and each different entity with the hash of a context.

    With ``keep`` the columns are called ``__id``, ``__th`` and so on, beside all columns of ``docs``.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*(docs.columns if keep else []), F.col(id_col).alias("__id"), text.alias("__text"))
    rows = rows.withColumn("__th", F.xxhash64("__text")).withColumns({f"__{k}": v for k, v in base_spans(F.col("__text")).items()})
    spans = F.concat(*[F.transform(f"__{k}", _with_hit(k)) for k in KINDS])

    def context(pieces, size):
        def of(s):
            left, right = _part(pieces, F.greatest(s["start"] - CONTEXT, F.lit(0)), s["start"]), _part(pieces, s["end"], F.least(s["end"] + CONTEXT, size))
            return F.struct(F.concat_ws(":", s["kind"], F.lower(s["hit"])).alias("entity"), F.xxhash64(left, right).alias("context"))

        return of

    near = _let(_pieces(F.col("__text")), lambda p: _let(F.length("__text"), lambda n: F.transform(spans, context(p, n))))
    none = F.array().cast("array<struct<entity:string,context:bigint>>")
    rows = rows.withColumn("__near", F.when(F.size(spans) > 0, near).otherwise(none)).drop("__text")
    return rows if keep else rows.select(*[F.col(f"__{c}").alias(c) for c in ("id", "th", *KINDS, "near")]).withColumnRenamed("id", "doc_id")


def _held(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """``th, term`` for the different texts of ``wanted`` (th): hashes of their terms; no text is shuffled."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if wanted.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:  # eight bytes a row
        wanted = F.broadcast(wanted)
    rows = docs.select(F.xxhash64(text).alias("th"), text.alias("text")).join(wanted, "th", "left_semi")
    return rows.select("th", F.explode(_term_hashes(F.col("text"))).alias("term")).distinct()


def disclosing(docs: DataFrame, seen: DataFrame, texts: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``entity, term, ratio`` of the terms whose PMI with the entity is at least ``DISCLOSE`` of its information, and ``th, entity, term`` where they are held.

    ``entity`` is a hash that names an entity, or all those that the same texts hold.
    ``seen`` has a row ``th, entity, context`` for each text and entity, ``texts`` a row ``th`` for each row of ``docs``.
    """
    n = F.lit(float(max(texts.distinct().count(), 1)))
    sums = [F.sum(F.xxhash64("th", F.lit(k)).cast("decimal(38,0)")) for k in (1, 2)]
    per_entity = seen.groupBy("entity").agg(F.count_distinct("context").alias("n_e"), F.count(F.lit(1)).alias("k_e"), sums[0].alias("s1"), sums[1].alias("s2")).where(F.col("n_e") >= SUPPORT)
    # entities that the same texts hold, with different surroundings in each, are one group: what is counted is equal
    apart = F.col("n_e") == F.col("k_e")
    grouped = F.when(apart, F.xxhash64("k_e", "s1", "s2")).otherwise(F.xxhash64("entity", F.lit("alone")))
    met = seen.join(per_entity, "entity").select("th", grouped.alias("entity"), F.when(apart, F.col("th")).otherwise(F.col("context")).alias("context"), "n_e", "k_e").distinct()
    met = written(met, "entities")
    held = written(_held(docs, met.select("th").distinct(), text_col), "terms")
    # a pair needs n(t) <= n(t,e) (N / n(e))^(1 - DISCLOSE), and n(t,e) <= n(e); c(t), the texts with entities
    # that hold t, less those with e is at most n(t) less the same, which frequent words exceed
    share = F.pow(n / F.col("n_e"), F.lit(1 - DISCLOSE)) * (1 + 1e-9)
    most = F.col("k_e") + F.col("n_e") * (share - 1)
    bound = met.agg(F.max(most)).first()[0] or 0.0
    around = held.groupBy("term").agg(F.count(F.lit(1)).alias("c_t")).where(F.col("c_t").between(SUPPORT, bound))
    if around.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:  # sixteen bytes a row
        around = F.broadcast(around)
    held = held.join(around, "term")
    # each different surrounding of an entity counts once for a term
    pairs = met.withColumn("most", most).join(held, "th").where(F.col("c_t") <= F.col("most"))
    once = pairs.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("m"), F.first("n_e").alias("n_e"), F.first("c_t").alias("c_t"))
    joint = once.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te"), F.sum("m").alias("m_te"), F.first("n_e").alias("n_e"), F.first("c_t").alias("c_t"))
    able = joint.where((F.col("n_te") >= SUPPORT) & (F.col("c_t") - F.col("m_te") + F.col("n_te") <= F.col("n_te") * share))
    joint = written(able.drop("c_t"), "joint")
    wanted = joint.select("term").distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    few = wanted.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS  # eight bytes a row

    def terms_of(rows):
        every = rows.select("th", F.explode(_term_hashes(F.col("text"))).alias("term"))
        return every.join(F.broadcast(wanted), "term", "left_semi") if few else every

    # texts without copies are counted where they are read; only those with copies send (text, term) pairs
    rows = docs.select(F.xxhash64(text).alias("th"), text.alias("text"))
    copied = texts.groupBy("th").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("th")
    if copied.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        copied = F.broadcast(copied)
        counted = terms_of(rows.join(copied, "th", "left_anti")).unionByName(terms_of(rows.join(copied, "th", "left_semi")).distinct())
    else:
        counted = terms_of(rows).distinct()
    per_term = counted.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    told = joint.join(per_term, "term")
    # of the texts with e, those that share its surroundings count once in n(t), too
    pmi = F.log2(n * F.col("n_te") / ((F.col("n_t") - F.col("m_te") + F.col("n_te")) * F.col("n_e").cast("double")))
    info = F.log2(n / F.col("n_e"))
    told = told.where(info > 0).select("entity", "term", (pmi / info).alias("ratio"), (pmi * F.col("n_te")).alias("bits"))
    revealing = written(told.where((F.col("ratio") >= DISCLOSE) & (F.col("bits") >= EVIDENCE)).drop("bits"), "revealing")
    return revealing, pairs.select("th", "entity", "term")


def revealed(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """``th, told``: for each text that holds any, its disclosing terms as (term, ratio); ``found`` has ``th, near``."""
    seen = found.where(F.size("near") > 0).select("th", F.explode("near").alias("n")).groupBy("th", "n.entity").agg(F.min("n.context").alias("context"))
    seen = written(seen.select("th", "entity", "context"), "seen")
    revealing, held = disclosing(docs, seen, found.select("th"), text_col)
    # a pair that very many texts hold is dealt over SALT parts
    spread = revealing.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    hit = held.withColumn("salt", F.pmod("th", F.lit(SALT)).cast("int")).join(spread, ["entity", "term", "salt"])
    per = hit.groupBy("th", "term").agg(F.max("ratio").alias("ratio")).groupBy("th")
    return written(per.agg(F.sort_array(F.collect_list(F.struct("term", "ratio"))).alias("told")), "revealed")


_TERMS = "array<struct<start:int,end:int,hit:string,ratio:double>>"


def _term_places(rows: DataFrame, kinds: list[str]) -> DataFrame:
    """``xth, terms``: where the terms of ``told`` stand outside the spans of ``kinds``, as (start, end, hit, ratio).

    ``rows`` has a row ``th, text, told`` and the spans for each different text. Places are
    matched with terms, and swept with the spans, as rows: one for each, however many a text has.
    """
    every = F.flatten(F.array(*[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in kinds]))
    places = rows.select("th", F.explode(_located(F.col("text"), TERM)).alias("s")).select("th", F.xxhash64(F.lower("s.hit")).alias("term"), "s.*")
    told = rows.select("th", F.explode("told").alias("t")).select("th", "t.*")
    places = places.join(told, ["th", "term"]).select("th", "start", "end", "hit", "ratio")
    spans = rows.select("th", F.explode(every).alias("s")).select("th", "s.start", "s.end", F.lit(None).cast("string").alias("hit"), F.lit(None).cast("double").alias("ratio"))
    text = W.partitionBy("th").orderBy("start", F.col("hit").isNotNull())
    back = W.partitionBy("th").orderBy(F.desc("start"), F.col("hit").isNotNull().desc())  # frames that grow forwards only take linear time
    swept = places.unionByName(spans).withColumns({
        "upto": F.max(F.when(F.col("hit").isNull(), F.col("end"))).over(text.rowsBetween(W.unboundedPreceding, W.currentRow)),
        "next": F.last(F.when(F.col("hit").isNull(), F.col("start")), ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, -1)),
    })
    free = swept.where(F.col("hit").isNotNull() & (F.coalesce("upto", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end")))
    return free.groupBy(F.col("th").alias("xth")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "hit", "ratio"))).alias("terms"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, email, ip, card, phone, terms`` for every row: arrays of spans."""
    found = written(located(docs, id_col, text_col), "located")
    told = revealed(docs, found, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(text).alias("th"), text.alias("text")).join(told, "th").dropDuplicates(["th"])
    at = _term_places(written(rows.withColumns(base_spans(F.col("text"))), "telling"), list(KINDS))
    return found.drop("near").join(at, F.col("th") == F.col("xth"), "left").select("doc_id", *KINDS, F.coalesce("terms", F.array().cast(_TERMS)).alias("terms"))


def digests(spans: DataFrame) -> DataFrame:
    """What ``find`` gives, as counts, the digest of the base spans, and all spans as text."""
    def told(kind, column):
        return F.transform(column, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))

    base = F.concat(*[told(k, F.col(k)) for k in KINDS])
    return spans.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, told("term", F.col("terms"))), ",").alias("spans"),
    )


def op7_pii(spark, sf_dir: str) -> DataFrame:
    return digests(find(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with entities and disclosing terms replaced in the text; all columns and rows stay.

    Overlapping spans become one replacement, named after the first.
    """
    return sheltered(docs, lambda rows: _redacted(rows, id_col, text_col))


def _redacted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    held = written(located(docs, id_col, text_col, keep=True), "located")
    told = revealed(docs, held.select(F.col("__th").alias("th"), F.col("__near").alias("near")), text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    telling = held.select(F.col("__th").alias("th"), text.alias("text"), *[F.col(f"__{k}").alias(k) for k in KINDS]).join(told, "th").dropDuplicates(["th"])
    at = _term_places(written(telling, "telling"), list(KINDS)).select(F.col("xth").alias("__xth"), F.col("terms").alias("__terms"))
    held = held.join(at, F.col("__th") == F.col("__xth"), "left")
    terms = F.coalesce("__terms", F.array().cast(_TERMS))

    def put_for(s):
        broader = F.when(s["hit"].rlike(r"^\p{N}+$"), "[NUMBER]").when(s["hit"].rlike(r"^\p{Lu}"), "[NAME]").otherwise("[TERM]")
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["ratio"] >= REMOVE, "").otherwise(broader).alias("put"))

    marks = [F.transform(f"__{k}", _with_mark(f"[{k.upper()}]")) for k in KINDS] + [F.transform(terms, put_for)]
    spans = F.array_sort(reduce(lambda a, b: F.concat(a, b), marks))

    def made(s):
        ends = _running(F.transform(s, lambda x: x["end"]), F.greatest)
        return _let(ends, lambda e: _let(_pieces(text), lambda p: F.array_join(F.concat(parts(s, F.concat(F.array(F.lit(0)), e), p), F.array(_part(p, F.element_at(e, -1), F.length(text)))), "")))

    def parts(s, before, pieces):
        # a span that begins before another's end belongs to that one's replacement
        return F.zip_with(s, F.slice(before, 1, F.size(s)), lambda x, at: F.when(x["start"] >= at, F.concat(_part(pieces, at, x["start"]), x["put"])).otherwise(""))

    new = _let(spans, lambda s: F.when(F.size(s) > 0, made(s)).otherwise(F.col(text_col)))
    return held.withColumn(text_col, new).select(docs.columns)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without personal data, ``n_chars`` being their new length; every row stays, a null text stays null."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars")) if "n_chars" in docs.columns else clean
