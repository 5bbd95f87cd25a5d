import math
import random
import re
import time

from pyspark.sql import functions as F

from brightsieve.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def holds(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    return 13 <= len(d) <= 19 and luhn(d) if kind == "card" else 9 <= len(d) <= 15 if kind == "phone" else True


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


ODD = [
    "a@b.c_d@e.f x@y", "", "1." * 3000, "1-" * 4000 + "2", "a@b" + ".c" * 5000, "+1 (222) 333-4444 😀 5.6.7.8.1.2.3.4 0001.2.3.255 256.1.1.1",
    "4111 1111 1111 1111 é a@é.b a.b@c.d.e. 4111-1111-1111-1111-", None, "+1" + "(" * 5000, "x@1.2.3.4 +4111111111111111 @@a@b.c", "a%@b.c@d.e@f", "0.0.0.00 1..2.3.4 99999999999.1.1.1",
]


def test_base_spans(spark, docs, texts, nothing):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, *ODD[:2]])], "doc_id long, text string").union(docs.select("doc_id", "text"))
    want = sorted(str((i, brute(t))) for i, t in [*enumerate([*ODD, *ODD[:2]]), *texts])
    got = sorted(str((r.doc_id, [(k, s.start, s.end) for k in pii.KINDS for s in r[k]])) for r in pii.find(df).collect())
    assert got == want and pii.find(nothing).count() == 0


def test_many_matches_take_linear_time(spark):
    """Ten times the matches of a text take some ten times the time at most; places beyond the first block are right."""
    def took(n):
        text = "ab " + " ".join(f"u{i}@h{i}.org" for i in range(n)) + " 1.2.3.4"
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.time()
        r = pii.located(df).first()
        assert [(s.start, s.end) for s in r.email] == [m.span() for m in re.finditer(PLAIN["email"], text)] and len(r.email) == n
        assert [(s.start, s.end) for s in r.ip] == [(len(text) - 7, len(text))] and len(r.near) == n + 1
        return time.time() - began

    took(1_000)
    small, large = took(10_000), took(100_000)
    assert large < 12 * small + 10


def test_many_entities_and_terms_of_one_text(spark):
    """4,000 entities beside 4,000 terms in three texts: one group of entities, not all pairs of both."""
    n = 4_000
    rows = [(k, " ".join(f"{'abc'[k]}x u{i}@h{i}.org" for i in range(n)) + " " + " ".join(f"term{i}" for i in range(n))) for k in range(3)]
    df = spark.createDataFrame(rows + [(10 + i, f"some other words {i}") for i in range(12_000)], "doc_id long, text string")
    out = {r.doc_id: r for r in pii.find(df).where("doc_id < 3").collect()}
    assert all(len(r.email) == n and len(r.terms) == n for r in out.values())
    assert [t.hit for t in out[0].terms[:2]] == ["term0", "term1"] and out[0].terms[0].start == rows[0][1].index(" term0") + 1
    red = {r.doc_id: r.text for r in pii.redact(df).where("doc_id < 3").collect()}
    assert red[1].count("[EMAIL]") == n and "@" not in red[1] and "term" not in red[1]


def test_long_runs_take_linear_time(spark):
    df = spark.createDataFrame([(1, "x" * 200_000 + "@"), (2, "7" * 200_000 + ".")], "doc_id long, text string")
    assert all(not any(r[k] for k in pii.KINDS) for r in pii.find(df).collect())


def test_disclosing_terms(spark):
    rows = [(i, f"report {i} says Zorblatt wrote to z@ex.org about {i} today") for i in range(6)]
    rows += [(100 + i, f"the report says today nothing about {i} wrote to all") for i in range(200)]
    rows += [(400 + i, "copied Quux only once a@b.cd") for i in range(50)]  # one context, however often copied
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(df).collect()}
    for i in range(6):
        assert [rows[i][1][s.start : s.end] for s in found[i].terms] == ["Zorblatt"]
    assert not any(found[i].terms for i in found if i >= 100)
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert clean[0] == "report 0 says  wrote to [EMAIL] about 0 today" and clean[100] == rows[6][1]


def test_redaction(spark, docs, texts):
    df = spark.createDataFrame([(0, "x@1.2.3.4 or +1 (222) 333-4444, 4111 1111 1111 1111!", 7)], "doc_id long, text string, n_chars int")
    r = pii.stage(spark, df, "").first()
    assert r.text == "[EMAIL] or [PHONE], [CARD]!" and r.n_chars == len(r.text)
    out = pii.stage(spark, docs, "")
    assert out.columns == docs.columns and sorted(str((r.doc_id, r.text)) for r in out.collect()) == sorted(str(t) for t in texts)
    assert out.where(F.col("text").isNull() & F.col("n_chars").isNotNull()).count() == 0


def test_copies_dilute_no_term(spark):
    rows = [(i, f"Zorblatt wrote number {i} for z@ex.org again") for i in range(7)]
    rows += [(10 + i, rows[0][1]) for i in range(300)]
    rows += [(1000 + i, f"nothing wrote again for number {i}") for i in range(300)]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all([t[s.start : s.end] for s in found[i].terms] == ["Zorblatt"] for i, t in rows[:307])


def brute_terms(rows):
    """The disclosing pairs (entity, term) by plain counting."""
    texts = sorted({t or "" for _, t in rows})
    spans = {t: brute(t) for t in texts}
    words = {t: set(re.findall(r"[^\W_]+", t.lower())) for t in texts}
    by = {}
    for t in texts:
        for k, s, e in spans[t]:
            by.setdefault(f"{k}:{t[s:e].lower()}", {}).setdefault(t, set()).add((t[max(0, s - 160) : s], t[e : e + 160]))
    out, n = set(), len(texts)
    for entity, held in by.items():
        first = {t: min(c) for t, c in held.items()}
        n_e = len(set(first.values()))
        for w in set().union(*(words[t] for t in held)):
            own = [t for t in held if w in words[t]]
            n_te = len({first[t] for t in own})
            n_t = sum(w in words[t] for t in texts) - len(own) + n_te
            if n_te >= 3 and n > n_e:
                pmi = math.log2(n * n_te / (n_t * n_e))
                if pmi >= 0.9 * math.log2(n / n_e) - 1e-9 and pmi * n_te >= 30 - 1e-9:
                    out.add((entity, w))
    return out


def test_terms_against_counting(spark):
    """Far and short terms, a frequent entity, near copies, ties: spans of terms as plain counting has them."""
    rng = random.Random(5)
    common = [f"w{i}" for i in range(40)]
    say = lambda k: " ".join(rng.choice(common) for _ in range(k))
    rows = []
    for i in range(9):
        rows.append((i, f"Kim x7 {say(80)} call me {say(40)} a{i % 3}@kim.org {say(30)} {i}"))  # one name far off
    for i in range(8):
        rows.append((20 + i, f"{say(50)} 10.1.2.3 {say(40)} KIM Ng {'x7' if i < 2 else ''}"))
    near = say(60)
    for i in range(30):
        rows.append((40 + i, f"{near} secretword b@near.org {near} copy{i}"))  # near copies are one
    rows += [(100 + i, f"{say(60)} {'all@every.org' if i % 2 else ''} {say(5)}") for i in range(150)]
    pairs = brute_terms(rows)
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    flagged = 0
    for i, t in rows:
        spans = brute(t)
        mine = {w for k, s, e in spans for entity, w in pairs if entity == f"{k}:{t[s:e].lower()}"}
        want = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", t) if m[0].lower() in mine and not any(s < m.end() and m.start() < e for _, s, e in spans)]
        assert [(x.start, x.end) for x in found[i].terms] == want
        flagged += len(want)
    assert flagged > 5


def test_digests(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    import hashlib

    rows = {r.doc_id: r for r in pii.digests(pii.find(df)).collect()}
    for i, t in enumerate(ODD):
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(t))
        assert rows[i].base_sha256 == hashlib.sha256(said.encode()).hexdigest() and rows[i].spans.startswith(said)
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in brute(t)) for k in pii.KINDS]
