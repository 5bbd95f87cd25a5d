import datetime as dt
import zipfile

import pytest

from brightsieve.operators import classify, quality
from brightsieve.plans import mapping, pipeline
from brightsieve.sources import files
from brightsieve.sources.store import LeadStore, prepare
from brightsieve.streaming import ingest

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_upsert(spark):
    s = LeadStore(spark, name="t_upsert")
    first = spark.createDataFrame([("a", "One", 5), ("b", "Two", 6), (None, "x", 7)], "record_id string, company string, capacity int")
    assert s.upsert(first, T0) == {"inserted": 2, "updated": 0, "errors": 1, "table": "t_upsert"}
    again = spark.createDataFrame([("a", None, 9), ("c", "Three", 1)], "record_id string, company string, capacity int")
    assert s.upsert(again, T1)["updated"] == 1
    rows = {r.record_id: r for r in s.frame().collect()}
    assert (rows["a"].company, rows["a"].capacity, rows["a"].created_at, rows["a"].updated_at) == ("One", 9, T0, T1)
    assert rows["b"].updated_at == T0 and len(rows) == 3
    before = sorted(s.frame().drop("updated_at", "ingestion_timestamp", "batch_id").collect())
    s.upsert(again, T1)
    assert sorted(s.frame().drop("updated_at", "ingestion_timestamp", "batch_id").collect()) == before
    assert s.query("SELECT company FROM t_upsert WHERE record_id = ?", ["c"]).first()[0] == "Three"
    assert s.stats()["total_records"] == 3 and s.describe().count() == len(s.frame().columns)


def test_prepare(spark):
    df = spark.createDataFrame([("x" * 600, ["a", "b"])], "company string, data_quality_flags array<string>")
    r = prepare(df, "b1", T0).first()
    assert (len(r.company), r.data_quality_flags, r.batch_id, r.ingestion_timestamp, len(r.raw_record_hash)) == (500, '["a", "b"]', "b1", T0, 64)


def test_full_score(spark):
    names = "company phone email address1 city state zip license_number license_status first_name last_name".split()
    row = ("Acme Care", "+12125550790", "a@b.co", "1 Main", "Austin", "TX", "78701", "L1", "ACTIVE", "A", "B", 10, 1, 5, False)
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names) + ", capacity int, min_age int, max_age int, is_duplicate boolean")
    r = quality.score(df).first()
    assert (r.data_quality_score, r.data_quality_flags) == (100, None)


def test_csv(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes('Name;Note\n"Café";"two\nlines"\nN/A;007\n'.encode("latin-1"))
    rows = files.read_csv(spark, str(p)).orderBy("Note").collect()
    assert [(r.Name, r.Note) for r in rows] == [(None, "007"), ("Café", "two\nlines")] and rows[0]._source_file == "a.csv"
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, str(tmp_path / "no.csv"))
    with pytest.raises(ValueError):
        files.check(str(tmp_path))
    assert files.sniff_delimiter(["a|b|c", "1;2"]) == "|" and files.sniff_delimiter(["x"]) == ","


def workbook(path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="One" r:id="r1"/><sheet name="Two" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="/xl/worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Organization</t></si><si><r><t>Ac</t></r><r><t>me</t></r></si></sst>")
        z.writestr("xl/worksheets/s1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>Max</t></is></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2"><v>12</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/s2.xml", f'<worksheet {ns}><sheetData><row><c t="inlineStr"><is><t>Phone</t></is></c></row><row><c><v>2125550790</v></c></row></sheetData></worksheet>')


def test_pipeline(spark, tmp_path):
    workbook(tmp_path / "w.xlsx")
    (tmp_path / "leads.csv").write_text("Company,Phone,Email\nAcme,2125550790,a@b.co\nBeta,2125550790,\nGamma,,a@b.co\n")
    (tmp_path / "bad.xlsx").write_text("no zip")
    store = LeadStore(spark, name="t_pipeline")
    out = pipeline.run(spark, str(tmp_path), store=store, cache_dir=str(tmp_path / "cache"), export=str(tmp_path / "out"))
    assert (out["files"], out["records"], out["duplicates"]) == (3, 5, 3)
    rows = {r.record_id: r for r in store.frame().collect()}
    assert rows["leads_00000001"].is_duplicate and rows["leads_00000001"].duplicate_cluster_id == "cluster_000001"
    assert rows["w__One_00000000"].capacity == 12
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2
    assert len(mapping.SchemaCache(str(tmp_path / "cache")).keys()) == 3


def test_registry(tmp_path):
    (tmp_path / "r.yaml").write_text("sources:\n  texas:\n    pattern: 'tx_*'\n    delimiter: ';'\n")
    r = files.Registry(str(tmp_path / "r.yaml"))
    assert r.match("TX_2024.csv").delimiter == ";" and r.match("other.csv").name == "default" and r.list() == ["texas", "default"]


def test_mapping(tmp_path):
    found, share = mapping.fallback(["Organization", "E-Mail", "Phone", "Facility Kind"])
    assert found["company"] == "Organization" and found["email"] == "E-Mail" and found["facility_type"] == "Facility Kind"
    assert share == len(found) / 21 and mapping.fingerprint([" B", "a"]) == mapping.fingerprint(["A ", "b"])
    reply = '```json\n{"mappings": {"company": "Name"}, // note\n "transformations": {"t": {"target_column": "company", "regex": "\\d+",}}, "confidence": 0.5}\n``` done'
    s = mapping.parse_reply(reply)
    assert s.transformations["t"].regex == r"\d+" and s.confidence == 0.5


class Flaky:
    def __init__(self):
        self.n = 0

    def complete(self, prompt):
        self.n += 1
        if self.n < 3:
            raise OSError
        return "{}"


def test_client():
    c = mapping.CachedClient(Flaky(), calls=1, sleep=lambda s: None)
    assert c.complete("a") == "{}" and c.complete("a") == "{}" and c.usage()["cache_hits"] == 1
    assert "mappings" in c.complete("mappings please")


def test_classifier(spark):
    df = spark.createDataFrame([("Happy Learning Center",), ("in-home",), ("",), (None,), ("zoo",)], "d string")
    got = [(r.category, r.confidence) for r in classify.classify(df, "d").collect()]
    assert got == [("Child Care Center", 0.7), ("Family Child Care", 0.7), ("Other", 0.0), ("Other", 0.0), ("Other", 0.5)]
    asked = classify.classify(df, "d", lambda texts: [{"category": "Zoo", "confidence": 0.9}] * (len(texts) - 1)).collect()
    assert sum(r.source == "llm" for r in asked) in (1, 2)


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("id,Name\nr1,Acme\nr2,Beta\n")
    (src / "b.csv").write_text("id,Name\nr1,Acme 2\n")
    from brightsieve.operators.rules import Schema

    store = LeadStore(spark, name="t_stream")
    rows = ingest.csv_stream(spark, str(src), ["id", "Name"])
    leads = ingest.leads_stream(rows, Schema({"company": "Name"}), "id")
    ingest.upsert_stream(leads, store, str(tmp_path / "cp")).awaitTermination(120)
    assert store.frame().count() == 2


def test_reopened_store(spark, tmp_path):
    place = f"sqlite:///{tmp_path}/leads"
    rows = lambda *r: spark.createDataFrame(list(r), "record_id string, company string")
    LeadStore(spark, place, "t_first").upsert(rows(("a", "One"), ("b", "Two")), T0)
    again = LeadStore(spark, place, "t_again")
    again.create()  # an existing table stays
    assert again.upsert(rows(("b", "New"), ("c", "Three")), T1) == {"inserted": 1, "updated": 1, "errors": 0, "table": "t_again"}
    got = {r.record_id: (r.company, r.created_at, r.updated_at) for r in LeadStore(spark, place, "t_third").frame().collect()}
    assert got == {"a": ("One", T0, T0), "b": ("New", T0, T1), "c": ("Three", T1, T1)}
    fresh = LeadStore(spark, str(tmp_path / "other"), "t_other")
    assert fresh.load(rows(("x", "X")))["inserted"] == 1 and fresh.frame().count() == 1


def test_csv_edges(spark, tmp_path):
    p = tmp_path / "edges.csv"
    p.write_bytes(b"a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n,,\n13,14,15,\n")
    rows = [tuple(r) for r in files.read_csv(spark, str(p), lineage=False).collect()]
    assert sorted(rows, key=str) == sorted([("1", "2", "3"), ("4", "5", None), ("10", "11", "12"), (None, None, None)], key=str)
    q = tmp_path / "skipped.csv"
    q.write_text('junk\n"more, junk"\nName,Note\n"x\ny",1\nz,2\n')
    assert sorted(tuple(r) for r in files.read_csv(spark, str(q), skip_rows=2, lineage=False).collect()) == [("x\ny", "1"), ("z", "2")]
    late = tmp_path / "late.csv"
    late.write_bytes(b"Name,Note\n" + b"abc,1\n" * 30_000 + "Café,2\n".encode("latin-1"))
    for through in (False, True):
        assert files.read_csv(spark, str(late), lineage=False, through_spark=through).where("Note = '2'").first().Name == "Café"


def test_hash_is_that_of_json(spark):
    import hashlib
    import json

    from brightsieve.sources.store import record_hash

    rows = [{"a": "x\ny", "b": None}, {"a": 'q"\\', "b": "é\t\x01"}, {"a": "", "b": "</b>"}]
    df = spark.createDataFrame([(r["a"], r["b"]) for r in rows], "a string, b string")
    got = [r[0] for r in df.select(record_hash(df, ["b", "a"])).collect()]
    assert got == [hashlib.sha256(json.dumps(r, sort_keys=True, ensure_ascii=False).encode()).hexdigest() for r in rows]


def test_configured_run(spark, tmp_path):
    """Registry, default rules, classification and a kept store on the run path."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "acme_1.csv").write_text("junk\nNom;Genre;Ville\nA;child care center;paris\nB;;lyon\n")
    (tmp_path / "in" / "other.csv").write_text("Etablissement,Genre\nC,x\n")
    (tmp_path / "registry.yaml").write_text(
        "sources:\n  acme:\n    pattern: acme*\n    delimiter: ';'\n    skip_rows: 1\n    column_map: {company: Nom, facility_type: Genre, city: Ville}\n"
        "    transformations:\n      city:\n        - {mapping: {paris: Paris}}\n  default:\n    patterns:\n      company: [etablissement]\n"
    )
    (tmp_path / "rules.yaml").write_text("transformations:\n  st: {target_column: state, source_column: Ville, condition: paris, value: TX}\n")
    from brightsieve.operators.rules import load_rules

    registry = files.Registry(str(tmp_path / "registry.yaml"))
    assert registry.column_mapping("acme")["company"] == "Nom" and registry.column_mapping("none") == {} and "city" in registry.transformations_of("acme")
    for _ in range(2):
        store = LeadStore(spark, str(tmp_path / "store"), "t_configured")
        out = pipeline.run(spark, str(tmp_path / "in"), store=store, registry=registry, defaults=load_rules(str(tmp_path / "rules.yaml")), classifier=True)
    assert out["load"]["updated"] == 3 and out["records"] == 3
    rows = {r.company: r for r in LeadStore(spark, str(tmp_path / "store"), "t_configured").frame().collect()}
    assert (rows["A"].city, rows["A"].state, rows["A"].facility_type, rows["A"].ai_facility_type_confidence) == ("Paris", "TX", "Child Care Center", 0.7)
    assert rows["B"].facility_type == "Other" and rows["C"].company == "C"


def test_error_context_and_shared_client():
    import json

    try:
        json.loads('{\n "a": 1\n "b": 2}')
    except json.JSONDecodeError as e:
        told = mapping.error_context('{\n "a": 1\n "b": 2}', e)
    assert "line 3, column 2" in told and "> " in told and told.splitlines()[-1].strip() == "^"
    mapping.forget_shared_client()
    first = mapping.shared_client(calls=3)
    assert mapping.shared_client(calls=9) is first and first.most == 3
    mapping.forget_shared_client()
