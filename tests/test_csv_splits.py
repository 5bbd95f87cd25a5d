"""CSV files read in parts of every size against the standard library's reader and the reader of whole files."""

import csv
import io
import random

import pytest

from brightsieve.plans import pipeline
from brightsieve.sources import csv_splits, files


@pytest.fixture
def block(spark):
    """Sets the bytes of a part."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]

    def put(n):
        for k, v in zip(keys, (n, 1)):
            spark.conf.set(k, str(v))

    yield put
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def truth(text, names, delimiter=",", skip=1):
    rows = list(csv.reader(io.StringIO(text, newline=""), delimiter=delimiter))[skip:]
    return [tuple((*r, *[""] * (len(names) - len(r)))) for r in rows if r and len(r) <= len(names)]


def got(df, names):
    return [tuple(r[n] or "" for n in names) for r in df.orderBy(csv_splits.PLACE).collect()]


def made(rng, rows, end="\n"):
    values = ["", "x", "two words", '"a\nb"', '"\n"', '"\n\n,"', '"he said ""hi"""', 'in"ner', '""', '"a,b"', "é", '"c\r\nd"', "7"]
    return "a,b,c" + end + "".join(",".join(rng.choice(values) for _ in range(rng.choice([1, 2, 3, 3, 3, 4]))) + rng.choice([end, end, end + end]) for _ in range(rows))


@pytest.mark.parametrize("seed", range(3))
def test_every_cut(spark, tmp_path, block, seed):
    text = made(random.Random(seed), 9, "\r\n" if seed == 1 else "\n")
    p = tmp_path / "a.csv"
    p.write_bytes(text.encode())
    for n in (3, 11, 40, 10_000):
        block(n)
        df = files.read_csv(spark, str(p), delimiter=",", split=True, place=True, strings=False)
        assert got(df, "abc") == truth(text, "abc"), n
    assert df.columns[:3] == ["a", "b", "c"]


def test_as_one_task_reads_it(spark, tmp_path, block):
    text = made(random.Random(9), 3_000)
    p = tmp_path / "big.csv"
    p.write_bytes(text.encode())
    block(4_096)
    parts = files.read_csv(spark, str(p), lineage=False, split=True)
    assert csv_splits._lines(spark, str(p), ",", '"', '"').rdd.getNumPartitions() > 5
    whole = files.read_csv(spark, str(p), lineage=False, split=False)
    row = lambda r: tuple(x or "" for x in r)
    assert sorted(map(row, parts.collect())) == sorted(map(row, whole.collect()))


def test_one_value_over_many_parts(spark, tmp_path, block):
    text = 'a,b\n1,"' + "\n".join(f"line {i}" for i in range(200)) + '"\n2,x\n3,"open\n\n4;y\n'
    p = tmp_path / "long.csv"
    p.write_bytes(text.encode())
    block(64)
    rows = got(files.read_csv(spark, str(p), delimiter=",", split=True, place=True, strings=False), "ab")
    assert rows[0] == ("1", "\n".join(f"line {i}" for i in range(200))) and rows[1] == ("2", "x")
    assert len(rows) == 3 and rows[2][1].startswith("open\n\n4;y")  # an unclosed quote goes to the end


def test_no_long_records_no_shuffle(spark, tmp_path, block):
    p = tmp_path / "plain.csv"
    p.write_text("a,b\n" + "".join(f"{i},v{i}\n" for i in range(2_000)))
    block(1_000)
    df = files.read_csv(spark, str(p), delimiter=",", split=True, lineage=False)
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().toString() and df.count() == 2_000


def test_encodings_header_and_skipped_lines(spark, tmp_path, block):
    block(10)
    p = tmp_path / "late.csv"
    p.write_bytes(b"\"two\nlines\";x\n\na;b\r\n1;x\r\n" + "2;Café\r\n".encode("latin-1"))
    rows = files.read_csv(spark, str(p), skip_rows=1, split=True, place=True)
    assert got(rows, "ab") == [("1", "x"), ("2", "Café")] and rows.first()["_source_file"] == "late.csv"
    p = tmp_path / "mark.csv"
    p.write_bytes(b"\xef\xbb\xbfa,b\nN/A,\"q\n\"\n" + "é,2\n".encode())
    assert got(files.read_csv(spark, str(p), split=True, place=True), "ab") == [("", "q\n"), ("é", "2")]
    p = tmp_path / "only.csv"
    p.write_text("a,b\n")
    assert files.read_csv(spark, str(p), split=True).count() == 0
    (tmp_path / "none.csv").write_text("")
    assert files.read_csv(spark, str(tmp_path / "none.csv"), split=True).count() == 0
    (tmp_path / "mac.csv").write_bytes(b"a,b\r1,2\r")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "mac.csv"), split=True, lineage=False).collect()] == [("1", "2")]
    (tmp_path / "esc.csv").write_text('a,b\n1,"x \\"y\nz\\""\n2,w\n')
    assert got(files.read_csv(spark, str(tmp_path / "esc.csv"), escape="\\", split=True, place=True), "ab") == [("1", 'x "y\nz"'), ("2", "w")]


def test_records_keep_their_order_in_the_pipeline(spark, tmp_path, block):
    block(50)
    p = tmp_path / "leads.csv"
    p.write_text("Company,Phone\n" + "".join(f'"Firm\n{i}",21255500{i:02d}\n' if i % 3 == 0 else f"Firm {i},21255500{i:02d}\n" for i in range(40)))
    df = files.read_csv(spark, str(p), split=True, place=True)
    rows = pipeline.to_leads("leads.csv", df).orderBy("record_id").collect()
    assert [r.phone[-2:] for r in rows] == [f"{i:02d}" for i in range(40)] and csv_splits.PLACE not in rows[0].asDict()


def test_folder_by_its_scheme(spark, tmp_path):
    (tmp_path / "b.csv").write_text("Name,Note\nAcme,\"x\ny\"\n")
    (tmp_path / "a.csv").write_text("Name,Note\nBeta,007\n")
    (tmp_path / "other.txt").write_text("no")
    found = files.extract(spark, f"file://{tmp_path}")
    assert list(found) == ["a.csv", "b.csv"] and found["b.csv"].first().Note == "x\ny" and found["a.csv"].first()._source_file == "a.csv"
