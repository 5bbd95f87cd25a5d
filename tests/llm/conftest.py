import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, th long, key string, found int, node int, size int, url string, terms int"


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): null, empty, blank, very long and repeated texts, null ids, ties."""
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "ka lo mi nu pe ré".split() for b in "ra se ti vo xu".split()]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = say(30_000)
    shared = say(60)
    rows = [(1, say(80)), (2, None), (3, ""), (4, " \n\t "), (5, long), (6, "!!! ... ???"), (7, "É"), (8, "a b"), (9, say(40) + " " + shared + " " + say(30)), (10, shared + " " + say(90)), (None, say(20)), (None, None)]
    rows += [(11, rows[0][1]), (1, rows[0][1]), (12, rows[0][1] + " extra"), (13, "x" * 150_000)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), "c", 1, "k", 0, 0, 0, "u", None) for i, t in texts], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
