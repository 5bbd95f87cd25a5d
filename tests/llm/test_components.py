import random

import pytest

from brightsieve.llm import components


def roots(links):
    """The least node of each node's component, by a search."""
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for n in sorted(near):
        todo = [n] if n not in out else []
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = n
                todo += near[x]
    return {n: r for n, r in out.items() if n != r}


def made():
    rng = random.Random(4)
    chain = rng.sample(range(-500, 500), 400)
    return [*zip(chain, chain[1:]), (2000, 2000), (3000, 2999), (2999, 3000)] + [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(150)]


@pytest.mark.parametrize("size", [1 << 17, 20])
def test_components(spark, monkeypatch, size):
    """In one slice, and in many with rounds after them."""
    monkeypatch.setattr(components, "SLICE", size)
    rows = made()
    got = components.connected(spark.createDataFrame(rows, "a long, b long"), "a", "b").collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.root for r in got} == roots([(a, b) for a, b in rows if a != b])
    assert components.connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_few_links_need_no_rounds(spark, monkeypatch):
    """A chain of 400 nodes took a round of two tables for each halving."""
    def star(both):
        raise AssertionError("a round")

    monkeypatch.setattr(components, "_star", star)
    rows = made()
    assert components.connected(spark.createDataFrame(rows, "a long, b long"), "a", "b").count() == len(roots([(a, b) for a, b in rows if a != b]))


def test_large_groups_of_near_copies_are_one_class(spark):
    """400 near copies, in groups around many places: all in one class."""
    from brightsieve.llm import passages

    rng, base = random.Random(6), [f"w{i}" for i in range(400)]
    texts = []
    for i in range(400):
        words = list(base)
        for at in range(rng.randrange(10, 30), 400, 30):
            words[at] = f"x{i}y{at}"
        texts.append((i, " ".join(words)))
    links = passages.links(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    nodes = {r.a for r in links} | {r.b for r in links}
    assert len(nodes) == 400 and len(set(roots([(r.a, r.b) for r in links]).values())) == 1
