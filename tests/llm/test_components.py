import random

import pytest

from lattica.llm import components


@pytest.mark.parametrize("share", [200_000, 40])
def test_components(spark, monkeypatch, share):
    monkeypatch.setattr(components, "PER_TASK", share)
    r = random.Random(2)
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 150)] + [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(90)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = sorted((find(a), find(b)))
        if a != b:
            parent[q] = p
    got = {x.node: x.label for x in components.connected(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}
    assert components.connected(spark.createDataFrame([], "a long, b long"), "test").count() == 0
