import hashlib
import random

import pytest

from starwise.llm.components import components


def ids(n):
    return hashlib.md5(str(n).encode()).digest()


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_components(spark, kind):
    rng = random.Random(4)
    edges = {
        "path": [(n, n + 1) for n in range(60)] + [(100, 101)],
        "star": [(0, n) for n in range(1, 50)] + [(200, n) for n in range(201, 240)],
        "random": [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(70)] + [(1, 1), (2, 3), (2, 3)],
    }[kind]
    frame = spark.createDataFrame([(ids(a), ids(b)) for a, b in edges] + [(None, ids(1))], "a binary, b binary")
    found = {bytes(r.node): bytes(r.label) for r in components(frame).collect()}
    group = {}
    for a, b in edges:
        if a != b:
            group.setdefault(a, a), group.setdefault(b, b)
            old, new = group[a], group[b]
            group = {k: new if g == old else g for k, g in group.items()}
    assert set(found) == set(map(ids, group))
    for a in group:
        for b in group:
            assert (found[ids(a)] == found[ids(b)]) == (group[a] == group[b])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a binary, b binary")).count() == 0
