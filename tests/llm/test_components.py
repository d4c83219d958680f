"""Components in few steps, from one task or many."""

import random

import pytest

from martflow.llm import components as module


@pytest.mark.parametrize("a_task", [50_000, 7])
def test_components_take_few_steps(prepared, monkeypatch, a_task):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(200)] + [(999, 999 + i) for i in range(100)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(120)] + [(-5, 2000), (7, 7), (None, 3)]
    steps, written = [], module._written
    monkeypatch.setattr(module, "_written", lambda *a: steps.append(1) or written(*a))
    monkeypatch.setattr(module, "EDGES_A_TASK", a_task)
    found = dict(map(tuple, module.components(prepared.createDataFrame(edges, "u long, v long").repartition(13)).collect()))
    parent = {n: n for e in edges for n in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert {n: found.get(n, n) for n in parent} == {n: root(n) for n in parent}
    assert len(steps) <= 2 if a_task > len(edges) else len(steps) > 2
