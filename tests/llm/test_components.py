"""Connected components against a search."""

import numpy as np

from recordmill.llm import components as C


def search(edges):
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2)) - 50]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a chain
    edges += [(2000, 2000 + i) for i in range(1, 300)] + [(1 << 62, -(1 << 62)), (5, 5)]
    df = spark.createDataFrame(edges, "src long, dst long").repartition(7)
    got = {r.node: r.component for r in C.connected_components(df).collect()}
    want = search(edges)
    assert got == {k: v for k, v in want.items() if k in got}
    assert {k for k, v in want.items() if v != k} <= set(got)
    assert C.connected_components(df.limit(0)).count() == 0


def test_forest():
    rng = np.random.default_rng(4)
    for _ in range(30):
        edges = rng.integers(0, 30, (20, 2))
        src, dst = C.forest(edges[:, 0], edges[:, 1])
        want = search([tuple(e) for e in edges.tolist()])
        assert dict(zip(src.tolist(), dst.tolist())) == {k: v for k, v in want.items() if k != v}
