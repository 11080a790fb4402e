"""Connected components against a plain union of sets."""

import numpy as np
import pytest

from cohortwise.llm.components import components


def plain(edges):
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


CASES = {
    "chain": [(i, i + 1) for i in range(40)], "star": [(9, i) for i in range(-20, 30)],
    "loops": [(1, 1), (2, 3), (3, 2), (2, 3)], "zigzag": [(i, 100 - i) for i in range(50)] + [(i, 99 - i) for i in range(50)],
    "random": [tuple(map(int, e)) for e in np.random.default_rng(1).integers(-50, 50, (70, 2))],
}


@pytest.mark.parametrize("name", CASES)
def test_labels(spark, name):
    edges = CASES[name]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = plain(edges)
    alone = {x for x in want if all(a == b for a, b in edges if x in (a, b))}
    assert got == {x: v for x, v in want.items() if x not in alone}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
