"""Connected components against a plain search."""

from __future__ import annotations

import random

import pytest

from resolvscope.llm.components import components


def roots_of(pairs):
    label = {n: n for p in pairs if p[0] != p[1] for n in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


CHAIN = [(i, i + 1) for i in range(-20, 20)]
SHUFFLED = random.Random(5).sample(range(-500, 500), 120)
CASES = {
    "none": [],
    "loops only": [(3, 3), (-1, -1)],
    "stars of the smallest": [(1, n) for n in (4, 5, 6)] + [(n, 2) for n in (7, 8)] + [(1, 4)],
    "star of the largest": [(9, n) for n in range(9)],
    "chain": CHAIN,
    "two roots of one node": [(1, 5), (2, 5)],
    "shuffled paths": list(zip(SHUFFLED[:60], SHUFFLED[1:61], strict=True)) + list(zip(SHUFFLED[70:110], SHUFFLED[71:111], strict=True)),
    "random": [(random.Random(i).randrange(150), random.Random(i + 999).randrange(150)) for i in range(110)],
}


@pytest.mark.parametrize("case", CASES)
def test_components_are_those_of_a_search(spark, case):
    pairs = CASES[case]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots_of(pairs)
    # A root may be left out: it is its own.
    assert {n: got.get(n, n) for n in want} == want
    assert set(got) <= set(want)
