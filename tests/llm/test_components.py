import random

import pytest

from mixlab.llm.components import components


def brute(pairs):
    least = {n: n for p in pairs if p[0] != p[1] for n in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a != b and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


@pytest.mark.parametrize("kind", ["none", "path", "star", "random"])
def test_least_node_of_each_component(spark, kind):
    draw = random.Random(kind)
    pairs = {
        "none": [(4, 4)],
        "path": [(i, i + 1) for i in range(60)],
        "star": [(-5, i) for i in range(300)] + [(7, 7), (1, 2)],
        "random": [(draw.randrange(400), draw.randrange(400)) for _ in range(260)],
    }[kind]
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["root"] for r in got} == brute(pairs)
