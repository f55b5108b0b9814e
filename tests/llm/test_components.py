from __future__ import annotations

import random

from pressure.llm.components import components


def test_components_match_a_plain_search(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(60)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    links += links[:10] + [(b, a) for a, b in links[5:15]] + [(7, 7), (None, 3)]
    near: dict = {}
    for a, b in links:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        todo = [start] if start not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = start
                todo += near[x]
    table = spark.createDataFrame(links, "a long, b long")
    got = components(table, "a", "b").collect()
    assert len(got) == len(want)
    assert {r["id"]: r["component"] for r in got} == want
    assert components(table.limit(0), "a", "b").collect() == []
