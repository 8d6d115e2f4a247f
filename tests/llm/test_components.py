import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from estatescope.llm.components import components


def brute(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def run(spark, pairs):
    df = spark.createDataFrame(pairs or [(None, None)], "a long, b long")
    rows = components(df).collect()
    assert len(rows) == len({r.id for r in rows})
    return {r.id: r.group_id for r in rows}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=40))
def test_like_union_find(spark, pairs):
    assert run(spark, pairs) == brute(pairs)


def test_chain_star_and_nulls(spark):
    rng = random.Random(3)
    chain = list(range(1000, 1120))
    rng.shuffle(chain)
    pairs = list(zip(chain, chain[1:])) + [(5000, i) for i in range(6000, 6400)] + [(1, None), (None, 2), (7, 7), (9, 8), (8, 9), (9, 8)]
    assert run(spark, pairs) == brute(pairs)
