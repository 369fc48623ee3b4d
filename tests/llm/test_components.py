import random

from ledgerloom.llm.components import components


def union_find(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def test_components_of_chains_stars_and_random_links(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 40)]
    loose = [(rng.randrange(2000, 2080), rng.randrange(2000, 2080)) for _ in range(50)]
    pairs = chain + star + loose
    rng.shuffle(pairs)
    table = spark.createDataFrame([*pairs, (None, 5), (7, None)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(table, "a", "b").collect()}
    wanted = {k: v for k, v in union_find([p for p in pairs if p[0] != p[1]]).items()}
    assert found == wanted


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
