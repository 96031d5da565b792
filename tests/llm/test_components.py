"""Components against union by hand, and how many edges are joined for them."""

import random

from torquelake.llm import components


def test_edges_are_joined_a_few_times_not_in_every_round(spark, monkeypatch):
    """A chain in random order takes many rounds; edges within what is connected already are not joined again."""
    pick = random.Random(1)
    chain = list(range(300))
    pick.shuffle(chain)
    edges = [*zip(chain, chain[1:]), *((k, 999) for k in range(400, 460)), (7, 7), (chain[1], chain[0]), (-5, 2000)]
    want = {n: 0 for n in chain} | {n: 400 for n in [*range(400, 460), 999]} | {-5: -5, 2000: -5}
    joined, match_hot = [], components.match_hot

    def counting(left, right, keys, rows, total):
        if keys == ["node"]:
            joined.append(left.count())
        return match_hot(left, right, keys, rows, total)

    monkeypatch.setattr(components, "match_hot", counting)
    found = components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in found} == want and len(found) == len(want)
    assert sum(joined) <= 5 * len(edges)
    assert components.connected_components(spark.createDataFrame([(1, 1)], "a bigint, b bigint")).count() == 0
