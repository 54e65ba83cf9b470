"""Star contraction: components of odd graphs, and what a round asks of the driver."""

import random

from cratewise.llm import components


def roots(pairs):
    """The smallest node of each component, by walking."""
    next_to, found = {}, {}
    for a, b in pairs:
        next_to.setdefault(a, set()).add(b)
        next_to.setdefault(b, set()).add(a)
    for start in sorted(next_to):
        todo = [start]
        while todo:
            node = todo.pop()
            if node not in found:
                found[node] = start
                todo += next_to[node]
    return {node: root for node, root in found.items() if node != root}


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, i) for i in range(200, 260)]
    loose = [(rng.randrange(-400, 0), rng.randrange(-400, 0)) for _ in range(300)]
    pairs = [*chain, *hub, *loose, (7, 7), (3, 2), (2, 3)]
    found = components.stars(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["root"] for r in found.collect()} == roots(pairs)
    assert components.stars(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_round_is_one_chain(spark, monkeypatch):
    """Each broadcast and stage takes some of the driver's memory, however few the links are."""
    plans, write = [], components.saved
    monkeypatch.setattr(components, "saved", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, name))
    components.stars(spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")).collect()
    assert len(plans) > 2
    for plan in plans[1:]:
        assert "Join" not in plan and "BroadcastExchange" not in plan and plan.count("Exchange hashpartitioning") <= 3
