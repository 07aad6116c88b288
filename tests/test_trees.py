"""Paths by doubling pointers and clades as intervals, against plain code."""

import random

import pytest

from loamframe.operators import taxonomy as T

NODES = "tax_id int, parent_id int, rank string, name string"


def _tree(n, deepest, seed):
    """A chain of ``deepest`` levels and nodes below random ones of it; parents by id."""
    draw, up, depth = random.Random(seed), {1: None}, {1: 1}
    for i in range(2, n + 1):
        at = i - 1 if i <= deepest else draw.choice([x for x in up if depth[x] < deepest])
        up[i], depth[i] = at, depth[at] + 1
    return up


def _path(up, i):
    out = []
    while i is not None:
        out.insert(0, i)
        i = up[i]
    return out


def _nodes(spark, up):
    return spark.createDataFrame([(i, p, f"r{i % 3}", f"n{i}") for i, p in up.items()], NODES)


@pytest.mark.parametrize("deepest", [1, 2, 3, 4, 5, 8, 9])
def test_paths_of_every_depth(spark, deepest):
    up = _tree(deepest + 12 * (deepest > 1), deepest, deepest)
    for levels in {deepest, max(1, deepest - 1)}:
        got = {r.tax_id: (r.path, r.depth, [x.name for x in r.lineage]) for r in T.taxonomy_paths(_nodes(spark, up), levels).collect()}
        want = {i: _path(up, i) for i in up if len(_path(up, i)) <= levels}
        assert got == {i: (p, len(p), [f"n{x}" for x in p]) for i, p in want.items()}


def test_dangling_parents_and_cycles_are_left_out(spark):
    up = {1: None, 2: 1, 3: 99, 4: 3, 5: 6, 6: 5, 7: 7}
    assert {r.tax_id for r in T.taxonomy_paths(_nodes(spark, up), 6).collect()} == {1, 2}
    assert T.taxonomy_paths(_nodes(spark, up).where("false"), 6).count() == 0


def test_report_of_forty_levels(spark):
    up = _tree(160, 40, 7)
    nodes = _nodes(spark, up)
    draw = random.Random(3)
    direct = [(s, i, draw.randrange(5)) for s in "ab" for i in draw.sample(sorted(up), 60)]
    direct += [("a", None, 4), ("b", 900, 6), ("b", 2, 3), ("b", 2, 1), ("c", 901, 2), ("d", None, 0)]
    tree = T.taxonomy_paths(nodes, 40)
    report = T.clade_report(spark.createDataFrame(direct, "sample string, tax_id int, direct_reads long"), tree)
    clade, own, about = {}, {}, {}
    for s, i, n in direct:
        path = [0] if i is None else _path(up, i) if i in up else [1, i]
        for at, x in enumerate(path):
            clade[s, x] = clade.get((s, x), 0) + n
            about[s, x] = 0 if i is None else at + 1
        own[s, path[-1]] = own.get((s, path[-1]), 0) + n
    got = {(r.sample, r.tax_id): r for r in report.collect()}
    assert {k: r.clade_reads for k, r in got.items()} == clade
    assert {k: r.direct_reads for k, r in got.items()} == {k: own.get(k, 0) for k in clade}
    assert {k: r.depth for k, r in got.items()} == about
    total = {s: sum(n for k, n in own.items() if k[0] == s) for s in "abcd"}
    assert all(abs(r.pct - (round(100 * r.clade_reads / total[s], 4) if total[s] else 0)) < 1e-3 for (s, _), r in got.items())
    names = {0: "unclassified", 900: "900", 901: "901"}
    assert all(r.name == names.get(i, "root" if (s, i) == ("c", 1) else f"n{i}") for (s, i), r in got.items())


def test_joins_of_forty_levels(spark):
    """Six rounds, each a join written once, and one join of the report: nothing is joined a level at a time."""
    joins = []
    before = T._cut
    T._cut = lambda df: (joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join ")), before(df))[1]
    try:
        tree = T.taxonomy_paths(_nodes(spark, _tree(50, 40, 1)), 40)
    finally:
        T._cut = before
    direct = spark.createDataFrame([("a", 40, 1)], "sample string, tax_id int, direct_reads long")
    plan = T.clade_report(direct, tree)._jdf.queryExecution().optimizedPlan().toString()
    assert joins == [1] * 6 and plan.count("Join ") == 1
    assert plan.count("Generate ") == 1
