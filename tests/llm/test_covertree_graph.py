"""Cover trees and components against brute force."""

import numpy as np
import pytest

from gridmart.llm import covertree, queries
from gridmart.llm.graph import components
from workload.compare import connect, difference


def plain_components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_random_graphs(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1200)] + [(5, 5)]
    edges += [tuple(int(x) for x in e) for e in rng.integers(2000, 2100, (60, 2))]
    order = rng.permutation(len(edges))
    df = spark.createDataFrame([edges[i][:: 1 if i % 2 else -1] for i in order], "a long, b long")
    found = {r.node: r.root for r in components(df).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert found == plain_components(nodes, [e for e in edges if e[0] != e[1]])
    assert components(df.where("false")).count() == 0


def clustered(rng, n, dim, spread):
    centres = rng.normal(size=(max(1, n // 8), dim))
    return centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, dim))


@pytest.mark.parametrize("spread", [0.02, 0.1, 1.0])
def test_dual_traversal_finds_exactly_the_pairs(spread):
    rng = np.random.default_rng(3)
    x = clustered(rng, 300, 8, spread)
    x[:150] *= rng.uniform(0.1, 1e6, (150, 1))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.98
    i, j = covertree.linked(x, None, 0.98)
    assert {*zip(i, j)} == {(a, b) for a, b in zip(*np.nonzero(near)) if a < b}
    i, j = covertree.linked(x[:100], x[100:], 0.98)
    assert {*zip(i, j)} == {(a, b) for a, b in zip(*np.nonzero(near[:100, 100:]))}
    tree = covertree.CoverTree(unit, 0.1)
    assert sorted(np.concatenate(tree.leaves)) == list(range(300))
    for k, kids in enumerate(tree.kids):  # nested, and every level within half the radius above
        assert set(tree.points[k]) <= set(tree.points[k + 1])
        assert (tree.reach[k + 1] <= 2.0 ** -(k) + 1e-9).all()
        assert sorted(np.concatenate(kids)) == list(range(len(tree.points[k + 1])))


@np.errstate(all="ignore")
def expected(rows, least=0.98):
    """Brute force over (key, vector, label)."""

    def sound(v, label):
        return label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)

    good = [(k, np.array(v, float), label) for k, v, label in rows if k is not None and sound(v, label)]
    links = [
        (a, b)
        for a in range(len(good))
        for b in range(len(good))
        if a != b and good[a][2] == good[b][2] and len(good[a][1]) == len(good[b][1])
        and good[a][1] @ good[b][1] / np.sqrt((good[a][1] @ good[a][1]) * (good[b][1] @ good[b][1])) >= least
    ]
    counts = np.bincount([a for a, _ in links], minlength=len(good))
    keys = [g[0] for g in good]
    roots = plain_components(set(keys), [(keys[a], keys[b]) for a, b in links])
    out = [(k, int(counts[i]), roots[k], roots[k] == k) for i, (k, _, _) in enumerate(good)]
    bad = [(k, 0, k, None if k is None else True) for k, v, label in rows if k is None or not sound(v, label)]
    return sorted(out + bad, key=str)


@pytest.mark.parametrize("block", [16, 2048])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK", block)
    rng = np.random.default_rng(4)
    x = clustered(rng, 240, 6, 0.08)
    rows = [(i, v.tolist(), int(i % 3 == 0)) for i, v in enumerate(x)]
    copies = [(300 + i, x[5].tolist(), 0) for i in range(40)]
    odd = [(400, None, 0), (401, x[0].tolist(), None), (402, [0.0] * 6, 0), (403, [1.0, None], 0),
           (404, [float("nan")] * 6, 0), (405, [float("inf"), 1.0], 0), (406, [], 0), (407, x[0, :3].tolist(), 0),
           (None, x[5].tolist(), 0), (408, [-0.0, 1.0], 9), (409, [0.0, 1.0], 9), (410, [1e-200, 0.0], 9),
           (411, [1e300, 0.0], 9)]
    every = rows + copies + odd
    df = spark.createDataFrame(every, "id long, v array<double>, label int").withColumnRenamed("label", "node")
    found = covertree.near_duplicates(df.repartition(5), "id", "v", "node")
    got = sorted([tuple(r) for r in found.collect()], key=str)
    assert [g for g in got if g[0] is None or g[0] < 410] == [
        e for e in expected(every) if e[0] is None or e[0] < 410
    ]
    assert {g for g in got if g[0] in (410, 411)} == {(410, 1, 410, True), (411, 1, 410, False)}
    assert covertree.near_duplicates(df.where("false"), "id", "v", "node").count() == 0


def test_op10_equals_sql_on_the_whole_table(spark, sf_dir):
    found = queries.op10_covertree(spark, sf_dir)
    assert difference(connect(sf_dir), found, queries.SQL["op10_covertree"]) is None
    assert found.count() == spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
