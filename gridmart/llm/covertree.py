"""Exact near-duplicate vectors by dual traversal of cover trees.

Vectors are compared within a label, by cosine in double precision. Equal vectors are one point with
a count. The points of a label are dealt into blocks of neighbours (each point to the nearest of a
few centres, cells cut into blocks of at most about ``BLOCK`` points), and pairs of blocks whose
covering balls come near enough are worked off, each by one task: a cover tree per block (nested
levels whose radii halve), both descended together, a pair of nodes dropped when their centres lie
further apart than both covering radii and the threshold's distance. Points of the leaf pairs that
are left are compared exactly. A task gives, for each point, how many vectors it links to, and a
spanning forest of the links: never more rows than it read, whatever the number of pairs.

Bounds are loosened by ``SLACK`` for rounding, so nothing is lost; the decision itself is the cosine
of the original numbers. What cannot be pruned costs one task per pair of blocks: vectors that lie
evenly in all directions are compared block by block, a label's points in quadratic time.

Defined results: null ids or labels, and vectors that are null, zero, empty or hold null or
non-finite numbers link with nothing; vectors of different lengths do not link; repeated rows link as
other vectors do; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .graph import components

BLOCK = 2_048
CENTRES = 64
SLACK = 1e-6
POINTS = 8  # points to a centre, on the mean, that a level must have


class CoverTree:
    """Nested levels over unit points: the top is one node, each next level's radius is half.

    ``points[k]`` are the centres of level k (places in ``x``), ``reach[k]`` the largest distance
    from each to a point below it, ``kids[k][i]`` the nodes of level k + 1 below node i, ``leaves``
    the points below each node of the last level.

    A level is made by the distances of its centres to the points of their mother alone, and not at all
    where it would need a centre for every few points: points that lie evenly are leaves of the level
    before, as no bound would tell them apart.
    """

    def __init__(self, x: np.ndarray, least: float):
        self.x, n = x, len(x)
        centres, owner = np.zeros(1, np.int64), np.zeros(n, np.int64)
        self.points, self.reach, self.kids = [centres], [np.array([_away(x, 0, np.arange(n)).max()])], []
        radius = 2.0
        while len(centres) < n and radius > least:
            radius /= 2
            level = self._level(centres, owner, radius, max(16, n // POINTS))
            if level is None:
                break
            centres, mothers, owner, away = level
            reach = np.zeros(len(centres))
            np.maximum.at(reach, owner, away)
            self.kids.append(groups(mothers, len(self.points[-1])))
            self.points.append(centres)
            self.reach.append(reach)
        self.leaves = groups(owner, len(centres))

    def _level(self, centres: np.ndarray, owner: np.ndarray, radius: float, most: int) -> tuple | None:
        """The next level's centres, their mothers, each point's centre and distance to it; None if it has
        more than ``most`` centres."""
        found, mothers = [], []
        new_owner, away = np.empty_like(owner), np.empty(len(owner))
        for node, members in enumerate(groups(owner, len(centres))):
            # the mother stays a centre (nesting); then whoever is not covered yet becomes one
            centre, left = centres[node], members
            while len(left):
                if len(found) == most:
                    return None
                far = _away(self.x, centre, left)
                near = (far <= radius) | (left == centre)
                new_owner[left[near]], away[left[near]] = len(found), far[near]
                found.append(centre)
                mothers.append(node)
                left = left[~near]
                centre = left[0] if len(left) else -1
        return np.array(found), np.array(mothers), new_owner, away


def _away(x: np.ndarray, centre: int, places: np.ndarray) -> np.ndarray:
    """Distances of some points to one of them."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x[places] @ x[centre])))


def groups(owner: np.ndarray, n: int) -> list[np.ndarray]:
    """The places of each number below ``n`` in ``owner``."""
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.cumsum(np.bincount(owner, minlength=n))[:-1])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between unit vectors, from their products."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def near_leaves(a: CoverTree, b: CoverTree, within: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Points of all pairs of leaves that may hold two points ``within`` a distance."""
    i, j, ka, kb = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while True:
        apart = distances(a.x[a.points[ka]], b.x[b.points[kb]])[i, j]
        keep = apart <= a.reach[ka][i] + b.reach[kb][j] + within + SLACK
        i, j = i[keep], j[keep]
        more_a, more_b = ka < len(a.kids), kb < len(b.kids)
        if not len(i) or not (more_a or more_b):
            return [(a.leaves[p], b.leaves[q]) for p, q in zip(i, j, strict=True)]
        if more_a and (not more_b or ka <= kb):  # the tree that has been descended less
            kids = [a.kids[ka][node] for node in i]
            i, j, ka = np.concatenate(kids), np.repeat(j, [len(k) for k in kids]), ka + 1
        else:
            kids = [b.kids[kb][node] for node in j]
            i, j, kb = np.repeat(i, [len(k) for k in kids]), np.concatenate(kids), kb + 1


def linked(
    a: np.ndarray, b: np.ndarray | None, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs with a cosine of at least ``least``; each once, within ``a`` if no b."""
    within = float(np.sqrt(max(0.0, 2.0 - 2.0 * least)))

    def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scaled = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither vanish nor overflow
        return scaled, np.sqrt((scaled * scaled).sum(axis=1))

    x, norm_x = unit(a)
    y, norm_y = (x, norm_x) if b is None else unit(b)
    tree_x = CoverTree(x / norm_x[:, None], within / 2)
    tree_y = tree_x if b is None else CoverTree(y / norm_y[:, None], within / 2)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p, q in near_leaves(tree_x, tree_y, within):
        cosine = (x[p] @ y[q].T) / (norm_x[p][:, None] * norm_y[q])
        r, s = np.nonzero(cosine >= least)
        left.append(p[r])
        right.append(q[s])
    i, j = np.concatenate(left), np.concatenate(right)
    if b is not None:
        return i, j
    once = np.unique(np.minimum(i, j)[i != j] * len(a) + np.maximum(i, j)[i != j])
    return once // len(a), once % len(a)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest place that each of ``n`` places reaches by the links."""
    root = np.arange(n)
    while True:
        new = root.copy()
        low = np.minimum(root[i], root[j])
        for ends in (i, j):
            np.minimum.at(new, ends, low)
            np.minimum.at(new, root[ends], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def rows_of(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """key, group, v and node of every row: equal vectors of a label are one node. Node is null for
    rows that link with nothing."""
    rows = vectors.select(
        F.col(key).alias("key"), F.col(label).alias("l"), F.col(vector).cast("array<double>").alias("v")
    ).withColumn("v", F.transform("v", lambda c: c + 0.0))  # one zero
    sound = (
        F.col("key").isNotNull()
        & F.col("l").isNotNull()
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists("v", lambda c: c != 0)
    )
    halves = (F.xxhash64("l", "v"), F.xxhash64(F.size("v"), "v", "l"))
    node = F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves])
    group = F.concat_ws(":", F.col("l").cast("string"), F.size("v"))
    return rows.select("key", group.alias("group"), "v", F.when(sound, node).alias("node"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), float)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _nearest(points: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
    """Cell and distance of each point; the only cell 0 where there is no choice."""
    if points.empty:
        return points.assign(cell=[], away=[])[["node", "group", "v", "n", "cell", "away"]]
    if centres.empty:
        return points.assign(cell=0, away=2.0)[["node", "group", "v", "n", "cell", "away"]]
    centres = centres.sort_values("cell")
    apart = distances(_unit(_matrix(points["v"])), _unit(_matrix(centres["centre"])))
    best = apart.argmin(axis=1)
    cells = centres["cell"].to_numpy()[best]
    return points.assign(cell=cells, away=apart.min(axis=1))[["node", "group", "v", "n", "cell", "away"]]


def _apart(a: Column, b: Column) -> Column:
    """Distance of two vectors scaled to unit length; null if one is null."""

    def scaled(v: Column) -> Column:
        top = F.array_max(F.transform(v, F.abs))
        return F.transform(v, lambda c: c / top)

    def product(v: Column, w: Column) -> Column:
        return F.aggregate(F.zip_with(v, w, lambda x, y: x * y), F.lit(0.0), lambda s, c: s + c)

    a, b = scaled(a), scaled(b)
    cosine = product(a, b) / F.sqrt(product(a, a) * product(b, b))
    return F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * cosine))


def in_blocks(points: DataFrame, within: float) -> tuple[DataFrame, DataFrame]:
    """Points with their block, and the pairs of blocks (one, other) that may hold links."""
    chunks = points.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    sized = points.join(chunks, "group")
    dealt = sized.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    # the first nodes of each group: a rank on keys alone, of which every task sends on a few
    keys = sized.where("chunks > 1").select("group", "node", "chunks")
    rank = F.row_number().over(Window.partitionBy("group").orderBy("node"))
    first = keys.withColumn("rank", rank).where(F.col("rank") <= CENTRES).where("rank <= 2 * chunks")
    first = first.select(F.col("node").alias("_node"), (F.col("rank") - 1).alias("cell"))
    several = sized.join(first, F.col("node") == F.col("_node"))
    centres = stored(several.select("group", "cell", F.col("v").alias("centre"), "chunks"), "centres")
    each = centres.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    schema = "node string, group string, v array<double>, n long, cell int, away double"
    celled = stored(
        dealt.drop("chunks")
        .groupBy("group", "chunk")
        .cogroup(each.drop("chunks").groupBy("group", "chunk"))
        .applyInPandas(_nearest, schema),
        "cells",
    )
    cells = celled.groupBy("group", "cell").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"), F.max("away").alias("reach")
    )
    name = F.concat_ws("/", "group", "cell", "part")
    part = F.pmod(F.xxhash64(F.lit(1), "node"), F.col("parts")).cast("int")
    placed = celled.join(cells.drop("reach"), ["group", "cell"]).withColumn("part", part)
    placed = placed.select(name.alias("block"), "node", "v", "n")
    blocks = (
        cells.join(centres.drop("chunks"), ["group", "cell"], "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("block", name)
    )
    sides = [
        blocks.select("group", *[F.col(c).alias(f"{c}_{i}") for c in ("block", "centre", "reach")])
        for i in (1, 2)
    ]
    apart = _apart(F.col("centre_1"), F.col("centre_2"))
    near = F.coalesce(apart <= F.col("reach_1") + F.col("reach_2") + within + SLACK, F.lit(True))
    pairs = sides[0].join(sides[1], "group").where("block_1 <= block_2").where(near)
    return placed, pairs.select(F.col("block_1").alias("one"), F.col("block_2").alias("other"))


def _links(least: float):
    def links(pair: pd.DataFrame) -> pd.DataFrame:
        pair = pair.sort_values(["second", "node"], ignore_index=True)
        v, n, first = _matrix(pair["v"]), pair["n"].to_numpy(), (~pair["second"]).sum()
        if first == len(pair):
            i, j = linked(v, None, least)
        else:
            i, j = linked(v[:first], v[first:], least)
            j = j + first
        count = np.bincount(i, n[j], len(pair)) + np.bincount(j, n[i], len(pair))
        root = forest(i, j, len(pair))
        node = pair["node"].to_numpy()
        some = count > 0
        return pd.DataFrame(
            {"node": node[some], "links": count[some].astype(np.int64), "root": node[root[some]]}
        )

    return links


def near_duplicates(
    vectors: DataFrame, key: str, vector: str, label: str, least: float = 0.98
) -> DataFrame:
    """key, n_links, component_id, kept of every row: its direct links (cosine at least ``least``,
    same label), and the smallest key it reaches by links."""
    within = float(np.sqrt(max(0.0, 2.0 - 2.0 * least)))
    rows = rows_of(vectors, key, vector, label)
    points = stored(
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.first("group").alias("group"),
            F.first("v").alias("v"),
            F.count("*").alias("n"),
            F.min("key").alias("low"),
        ),
        "points",
    )
    placed, pairs = in_blocks(points.drop("low"), within)
    pairs = stored(pairs, "block-pairs")
    name = F.concat_ws("|", "one", "other").alias("pair")
    ends = pairs.select(F.col("one").alias("block"), name, F.lit(False).alias("second")).unionByName(
        pairs.where("one <> other").select(
            F.col("other").alias("block"), name, F.lit(True).alias("second")
        )
    )
    found = stored(
        placed.join(ends, "block")
        .select("pair", "second", "node", "v", "n")
        .groupBy("pair")
        .applyInPandas(_links(least), "node string, links long, root string"),
        "links",
    )
    roots = components(found, "node", "root")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = (
        points.select("node", "n", "low")
        .join(roots, "node", "left")
        .join(sums, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    lows = nodes.groupBy("root").agg(F.min("low").alias("component"))
    links = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    nodes = nodes.join(lows, "root").select("node", links.alias("links"), "component")
    every = rows.select("key", "node").join(nodes, "node", "left")
    return every.select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "key").alias("component_id"),
        (F.col("key") == F.coalesce("component", "key")).alias("kept"),
    )
