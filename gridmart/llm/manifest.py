"""Merkle manifest of a dataset: a content-addressed DAG of digests, and proofs by descent through it.

Every row is a leaf: the hash of its fields. The leaves of a source, in order of their key, are hashed
together three at a time, level by level, to the source's subroot; subroots in order of the source
are hashed likewise to the root. `build` stores the DAG as records (digest, children). `proofs` sends a
request for every leaf from the root down: the digits of its rank say which child to follow, the
digests of the children left aside are collected, and the collected segments, reversed, are the
proof.

Records are stored in pages of `LEVELS` levels, one row per page, so a level costs no shuffle of its own:
a page of at most ``3 ** LEVELS`` nodes is hashed, and descended, in one go, and requests that share a
page share the way down to it. The number of passes is the logarithm of the leaves to the base of the
page size. A source with any share of all rows is cut into pages like all others.

Defined results: a null field is hashed as ``-``; a null source is a source, first in order; null keys
come first in their source; rows with equal keys are ordered by their digests, equal rows are
interchangeable leaves of their own; an empty table has no root and no proofs; extra columns are not
part of a leaf unless named in ``fields``; a lone leaf is its source's subroot, a lone subroot the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .ordinals import running, same

ARITY = 3  # fixed value: children of a node
LEVELS = 6
PAGE = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

RECORDS = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))
PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
STEP = "struct<left:string,right:string>"


def field(value: Column) -> Column:
    """A value as it enters a leaf: byte count, colon, value; a dash if null."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def digest_of(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels, reach = 0, 1
    while reach < n:
        levels, reach = levels + 1, reach * ARITY
    return levels


def hashed(digests: list[str], levels: int) -> tuple[str, list[tuple[str, list[str]]]]:
    """Raise the nodes of a page: its top, and the record of every node made."""
    records = []
    for _ in range(levels):
        runs = [digests[i : i + ARITY] for i in range(0, len(digests), ARITY)]
        digests = [digest_of(run) for run in runs]
        records += zip(digests, runs, strict=True)
    return digests[0], records


def descended(top: str, records: dict[str, list[str]], place: int, levels: int) -> tuple[str, list]:
    """From a page's top to the node at ``place``: its digest and the steps on the way, top first. Each
    is the digests to the left and to the right of the child that was followed."""
    digest, steps = top, []
    for level in reversed(range(levels)):
        digit = place // ARITY**level % ARITY
        children = records[digest]
        steps.append(("".join(children[:digit]), "".join(children[digit + 1 :])))
        digest = children[digit]
    return digest, steps


def _pages(nodes: DataFrame, carry: list[str]) -> DataFrame:
    """``nodes`` (tree, rank, n, digest, *carry) as pages, a row each, with their records."""
    member = F.struct("rank", "digest", *carry)
    grouped = nodes.groupBy("tree", F.floor(F.col("rank") / PAGE).cast("long").alias("page")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(member)).alias("members")
    )

    def raised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops, records, levels = [], [], []
            for n, members in zip(batch.column("n").to_pylist(), batch.column("members"), strict=True):
                levels.append(min(LEVELS, height(n)))
                digests = members.values.field("digest").to_pylist()
                top, made = hashed(digests, levels[-1])
                tops.append(top)
                records.append([{"digest": d, "children": c} for d, c in made])
            table = pa.Table.from_batches([batch])
            table = table.append_column("levels", pa.array(levels, pa.int32()))
            table = table.append_column("top", pa.array(tops, pa.string()))
            yield from table.append_column("records", pa.array(records, RECORDS)).to_batches()

    added = "levels int, top string, records array<struct<digest:string,children:array<string>>>"
    schema = T.StructType([*grouped.schema.fields, *T.StructType.fromDDL(added).fields])
    return grouped.mapInArrow(raised, schema)


def _forest(nodes: DataFrame, carry: list[str], purpose: str) -> list[DataFrame]:
    """The pages of all trees of ``nodes``, a table per `LEVELS` levels, lowest first."""
    tiers = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most:
        tiers.append(stored(_pages(nodes, carry if not tiers else []), f"{purpose}-{len(tiers)}"))
        if most <= PAGE:
            break
        most = -(-most // PAGE)
        nodes = tiers[-1].where(F.col("n") > PAGE)
        nodes = nodes.select(
            "tree", F.col("page").alias("rank"), F.ceil(F.col("n") / PAGE).alias("n"), F.col("top").alias("digest")
        )
    return tiers


def _tops(tiers: list[DataFrame]) -> DataFrame:
    """A row per tree: its root, and the tier of pages in which it ends."""
    found = None
    for tier, pages in enumerate(tiers):
        ended = pages.where(F.col("n") <= PAGE).select("tree", F.col("top").alias("digest"), F.lit(tier).alias("tier"))
        found = ended if found is None else found.unionByName(ended)
    return found


def _below(pages: DataFrame, requests: DataFrame) -> DataFrame:
    """Answer requests (tree, page, digest, subroot, path) at their pages: a row per page with the paths
    to all its members, top first, in the order of ``members``."""
    asked = requests.select(
        F.col("tree").alias("_tree"), F.col("page").alias("_page"), F.col("digest").alias("_digest"),
        "subroot", "path",
    )
    met = same(pages, asked, {"tree": "_tree", "page": "_page"}, "inner")

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                levels, asked_for = row.column("levels")[0].as_py(), row.column("_digest")[0].as_py()
                records = {r["digest"]: r["children"] for r in row.column("records")[0].as_py()}
                upper = [(s["left"], s["right"]) for s in row.column("path")[0].as_py()]
                members = row.column("members")[0].values
                paths = []
                for rank, digest in zip(
                    members.field("rank").to_pylist(), members.field("digest").to_pylist(), strict=True
                ):
                    found, steps = descended(asked_for, records, rank % PAGE, levels)
                    if found != digest:
                        raise ValueError(f"record of rank {rank} leads to {found}, not to {digest}")
                    paths.append(upper + steps)
                lefts, rights, ends = [], [], [0]
                for path in paths:
                    lefts += [s[0] for s in path]
                    rights += [s[1] for s in path]
                    ends.append(len(lefts))
                steps = pa.StructArray.from_arrays(
                    [pa.array(lefts, pa.string()), pa.array(rights, pa.string())], ["left", "right"]
                )
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)
                column = pa.ListArray.from_arrays(pa.array([0, len(paths)], pa.int32()), lists)
                yield pa.RecordBatch.from_arrays(
                    [row.column("tree"), row.column("subroot"), row.column("members"), column],
                    ["tree", "subroot", "members", "paths"],
                )

    paths = T.StructType.fromDDL(f"paths array<array<{STEP}>>").fields
    schema = T.StructType([pages.schema["tree"], asked.schema["subroot"], pages.schema["members"], *paths])
    return met.mapInArrow(answered, schema)


def _opened(answers: DataFrame) -> DataFrame:
    each = answers.select("tree", "subroot", F.explode(F.arrays_zip("members", "paths")).alias("_m"))
    return each.select("tree", "subroot", "_m.members.*", F.col("_m.paths").alias("path"))


def _descent(tiers: list[DataFrame], starts: DataFrame) -> DataFrame:
    """All members of the lowest pages, with their paths; ``starts`` (tree, tier, digest, subroot, path)
    says where each tree's descent begins."""
    wanted, requests = ["tree", "page", "digest", "subroot", "path"], None
    for tier in reversed(range(len(tiers))):
        new = starts.where(F.col("tier") == tier).withColumn("page", F.lit(0).cast("long")).select(wanted)
        requests = new if requests is None else requests.unionByName(new)
        opened = _opened(_below(tiers[tier], requests))
        requests = opened.withColumn("page", F.col("rank")).select(wanted)
    return opened


@dataclass
class Manifest:
    """The stored DAG: pages of the sources' trees and of the tree over subroots, lowest tier first."""

    sources: list[DataFrame]
    subroots: DataFrame  # tree (the source), digest, tier, rank, n
    upper: list[DataFrame]
    carry: list[str]

    def root(self) -> str | None:
        top = _tops(self.upper).first() if self.upper else None
        return top and top["digest"]

    def records(self) -> DataFrame:
        """Every node's record (digest, children), once however often it occurs."""
        pages = [p.select(F.explode("records").alias("r")).select("r.*") for p in [*self.sources, *self.upper]]
        found = pages[0]
        for more in pages[1:]:
            found = found.unionByName(more)
        return found.dropDuplicates(["digest"])


def build(leaves: DataFrame, source: str = "source", key: str = "doc_id", carry: tuple[str, ...] = ()) -> Manifest:
    """Hash ``leaves`` (source, key, digest, and columns to ``carry`` along with a leaf) to their root."""
    picked = leaves.select(
        F.col(source).alias("tree"), F.col(key).alias("key"), "digest", *carry
    )
    order = ["key", "digest", *carry]
    ranked = running(picked, ["tree"], order, None, "rank", "n")
    tiers = _forest(ranked, ["key", *carry], "manifest-leaves")
    if not tiers:
        return Manifest([], ranked, [], list(carry))
    tops = stored(running(_tops(tiers), [], ["tree"], None, "rank", "n"), "manifest-subroots")
    nodes = tops.select(F.lit("").alias("tree"), "rank", "n", "digest")
    return Manifest(tiers, tops, _forest(nodes, [], "manifest-sources"), list(carry))


def proofs(manifest: Manifest) -> DataFrame:
    """A row per leaf: source, key, digest, carried columns, subroot, root, and its path from the leaf up
    (the digests to the left and to the right of the node at each level)."""
    carried = manifest.carry
    if not manifest.sources:
        none = F.lit(None).cast("string")
        path = F.array().cast(f"array<{STEP}>")
        empty = manifest.subroots.select(
            F.col("tree").alias("source"), "key", "digest", *carried,
            none.alias("subroot"), none.alias("root"), path.alias("path"),
        )
        return empty.limit(0)
    tops, no_steps = _tops(manifest.upper), F.array().cast(f"array<{STEP}>")
    upper = tops.withColumn("path", no_steps).withColumn("subroot", F.lit(None).cast("string"))
    upper = _descent(manifest.upper, upper)
    root = manifest.root()
    ways = upper.select(F.col("rank").alias("_rank"), "path")
    starts = manifest.subroots.join(ways, F.col("rank") == F.col("_rank"))
    starts = stored(starts.select("tree", "tier", "digest", F.col("digest").alias("subroot"), "path"), "manifest-starts")
    return _descent(manifest.sources, starts).select(
        F.col("tree").alias("source"), "key", "digest", *carried, "subroot", F.lit(root).alias("root"),
        F.reverse("path").alias("path"),
    )


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(
        path, digest, lambda below, step: F.sha2(F.concat(step["left"], below, step["right"]), 256)
    )


def siblings_digest(path: Column) -> Column:
    """One hash over the path's digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)
