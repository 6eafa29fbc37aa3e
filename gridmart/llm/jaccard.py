"""Exact similarity join of documents on word shingles, by a prefix tree.

A document is the set of its distinct shingles. All sets are put into one global order: shingles by
how often their hash bucket occurs in the corpus, rare first, then by hash. Two sets whose Jaccard
similarity reaches the threshold share a shingle within their first few (their prefixes), so only
sets that meet in a prefix are compared; shingles that many documents share come last in the order
and hardly ever lie in a prefix.

Equal sets are one node. Where nodes meet in a prefix shingle, the one that shares most of its
prefix is the centre of a star. A pair of centre and node is a candidate if their sizes allow it, and
how many of their shingles fall into each of `BINS` bins by hash. A centre's candidates are stored,
in global order, in a prefix tree that the centre's set goes through: sets that begin alike share
their partial overlap, and a subtree is left as soon as too few shingles remain to reach the
threshold. Links join components. Shingles whose nodes are then in one component are settled; of the
others, nodes of different components are paired and go the same way. A pair is left out only if
its documents are known to be connected already, so the components are exact.

A shingle counts for a node only where it may be the first that the node shares with a similar set:
what follows it must still suffice, given the sizes that meet in it. So near copies that differ in too
many places from all others, whose rare shingles come first, are not paired with the whole group.

Defined results: null or empty text, or text without words: an empty set, linked with nothing;
fewer words than a shingle's width: the whole sequence is the one shingle; repeated rows are equal
sets; an empty table gives no rows; extra columns are ignored. Whole texts, no caps.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.session import scratch_path
from gridmart.sources.sinks import remove

from .common import added, list_array, raw_texts, stored, stored_at, tidied
from .graph import components

WIDTH = 5
PERCENT = 80
BITS = 20  # the frequency table that orders shingles has 2**BITS buckets; it is summed and broadcast
PARTS = 64  # rows in which a task sends its table
HOT = 1 << 20  # prefix shingles that exceed the usual bucket by as much are not grouped, only joined
STAR = 64  # sets per prefix tree
BROADCAST = 2_000_000  # document ids; more are joined by a shuffle
TEXT_ROWS = 256
SETS = "doc_id long, n long, node long, prefix array<long>, hot array<long>, bins binary"
BINS = 128  # counts of a set's shingles by hash, which bound what two sets can have in common
WORDS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15
GAP = re.compile(rb"[\x09-\x0d\x20]")
STRETCH = 1 << 19  # bytes of text that are hashed at a time, up to the next white space


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of `BASE` and of its inverse, modulo 2**64."""
    pairs = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        pairs.append(np.cumprod(steps, dtype=np.uint64))
    return pairs[0], pairs[1]


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every word of a text: runs without ASCII white space, ASCII letters in
    lower case. Worked off in stretches that end at white space, as numbers take eight times the
    room of the text."""
    found, at = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
    while at < len(text):
        gap = GAP.search(text, at + STRETCH)
        end = gap.start() if gap else len(text)
        hashes, begins = _hash_words(text[at:end])
        found.append((hashes, begins + at))
        at = end
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _hash_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.lower(), np.uint8)
    inside = ~BLANK[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    powers, inverse = _powers(1 << max(16, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * inverse[begins]), begins


def shingles(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Hashes of the distinct shingles of each text, ascending; short texts are hashed together."""
    out, held, size = [], [], 0
    for text in texts:
        if held and size + len(text) > 2 * STRETCH:
            out += _shingles(held, width)
            held, size = [], 0
        held.append(text)
        size += len(text)
    return out + _shingles(held, width) if held else out


def _shingles(texts: list[bytes], width: int) -> list[np.ndarray]:
    hashes, begins = word_hashes(b" ".join(texts))
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    bounds = np.searchsorted(begins, starts)
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for i in range(width):
        rolled = rolled * WORDS[i % len(WORDS)] + hashes[i : i + len(rolled)]
    rolled = mixed(rolled)
    out = []
    for first, last in zip(bounds, bounds[1:], strict=False):
        if last - first >= width:
            out.append(np.unique(rolled[first : last - width + 1]))
        elif last > first:  # the whole sequence, told apart from shingles by its length
            few = hashes[first:last]
            out.append(mixed((few * WORDS[: len(few)]).sum(keepdims=True) + np.uint64(len(few))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int) -> int:
    """So many first shingles that similar sets must share one of them."""
    return n - (PERCENT * n + 99) // 100 + 1 if n else 0


def least_overlap(n: int, m: int) -> int:
    return -(-PERCENT * (n + m) // (100 + PERCENT))


class Order:
    """The global order of shingles."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.hot = 2 * int(np.median(table)) + HOT

    def __call__(self, h: np.ndarray) -> np.ndarray:
        return h[np.argsort(self.table[h >> np.uint64(64 - BITS)], kind="stable")]

    def is_hot(self, h: np.ndarray) -> np.ndarray:
        return self.table[h >> np.uint64(64 - BITS)] >= self.hot


def shingle_order(docs: DataFrame) -> Broadcast:
    """Counts of all documents' shingles by hash bucket: summed per task, then by parts; the whole
    table (of fixed size) is what the driver gets and sends out."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXT_ROWS):
                found = shingles(raw_texts(batch.column(0).slice(at, TEXT_ROWS)))
                buckets = (np.concatenate([np.zeros(0, np.uint64), *found]) >> np.uint64(64 - BITS)).astype(np.int64)
                sums += np.bincount(buckets, minlength=1 << BITS)
        if sums.any():
            parts = [p.tobytes() for p in np.split(sums, PARTS)]
            task = [TaskContext.get().partitionId()] * PARTS
            yield pa.RecordBatch.from_arrays(
                [pa.array(task, pa.int32()), pa.array(range(PARTS), pa.int32()), pa.array(parts)],
                names=["task", "part", "data"],
            )

    sent = docs.select("text").mapInArrow(tidied(tasks), "task int, part int, data binary")
    table = np.zeros((PARTS, (1 << BITS) // PARTS), np.int64)
    for part, counts in added(sent, "<i8").items():
        table[part] = counts
    return docs.sparkSession.sparkContext.broadcast(Order(table.reshape(-1)))


def node_of(h: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).astype(np.int64))


def bins_of(h: np.ndarray) -> bytes:
    """How many shingles fall into each bin, in bytes if they suffice."""
    counts = np.bincount((h >> np.uint64(17)).astype(np.int64) % BINS, minlength=BINS)
    return counts.astype("u1" if counts.max() < 256 else "<u4").tobytes()


def _binned(blobs: pa.Array) -> np.ndarray:
    """The counts of several sets, a row each."""
    blobs = blobs.to_pylist()
    if all(len(b) == BINS for b in blobs):
        return np.frombuffer(b"".join(blobs), "u1").reshape(-1, BINS)
    return np.stack([np.frombuffer(b, "u1" if len(b) == BINS else "<u4").astype(np.uint32) for b in blobs])


def sets_of(docs: DataFrame, order: Broadcast) -> DataFrame:
    """Of each document: number of shingles, node (a hash of the set, null if empty), prefix and bins, the
    latter two once per task and node. Hot prefix shingles stand apart."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        none = np.zeros(0, np.uint64)
        for batch in batches:
            sizes, nodes, cold, hot, bins = [], [], [], [], []
            for at in range(0, batch.num_rows, TEXT_ROWS):
                for h in shingles(raw_texts(batch.column(1).slice(at, TEXT_ROWS))):
                    node = node_of(h) if len(h) else None
                    first = none
                    bins.append(None)
                    if node is not None and node not in seen:
                        seen.add(node)
                        first, bins[-1] = order.value(h)[: prefix_length(len(h))], bins_of(h)
                    is_hot = order.value.is_hot(first)
                    sizes.append(len(h))
                    nodes.append(node)
                    cold.append(first[~is_hot])
                    hot.append(first[is_hot])
            lists = [
                list_array(
                    pa.array(np.concatenate([none, *part]).view(np.int64)), [len(p) for p in part]
                )
                for part in (cold, hot)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), *lists,
                    pa.array(bins, pa.binary()),
                ],
                names=["doc_id", "n", "node", "prefix", "hot", "bins"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(tasks), SETS)


def _too_far(n: str, m: str) -> Column:
    """Sizes so far apart that the sets cannot be similar."""
    return F.least(n, m) * 100 < F.greatest(n, m) * PERCENT


def meetings(sets: DataFrame) -> DataFrame:
    """token, node, n, place, first: nodes of a prefix shingle that another node of a similar size has
    as well, and the shingle's place in the node's set. ``first`` is false where the shingle lies too far
    back to be the first that the set shares with a similar one of those sizes."""
    cold = sets.select(F.posexplode("prefix").alias("place", "token"), "node", "n").repartition("token")
    by_size = Window.partitionBy("token").orderBy("n", "node")
    sizes = {"before": F.lag("n").over(by_size), "after": F.lead("n").over(by_size)}
    # the smallest set of a size that is similar to this one's, or the set itself
    step = 10**6  # of the logarithms of sizes, as integers
    smaller = Window.partitionBy("token").orderBy("log_n").rangeBetween(math.floor(math.log(PERCENT / 100) * step) - 1, 0)
    cold = cold.dropDuplicates(["token", "node"]).withColumn("log_n", F.floor(F.ln("n") * step))
    cold = cold.withColumns({**sizes, "low": F.min("n").over(smaller)})
    near = [F.col(c).isNotNull() & ~_too_far("n", c) for c in sizes]
    cold = cold.where(near[0] | near[1]).withColumn("first", F.col("place") <= F.col("n") - _needed("n", "low"))
    hot = sets.select(F.posexplode("hot").alias("at", "token"), "node", "n", F.size("prefix").alias("cold"))
    hot = hot.dropDuplicates(["token", "node"]).withColumn("place", F.col("at") + F.col("cold"))
    columns = ["token", "node", "n", "place", "first"]
    return cold.select(columns).unionByName(hot.withColumn("first", F.lit(True)).select(columns))


class PrefixTree:
    """Sets in global order. A set's branch leaves that of the set before it at ``depth``; down to
    there both share nodes, and whatever was found on them."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].tobytes())
        self.sets = [sets[i] for i in self.order]
        self.depth = [0]
        for one, other in zip(self.sets, self.sets[1:], strict=False):
            n = min(len(one), len(other))
            apart = np.flatnonzero(one[:n] != other[:n])
            self.depth.append(int(apart[0]) if len(apart) else n)

    def similar(self, probe: np.ndarray, step: int = 512) -> Iterator[int]:
        """Places of the sets whose similarity to ``probe`` reaches the threshold."""
        probe = np.sort(probe)
        missed = np.zeros(1, np.int64)  # misses among the first 0, 1, ... shingles of the branch
        for place, own, depth in zip(self.order, self.sets, self.depth, strict=True):
            missed = missed[: depth + 1]
            may_miss = len(own) - least_overlap(len(own), len(probe))
            while len(missed) <= len(own) and missed[-1] <= may_miss:
                part = own[len(missed) - 1 :][:step]
                at = np.minimum(np.searchsorted(probe, part), len(probe) - 1)
                missed = np.concatenate([missed, missed[-1] + np.cumsum(probe[at] != part)])
            if len(missed) > len(own) and missed[-1] <= may_miss:
                yield place


def _star(own: pd.DataFrame, centre: pd.DataFrame) -> pd.DataFrame:
    if own.empty or centre.empty:
        return pd.DataFrame({"a": [], "b": []})
    own = own.sort_values("node", ignore_index=True)
    tree = PrefixTree([s.view(np.uint64) for s in own["shingles"]])
    probe = centre["probe"].iloc[0].view(np.uint64)
    found = own["node"].to_numpy()[list(tree.similar(probe))]
    return pd.DataFrame({"a": centre["own"].iloc[0], "b": found})


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of ``pairs`` (centre, node) that may be similar: in each bin two sets have at most the smaller
    count in common. ``nodes`` has node, n and bins."""
    other = nodes.select(F.col("node").alias("centre"), F.col("n").alias("m"), F.col("bins").alias("other"))
    both = pairs.join(nodes.select("node", "n", "bins"), "node").join(other, "centre")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                most = np.minimum(_binned(part.column("bins")), _binned(part.column("other"))).sum(axis=1, dtype=np.int64)
                sizes = part.column("n").to_numpy() + part.column("m").to_numpy()
                may = pa.array(most >= -(-PERCENT * sizes // (100 + PERCENT)))
                yield part.select(["centre", "node"]).filter(may)

    return both.select("centre", "node", "n", "m", "bins", "other").mapInArrow(tidied(tasks), "centre long, node long")


def _needed(n: str, m: str) -> Column:
    """What sets of these sizes must have in common."""
    return F.ceil((F.col(n) + F.col(m)) * PERCENT / (100 + PERCENT))


def _reachable(n: str, place: str, m: str, other: str) -> Column:
    """Whether sets that have their first common shingle at these places can have enough in common."""
    left = F.least(F.col(n) - F.col(place), F.col(m) - F.col(other))
    return left >= _needed(n, m)


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (centre, node) whose sets (node, shingles) are similar, as a, b."""
    dealt = pairs.groupBy("centre").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    sides = pairs.join(dealt, "centre").withColumn("part", part).drop("parts").join(sets, "node")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    centres = dealt.select(F.col("centre").alias("node"), every).join(sets, "node")
    # aliases, as both sides come from the same columns
    centres = centres.select(
        F.col("node").alias("centre"), "part", F.col("node").alias("own"), F.col("shingles").alias("probe")
    )
    return (
        sides.groupBy("centre", "part")
        .cogroup(centres.groupBy("centre", "part"))
        .applyInPandas(_star, "a long, b long")
    )


def sets_for(docs: DataFrame, nodes: DataFrame, order: Broadcast) -> DataFrame:
    """node, shingles (in global order) of ``nodes`` (node, doc_id), from the documents' texts."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXT_ROWS):
                wanted = batch.column(0).slice(at, TEXT_ROWS).to_pylist()
                found = shingles(raw_texts(batch.column(1).slice(at, TEXT_ROWS)))
                # a row that repeats an id with another text is another node
                same = []
                for w, h in zip(wanted, found, strict=True):
                    same.append(w not in seen and len(h) > 0 and node_of(h) == w)
                    if same[-1]:
                        seen.add(w)
                found = [order.value(h) for h, s in zip(found, same, strict=True) if s]
                flat = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w for w, s in zip(wanted, same, strict=True) if s], pa.int64()),
                        list_array(pa.array(flat), [len(h) for h in found]),
                    ],
                    names=["node", "shingles"],
                )

    ids = nodes.select("node", F.col("doc_id").alias("id"))
    if ids.count() <= BROADCAST:
        ids = F.broadcast(ids)
    rows = docs.select("doc_id", "text").join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("id")))
    # rows that repeat an id and its text may give a set twice, which makes the same links again
    return rows.select("node", "text").mapInArrow(tidied(tasks), "node long, shingles array<long>")


def links(docs: DataFrame, rows: DataFrame, met: DataFrame, nodes: DataFrame, order: Broadcast) -> DataFrame:
    """Links (a, b) of nodes that join all similar sets into components."""
    first_id = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    have: DataFrame | None = None

    def verified(pairs: DataFrame) -> DataFrame:
        """Links among the pairs; sets are made of the documents when first asked for."""
        nonlocal have
        ends = pairs.select("node").unionByName(pairs.select(F.col("centre").alias("node"))).dropDuplicates()
        if have is not None:
            ends = ends.join(have.select("node"), "node", "left_anti")
        new = stored(sets_for(docs, stored(ends.join(first_id, "node"), "wanted"), order), "shingles")
        have = new if have is None else have.unionByName(new)
        return linked(pairs, have)

    # the share of its prefix that a node has in common with others is highest for the original of
    # many copies, which makes it the best centre
    firsts = met.where("first")
    share = firsts.groupBy("node", "n").agg((F.count("*") / F.col("n")).alias("share"))
    rank = F.struct("share", F.xxhash64("node").alias("_by"), F.col("node").alias("centre"), F.col("n").alias("m"))
    centres = firsts.join(share.drop("n"), "node").groupBy("token").agg(F.max(rank).alias("c"))
    stars = firsts.join(centres.select("token", "c.centre", "c.m"), "token")
    stars = stars.where((F.col("node") != F.col("centre")) & ~_too_far("n", "m"))
    stars = stars.select("centre", "node").dropDuplicates()
    found = stored(verified(stored(plausible(stars, nodes), "star-pairs")), "links")

    roots = components(found)
    rooted = firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    rest = rooted.join(open_.where("low < high").select("token"), "token")
    rest = stored(rest.select("token", "node", "n", "place", "root"), "unsettled")
    others = rest.select(
        "token", F.col("node").alias("centre"), F.col("n").alias("m"), F.col("place").alias("other"),
        F.col("root").alias("_root"),
    )
    pairs = rest.join(others, "token").where(
        (F.col("root") != F.col("_root"))
        & (F.col("node") < F.col("centre"))
        & ~_too_far("n", "m")
        & _reachable("n", "place", "m", "other")
    )
    pairs = pairs.select("centre", "node").dropDuplicates()
    return found.unionByName(stored(verified(stored(plausible(pairs, nodes), "rest-pairs")), "links"))


def with_node(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with each text's node."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = []
            for at in range(0, batch.num_rows, TEXT_ROWS):
                found = shingles(raw_texts(batch.column("text").slice(at, TEXT_ROWS)))
                nodes += [node_of(h) if len(h) else None for h in found]
            yield batch.append_column(name, pa.array(nodes, pa.int64()))

    return docs.mapInArrow(tidied(tasks), T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def near_duplicates(docs: DataFrame, nodes: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: the smallest id that it reaches by
    links between documents of at least ``PERCENT`` percent similarity, itself included. ``nodes``
    names two more columns: the text's node and its component's (null without words)."""
    order = shingle_order(docs)
    path = scratch_path(docs.sparkSession, "sets")
    sets = stored_at(sets_of(docs, order), path)
    rows = stored(sets.select("doc_id", "n", "node"), "set-sizes")
    own = sets.where("bins is not null")
    bins = stored(own.select("node", "n", "bins").dropDuplicates(["node"]), "bins")
    met = stored(meetings(own.select("node", "n", "prefix", "hot")), "meetings")
    remove(docs.sparkSession, path)  # prefixes are as large as a fifth of all shingles
    roots = components(stored(links(docs, rows, met, bins, order), "all-links"))
    low = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    low = low.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lows = low.groupBy("root").agg(F.min("low").alias("component"))
    found = rows.join(low.join(lows, "root").select("node", "root", "component"), "node", "left")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        *[F.col(c).alias(name) for c, name in zip(("node", "root"), nodes, strict=False)],
    )
