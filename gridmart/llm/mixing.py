"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Each source has a target in words: its weight's share of all words, at most `MOST` times what it has,
the excess reshared by weight. Targets are apportioned in blocks of equal numbers of words: blocks go
to sources by the highest quotients (target over 1, 3, 5, ...), and a source's blocks to its shards,
stretches of its documents in seeded order, by the same rule. A shard takes as many blocks as its quota
says, one after the other from a seeded one on (so most documents are taken whole), each again where the
quota holds more than it has. What a document gives is its overlap with the blocks taken, a difference
of two values of the shard's running count, so neither blocks nor words are ever rows of their own.

Highest quotients without a queue: at one divisor the rounded quotients are surely too few, at another
surely enough; in between lie at most two candidates per claimant, and the best of them fill up.

Defined results: null text has size 0; a null source is a source, last in order; repeated rows count
each; rows that agree in key, size and text are interchangeable; a table without words has target and
taken 0 everywhere; an empty table gives an empty table; extra columns are ignored. No document gives
more than `MOST` times its size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .ordinals import running, same

WEIGHTS = (1, 2, 3)  # fixed values: repeated over the sources in order
MOST = 3  # fixed value: a source is repeated at most so often
BLOCK = 16  # words; a source's taken words are within four blocks of its target
SHARD = 1 << 16  # blocks
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to ``sources`` (source, words), a row per source.

    Shares are levelled round by round: sources whose share exceeds their limit are set to it, and
    the rest of the words is shared anew among the others, until none exceeds. Every round sets at
    least one more, mostly all there are; it is one aggregate over the sources.
    """
    last = sources.withColumn("_no_source", F.col("source").isNull())
    ranked = running(last, [], ["_no_source", "source"], None, "_rank", "_sources")
    weight = F.element_at(F.lit(list(weights)), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = stored(
        ranked.select("source", "words", weight.cast("double").alias("weight"), F.lit(most) * F.col("words")),
        "mixing-sources",
    ).toDF("source", "words", "weight", "limit")
    left = ranked.agg(F.sum("words"), F.sum("weight")).first()
    words, weights_left = left[0] or 0, left[1] or 0.0
    level, capped = 0.0, F.lit(False)
    settled = 0
    while weights_left and words:
        level = words / weights_left
        capped = F.col("weight") * level >= F.col("limit")
        found = ranked.where(capped).agg(F.count(F.lit(1)), F.sum("limit"), F.sum("weight")).first()
        if found[0] == settled:
            break
        settled = found[0]
        words, weights_left = left[0] - found[1], left[1] - found[2]
    share = F.when(capped, F.col("limit").cast("double")).otherwise(F.col("weight") * level)
    return ranked.select("source", "words", "weight", share.alias("target"))


def _with_totals(df: DataFrame, of: DataFrame, groups: list[str], **totals: Column) -> DataFrame:
    """``df`` with sums over the rows of ``of`` in the same group; without groups, over all of them."""
    if not groups:
        one = of.agg(*[c.alias(n) for n, c in totals.items()])
        row = one.first()
        return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in one.schema})
    names = {g: f"_of_{i}" for i, g in enumerate(groups)}
    found = of.groupBy(*groups).agg(*[c.alias(n) for n, c in totals.items()])
    return same(df, found.withColumnsRenamed(names), names, "inner")


def apportioned(claims: DataFrame, groups: list[str], key: str, votes: str, seats: str, name: str) -> DataFrame:
    """Adds ``name``: how many of the group's ``seats`` (a long, the same in all its rows) go to each row,
    by the highest quotients of ``votes`` (a double) over 1, 3, 5, ..., ties to the smaller ``key``.

    With s seats, v votes and c claimants, rounding v_i / d gives at most s seats in all for the
    divisor d = v / (s - c / 2) and at least s for v / (s + c / 2); the two differ by 2 c at most. The
    one is given at once, and the quotients in between compete for what is left.
    """
    met = _with_totals(claims, claims, groups, _votes=F.sum(votes), _claimants=F.count(F.lit(1)))

    def rounded(per_vote: Column) -> Column:
        got = F.floor(F.col(votes) * per_vote + 0.5).cast("long")
        return F.when(F.col("_votes") > 0, F.least(got, F.col(seats))).otherwise(F.lit(0).cast("long"))

    # one seat more on both sides, so that a double's rounding cannot matter
    spare = F.col("_claimants") / 2 + 1
    few = rounded(F.greatest(F.col(seats) - spare, F.lit(0.0)) / F.col("_votes"))
    met = met.withColumns({"_few": few, "_many": rounded((F.col(seats) + spare) / F.col("_votes"))})
    met = stored(met.drop("_votes", "_claimants"), "mixing-claims")
    more = met.where("_many > _few").withColumn("_seat", F.explode(F.sequence("_few", F.col("_many") - 1)))
    more = more.withColumn("_last", -F.col(votes) / (2 * F.col("_seat") + 1)).select(*groups, key, "_last")
    more = running(more, groups, ["_last", key], None, "_place", "_all")
    more = _with_totals(more, met, groups, _left=F.first(seats) - F.sum("_few"))
    won = more.where("_place < _left").groupBy(*groups, key).agg(F.count(F.lit(1)).alias("_won"))
    names = {g: f"_of_{i}" for i, g in enumerate([*groups, key])}
    given = F.col("_few") + F.coalesce("_won", F.lit(0))
    met = same(met, won.withColumnsRenamed(names), names, "left")
    return met.withColumn(name, given).select(*claims.columns, name)


def _seeded(seed: int, *values: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[v.cast("string") for v in values]))


def _whole(a: Column, b: Column | int) -> Column:
    """Integer quotient of numbers that are not negative."""
    b = F.lit(b) if isinstance(b, int) else b
    return ((a - F.pmod(a, b)) / b).cast("long")


def _given(place: Column, held: Column, quota: Column, start: Column, block: int) -> Column:
    """Words that a shard gives of its first ``place`` ones. It takes all its blocks as often as its quota
    holds them, and of the rest a block each from ``start`` on, going on at its beginning."""
    times, rest = _whole(quota, held), F.pmod(quota, held)
    none, to_end = F.lit(0).cast("long"), held - start

    def taken(j: Column) -> Column:
        from_start = F.least(F.greatest(j - start, none), F.least(rest, to_end))
        again = F.least(j, F.greatest(rest - to_end, none))
        return times * j + from_start + again

    at = _whole(place, block)
    return taken(at) * block + F.pmod(place, F.lit(block)) * (taken(at + 1) - taken(at))


def quotas(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = 0, most: int = MOST) -> DataFrame:
    """A row per source and shard: its blocks, how many it gives (repeats counted), its seeded start, and
    the words that earlier shards of the source give.

    ``sources`` are those of `targets`. A source gives no more blocks than ``most`` times its own.
    """
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    claims = sources.where("words > 0").select(
        "source",
        "words",
        "target",
        F.col("source").isNull().alias("no_source"),
        F.lit(math.floor(total / block + 0.5)).cast("long").alias("seats"),
        (_whole(F.col("words") - 1, block) + 1).alias("blocks"),
    )
    ranked = running(claims, [], ["no_source", "source"], None, "rank", "sources")
    given = apportioned(ranked, [], "rank", "target", "seats", "quota")
    limited = F.least(F.col("quota"), F.lit(most) * F.col("blocks")).alias("of_source")
    numbers = F.sequence(F.lit(0).cast("long"), _whole(F.col("blocks") - 1, shard))
    shards = given.select("source", "words", limited, "blocks", F.explode(numbers).alias("shard"))
    held = F.least(F.lit(shard).cast("long"), F.col("blocks") - F.col("shard") * shard)
    shards = shards.withColumns({"held": held, "votes": held.cast("double")})
    dealt = apportioned(shards, ["source"], "shard", "votes", "of_source", "quota")
    number = F.conv(F.substring(_seeded(seed, F.col("source"), F.col("shard")), 1, 8), 16, 10).cast("long")
    dealt = dealt.withColumn("start", F.pmod(number, F.col("held")))
    size = F.least(F.lit(block * shard).cast("long"), F.col("words") - F.col("shard") * block * shard)
    dealt = dealt.withColumn("gives", _given(size, *[F.col(c) for c in ("held", "quota", "start")], block))
    dealt = running(dealt, ["source"], ["shard"], "gives", "earlier", "of_all")
    return dealt.select("source", "shard", "held", "quota", "start", "earlier")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = 0,
) -> DataFrame:
    """A row per document (doc_id, source, text): its size, its source's words and target, the words
    taken, and where it begins in the seeded order of its source."""
    sized = docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), F.md5("text").alias("same_text"),
        _seeded(seed, F.col("doc_id")).alias("order"),
    )
    sized = stored(sized, "mixing-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("words"))
    aimed = stored(targets(sources, weights, most), "mixing-targets")
    shards = stored(quotas(aimed, block, shard, seed, most), "mixing-quotas")

    placed = running(sized, ["source"], ["order", "doc_id", "size", "same_text"], "size", "begin", "source_size")
    placed = placed.withColumn("end", F.col("begin") + F.col("size"))
    aims = aimed.select(F.col("source").alias("_source"), "target")
    placed = same(placed, aims, {"source": "_source"}, "inner")
    span = block * shard
    for end, shard_of in (("begin", F.col("begin")), ("end", F.col("end") - 1)):
        # the words a source gives before this place: those of earlier shards, and some of its own
        names = {c: f"_{c}" for c in shards.columns}
        at = placed.withColumn("shard", _whole(F.greatest(shard_of, F.lit(0)), span))
        met = same(at, shards.withColumnsRenamed(names), {"source": "_source", "shard": "_shard"}, "left")
        inside = F.col(end) - F.col("shard") * span
        given = F.col("_earlier") + _given(inside, F.col("_held"), F.col("_quota"), F.col("_start"), block)
        placed = met.withColumn(f"given_{end}", given).select(*placed.columns, f"given_{end}")
    taken = F.when(F.col("size") > 0, F.col("given_end") - F.col("given_begin")).otherwise(F.lit(0))
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "begin"
    )
