"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame functions only.

A sketch is the ``k`` smallest distinct hashes of a document's shingles. Sketches of parts merge
into the sketch of the whole, and two sketches estimate resemblance, containment and the number of
distinct shingles. Words are runs without white space, in lower case; a shingle is
``width`` consecutive words, the whole sequence if there are fewer.

Defined results: null text = empty; a text without words has an empty sketch; two empty sketches
resemble each other fully (1.0), an empty and a filled one not at all; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

K = 64
WIDTH = 5
SPACE = 2.0**64


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """The hash of every shingle, in order: words are hashed once, shingles from word hashes."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        starts = F.slice(h, 1, F.greatest(F.size(h) - width + 1, F.lit(0)))
        rolled = F.transform(
            starts, lambda x, i: F.xxhash64(x, *[h[i + j] for j in range(1, width)])
        )
        few = F.array(F.aggregate(h, F.lit(42).cast("long"), lambda acc, x: F.xxhash64(acc, x)))
        empty = F.array().cast("array<bigint>")
        return F.when(F.size(h) == 0, empty).when(F.size(h) < width, few).otherwise(rolled)

    return F.transform(F.array(hashed), shingles)[0]


def bottom_k(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    return bottom_k(shingle_hashes(F.coalesce(text, F.lit("")), width), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return bottom_k(F.concat(a, b), k)


def merged(df: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """One sketch per group of parts. Hashes are reduced to one row per group and hash before the
    shuffle, and only those among a group's smallest ``k`` are collected, so no group grows."""
    from pyspark.sql import Window

    each = df.select(*keys, F.explode(column).alias("_hash")).dropDuplicates([*keys, "_hash"])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))
    low = each.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return low.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the ``k`` smallest hashes of the union that both hold (0 to 1)."""
    union = F.array_union(a, b)
    low = F.slice(F.sort_array(union), 1, k)
    both = F.size(F.array_intersect(low, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(low)).cast("double")


def distinct_count(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    top = (s[k - 1].cast("double") + F.lit(SPACE / 2)) / F.lit(SPACE)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / top)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds: resemblance times union, over a's count."""
    r = resemblance(a, b, k)
    union = (distinct_count(a, k) + distinct_count(b, k)) / (1 + r)
    held = r * union / distinct_count(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), held)).cast("double")


def as_text(s: Column) -> Column:
    """The fingerprint as a string of 16 hex digits per hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(df: DataFrame, key: str, columns: dict[str, str], per_slice: int = 500) -> DataFrame:
    """Adds to each row columns of the row that follows it by ``key`` (after the last: the first).

    ``columns`` names the added column for each source column. Rows are dealt into slices of
    neighbouring keys by cut points, so that no window holds more than a few thousand rows; what
    crosses a slice's end is the first row of the next slice, joined to the slice by number. Rows with equal
    keys follow one another in the order of the source columns.
    """
    from pyspark.sql import Window

    n = df.count()
    slices = min(50_000, max(1, math.ceil(n / per_slice)))
    cuts = sorted(
        set(df.approxQuantile(key, [i / slices for i in range(1, slices)], 0.1 / slices))
        if slices > 1
        else []
    )
    order = [F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in columns]]
    sliced = df.withColumn("_slice", _slice_of(F.col(key), [int(c) for c in cuts]))
    window = Window.partitionBy("_slice").orderBy(*order)
    struct = F.struct(*[F.col(c).alias(a) for c, a in columns.items()])
    inside = sliced.withColumns({"_next": F.lead(struct).over(window), "_rank": F.row_number().over(window)})
    heads = inside.where("_rank = 1").select(F.col("_slice").alias("_head_slice"), struct.alias("_follow"))
    # which slice follows which: numbers alone, at most as many as there are slices
    line = Window.orderBy("_slice")
    entire = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("_slice").over(line), F.first("_slice").over(entire))
    follow = sliced.select("_slice").distinct().select("_slice", after.alias("_after"))
    follow = follow.join(heads, F.col("_after") == F.col("_head_slice")).select("_slice", "_follow")
    taken = F.coalesce("_next", "_follow")
    return (
        inside.join(follow, "_slice", "left")
        .withColumn("_taken", taken)
        .select(*df.columns, *[F.col(f"_taken.{a}").alias(a) for a in columns.values()])
    )


def _slice_of(value: Column, cuts: list[int]) -> Column:
    """How many cut points are at or below ``value``: a binary search in a constant array."""
    if not cuts:
        return F.lit(0)
    array = F.lit(cuts).cast(T.ArrayType(T.LongType()))
    steps = F.lit([1 << i for i in reversed(range(len(cuts).bit_length()))])

    def climb(found: Column, step: Column) -> Column:
        at = found + step
        fits = (at <= len(cuts)) & (F.try_element_at(array, at) <= value)
        return F.when(F.coalesce(fits, F.lit(False)), at).otherwise(found)

    return F.aggregate(steps, F.lit(0), climb)


def fingerprints(
    docs: DataFrame, texts: dict[str, str], k: int = K, width: int = WIDTH
) -> DataFrame:
    """Adds a sketch column for each text column that ``texts`` names."""
    return docs.withColumns({out: sketch(F.col(text), k, width) for text, out in texts.items()})
