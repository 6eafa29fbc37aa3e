"""Mixing against plain water-filling and plain highest quotients."""

import hashlib
import heapq
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gridmart.llm import mixing, queries

SCHEMA = "doc_id long, source string, text string"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        among = sum(weight[s] for s in order if s not in capped)
        share = {s: most * sizes[s] if s in capped else Fraction(left * weight[s], among) for s in order}
        above = {s for s in order if share[s] > most * sizes[s]}
        if not above:
            return order, share
        capped |= above


def highest(votes, seats):
    """Seats by the highest quotients, ties to the first."""
    got = [0] * len(votes)
    heap = [(-Fraction(v), i) for i, v in enumerate(votes) if v > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i = heapq.heappop(heap)
        got[i] += 1
        heapq.heappush(heap, (-Fraction(votes[i]) / (2 * got[i] + 1), i))
    return got


def seeded(*values):
    return hashlib.md5("|".join(["0", *[str(v) for v in values if v is not None]]).encode()).hexdigest()


def plain(rows, block=16, shard=1 << 16):
    docs = [(i, s, len(re.findall("[^\x20\x09-\x0d]+", t or "")), t) for i, s, t in rows]
    sizes = {}
    for _, s, n, _ in docs:
        sizes[s] = sizes.get(s, 0) + n
    order, share = plain_targets(sizes)
    filled = [s for s in order if sizes[s]]
    total = sum(sizes.values())
    quota = dict(zip(filled, highest([share[s] for s in filled], int(Fraction(total, block) + Fraction(1, 2))), strict=True))
    out = []
    for source in order:
        words = []  # how often each word of the source is taken
        if sizes[source]:
            blocks = -(-sizes[source] // block)
            held = [min(shard, blocks - i) for i in range(0, blocks, shard)]
            for k, (n, q) in enumerate(zip(held, highest(held, min(quota[source], 3 * blocks)), strict=True)):
                start = int(seeded(source, k)[:8], 16) % n
                for j in range(n):
                    words += [q // n + ((j - start) % n < q % n)] * block
        place = 0
        text_hash = lambda t: (t is not None, t and hashlib.md5(t.encode()).hexdigest())
        held = [d for d in docs if d[1] == source]
        held.sort(key=lambda d: (seeded(d[0]), d[0] is not None, d[0] or 0, d[2], text_hash(d[3])))
        for key, _, n, _ in held:
            out.append((key, source, n, sizes[source], float(share[source]), sum(words[place : place + n]), place))
            place += n
    return sorted(out, key=str)


def run(docs, **options):
    found = mixing.mix(docs, **options)
    assert found.columns == ["doc_id", "source", "size", "source_size", "target", "taken", "begin"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def check(found, expected):
    assert [r[:4] + r[5:] for r in found] == [r[:4] + r[5:] for r in expected]
    assert [r[4] for r in found] == pytest.approx([r[4] for r in expected], rel=1e-12)


def by_source(rows):
    out = {}
    for r in rows:
        out.setdefault(r[1], [r[4], 0])[1] += r[5]
    return out


def test_equals_plain_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    found = run(docs)
    check(found, plain(rows))
    for target, taken in by_source(found).values():
        assert abs(target - taken) <= 4 * mixing.BLOCK
    query = queries.SPARK["op13_mixing"](spark, sf_dir)
    assert query.columns == ["doc_id", "size", "source_size", "target", "taken"]


@pytest.mark.parametrize("block,shard", [(1, 5), (4, 3), (16, 1 << 16)])
def test_odd_tables(spark, block, shard):
    """A hot source, tiny and empty ones, null names and texts, repeated ids and rows, clashing columns."""
    rng, rows = random.Random(block), []
    for source, n in [("hot", 200), ("a", 1), ("Z", 3), ("é", 20), (None, 30), ("", 8), ("\U0001f600", 9), ("￿", 9)]:
        for i in range(n):
            text = rng.choice([None, "", " \t\x0b", "w", "ein wort", "a b\nc " * rng.randint(1, 40)])
            rows.append((rng.choice([i, 5, None, -i]), source, text))
    rows += [(9, "none", None), (9, "none", "")] + [rows[3]] * 20
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("size", "target", "words", "rank")})
    found = run(docs, block=block, shard=shard)
    check(found, plain(rows, block, shard))
    assert all(r[5] <= 3 * r[2] for r in found)
    assert found == run(docs.repartition(7), block=block, shard=shard)


def test_limits_are_reached_and_never_passed(spark):
    rows = [(i, "big", "w " * 1000) for i in range(50)] + [(i, f"small{i}", "w " * 100) for i in range(5)]
    found = run(spark.createDataFrame(rows, SCHEMA))
    totals = by_source(found)
    assert all(totals[f"small{i}"][0] == 300 for i in range(5)) and totals["big"][0] == 50_500 - 1500
    assert all(abs(target - taken) <= 4 * mixing.BLOCK for target, taken in totals.values())


def test_quotas_equal_the_highest_quotients(spark):
    rng = random.Random(4)
    for seats in (0, 1, 7, 1000):
        votes = [rng.choice([0, 1, 1, 5, rng.randint(0, 10_000)]) for _ in range(60)]
        rows = [(g, k, float(v), seats) for g in (None, "x") for k, v in enumerate(votes)]
        claims = spark.createDataFrame(rows, "g string, k long, v double, s long")
        for groups in (["g"], []):
            some = claims if groups else claims.where("g is null")
            found = mixing.apportioned(some, groups, "k", "v", "s", "got").collect()
            expected = highest(votes, seats)
            assert all(r["got"] == expected[r["k"]] for r in found) and len(found) == some.count()


def test_empty_table_and_one_without_words(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    rows = [(1, "a", None), (2, None, ""), (2, None, " ")]
    check(run(spark.createDataFrame(rows, SCHEMA)), [(1, "a", 0, 0, 0.0, 0, 0), *[(2, None, 0, 0, 0.0, 0, 0)] * 2])
