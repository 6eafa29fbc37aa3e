"""Collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmart.llm import phrases, queries

SCHEMA = "doc_id long, text string, lang string"


def plain_counts(rows):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    return counts, totals


def plain(rows, least=30, top=2000):
    counts, totals = plain_counts(rows)
    candidates = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    out = []
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        hidden = any(
            other == lang and len(longer) > len(words) and 100 * b >= 80 * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (other, longer), b in candidates.items()
        )
        if not hidden:
            out.append((lang, -score, -a, " ".join(words).encode(), left, right))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return ranked


def run(df, **options):
    found = phrases.collocations(df, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


def made_up(seed, n=300, vocabulary=12):
    rng = random.Random(seed)
    words = ["the", "THE", "of", "É", "é", "x\x1cy", " ", " ", "it's", "0", "a-b", "ß"][:vocabulary]
    joints = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!? ", ";:"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice(joints) for _ in range(rng.choice([0, 1, 3, 30])))
        rows.append((i, rng.choice([None, "", text, text, text]), rng.choice(["en", "fr", None, "und", ""])))
    return rows


def test_equals_plain_counting(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    found = sorted(tuple(r) for r in queries.SPARK["op12_phrases"](spark, sf_dir).collect())
    assert found == sorted(plain(rows)) and found


@pytest.mark.parametrize("seed", range(3))
def test_odd_texts(spark, seed):
    rows = made_up(seed)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit(1), "phrase": F.lit("x"), "rank": F.lit(0)})
    plain_rows = [(t, lang) for _, t, lang in rows]
    assert run(docs, least=5) == sorted(plain(plain_rows, 5))
    assert run(docs, least=5, top=3) == sorted(plain(plain_rows, 5, 3))


def test_many_partitions_and_small_maps_change_nothing(spark, monkeypatch):
    rows = made_up(7)
    docs = spark.createDataFrame(rows, SCHEMA)
    expected = sorted(plain([(t, lang) for _, t, lang in rows], 5))
    monkeypatch.setattr(phrases, "STRETCH", 200)
    monkeypatch.setattr(phrases, "MASS", 50)
    found, _ = phrases.frequent(docs, 5, mass=50)
    counts, _ = plain_counts([(t, lang) for _, t, lang in rows])
    wanted = {(lang, " ".join(w)): n for (lang, w), n in counts.items() if n >= 5}
    assert {(r["lang"], r["phrase"]): r["n"] for r in found.collect()} == wanted
    monkeypatch.setattr(phrases, "BITS", 1 << 10)
    assert run(docs, least=5) == expected


def test_a_partition_is_merged_behind_a_shuffle_of_its_own(spark, monkeypatch):
    """A join's shuffle in its place may be read in other parts, and each would drop what it sees too little of."""
    rows = [(i, f"alpha beta w{i} x{i}", "en") for i in range(100)]
    plans, stored = {}, phrases.stored

    def noted(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, purpose)

    monkeypatch.setattr(phrases, "stored", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found, _ = phrases.frequent(spark.createDataFrame(rows, SCHEMA).repartition(24), mass=100)
        assert {r["phrase"]: r["n"] for r in found.collect()} == {"alpha": 100, "beta": 100, "alpha beta": 100}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "REPARTITION_BY_NUM" in plans["phrases-survivors"]


def test_a_very_long_text_and_one_without_pieces(spark):
    rows = [(1, "alpha beta " * 60_000, "en"), (2, "gamma delta. " * 400_000, "en"), (3, "z" * 3_000_000, "fr")]
    found = run(spark.createDataFrame(rows, SCHEMA))
    assert found == sorted(plain([(t, lang) for _, t, lang in rows]))


def test_empty_table_and_empty_texts(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame([(1, None, "en"), (2, "", None), (None, " .\t,", "fr")], SCHEMA)) == []


def test_summary_keeps_every_frequent_item():
    rng = np.random.default_rng(3)
    for _ in range(20):
        items = np.concatenate([rng.integers(0, 5000, 20_000), np.repeat(rng.integers(0, 5000, 20), 40)])
        least = 30
        one, whole = phrases.Summary(len(items) // least + 1), Counter(items.tolist())
        for part in np.array_split(rng.permutation(items), 7):
            kept, counts = np.unique(part.astype(np.uint32), return_counts=True)
            one.add(kept, counts)
            one.settle()
        assert one.taken < least and len(one.items) <= one.capacity
        assert {i for i, n in whole.items() if n >= least} <= set(one.survivors(least).tolist())


def test_products_beyond_64_bits(spark):
    big = 4 * 10**15
    counts = [("en", "a b", big), ("en", "a", big + 1), ("en", "b", 3 * big + 2)]
    found = phrases.scored(spark.createDataFrame(counts, "lang string, phrase string, n long")).first()
    assert (found["score"], found["l"], found["r"]) == (2000000 * big // (4 * big + 3), big + 1, 3 * big + 2)
