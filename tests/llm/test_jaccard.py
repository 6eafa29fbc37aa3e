"""The similarity join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmart.llm import jaccard, queries
from test_covertree_graph import plain_components


def plain_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(rows):
    """doc_id -> (n, component) by an inverted index and exact counts."""
    sets = [plain_set(t) for _, t in rows]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    links = []
    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in where[x]:
                if j > i:
                    shared[j] = shared.get(j, 0) + 1
        links += [(i, j) for j, n in shared.items() if 100 * n >= 80 * (len(s) + len(sets[j]) - n)]
    roots = plain_components(range(len(rows)), links)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[roots[i]] = min(low.get(roots[i], doc), doc)
    return sorted((doc, len(sets[i]), low[roots[i]]) for i, (doc, _) in enumerate(rows))


def near_copies(n, seed=1):
    dice = random.Random(seed)
    word = lambda: "".join(dice.choices("abcdefgh", k=3))
    line = " ".join(word() for _ in range(60))
    out = []
    for _ in range(n // 20):
        base = [word() for _ in range(dice.randint(6, 90))]
        for _ in range(20):
            text = list(base)
            for _ in range(dice.choice([0, 0, 1, 1, 2, 3, 5])):
                text[dice.randrange(len(text))] = word()
            if dice.random() < 0.2:
                text += line.split()
            out.append(" ".join(text))
    dice.shuffle(out)
    return out


@pytest.fixture(scope="module")
def rows():
    odd = [None, "", "  \n", "one", "One", "one two", "a b c d e", "A B c\td e", "é É", "é é", "x\x0by\x0cz"]
    return list(enumerate(near_copies(400) + odd + ["long " * 30_000 + "end", "LONG " * 30_000 + "end"]))


def test_prefix_tree_finds_all_similar_sets():
    rng = np.random.default_rng(0)
    for _ in range(30):
        base = rng.permutation(60)[: rng.integers(1, 50)]
        sets = []
        for _ in range(25):
            keep = base[rng.random(len(base)) < rng.choice([0.8, 0.95, 1])]
            sets.append(np.unique(np.append(keep, rng.integers(0, 90, rng.integers(0, 5)))).astype(np.uint64))
        sets = [s for s in sets if len(s)]
        probe = sets[0]
        similar = lambda s: 100 * len(np.intersect1d(s, probe)) >= 80 * len(np.union1d(s, probe))
        found = sorted(jaccard.PrefixTree(sets).similar(probe, step=3))
        assert found == [i for i, s in enumerate(sets) if similar(s)]


@pytest.mark.parametrize("settings", [{}, {"STAR": 3, "BROADCAST": 0}])
def test_components_equal_all_pairs(spark, rows, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(jaccard, name, value)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, node int")
    found = jaccard.near_duplicates(df.repartition(4))
    assert sorted(tuple(r) for r in found.collect()) == plain(rows)


def test_long_texts_are_hashed_in_stretches(monkeypatch):
    texts = [t.encode() for t in near_copies(40)] + [b"w" * 500, b"", b"a b"]
    whole = jaccard.shingles(texts)
    monkeypatch.setattr(jaccard, "STRETCH", 64)
    for one, other in zip(whole, jaccard.shingles(texts), strict=True):
        assert one.tolist() == other.tolist()


def test_hot_shingles_are_grouped_by_a_join_only(spark, rows, monkeypatch):
    """Sets whose prefixes stand apart as hot give the same components."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = jaccard.shingle_order(df)
    sets = jaccard.sets_of(df, order)
    heated = sets.withColumn("hot", F.concat("hot", F.filter("prefix", lambda t: t % 2 == 0)))
    heated = heated.withColumn("prefix", F.filter("prefix", lambda t: t % 2 != 0))
    monkeypatch.setattr(jaccard, "sets_of", lambda docs, order: heated)
    found = jaccard.near_duplicates(df)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows)


def test_word_hashes_tell_words_apart():
    texts = [b"one two  one\tTWO", b"", b"two one", b"a b c d", b"a b c d e", b"d c b a", b"\x00 \x01", b"\x01 \x00"]
    h, places = jaccard.word_hashes(texts[0])
    assert places.tolist() == [0, 4, 9, 13] and h[0] == h[2] != h[1] == h[3]
    sets = [tuple(s) for s in jaccard.shingles(texts)]
    assert [len(s) for s in sets] == [1, 0, 1, 1, 1, 1, 1, 1] and len(set(sets)) == len(texts)
    alone = [tuple(jaccard.shingles([t])[0]) for t in texts]
    assert alone == sets


def test_repeated_and_missing_rows(spark):
    text = "the same seven words stand here twice"
    data = [(5, text), (5, text), (3, text.upper()), (9, None), (9, None), (None, text)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    found = sorted((tuple(r) for r in jaccard.near_duplicates(df).collect()), key=str)
    assert found == [(3, 3, 3), (5, 3, 3), (5, 3, 3), (9, 0, 9), (9, 0, 9), (None, 3, 3)]
    assert jaccard.near_duplicates(df.where("false")).count() == 0


def test_op4_on_the_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = queries.op4_jaccard(spark, sf_dir)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(tuple(r) for r in found.collect()) == plain(docs)
