"""The language model: exact counts and base scores, a proper distribution, gain on held-out text."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmart.llm import maxent, queries


def plain_base(rows):
    """(doc_id, held_out, n_tokens, n_known, N, base score) by the formula."""
    split = [(d, zlib.crc32(str(d).encode()) % 7 == 2, [*(t or "").encode().lower().split(), None]) for d, t in rows]
    counts = Counter(w for _, out, words in split if not out for w in words)
    total, kinds = sum(counts.values()), len(counts)
    return sorted(
        (
            d, out, len(words), sum(w in counts for w in words), total,
            sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words),
        )
        for d, out, words in split
    )


def got(found):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    return sorted(tuple(r[n] for n in names) for r in found)


def assert_same(found, want):
    assert [g[:5] for g in found] == [w[:5] for w in want]
    assert [g[5] for g in found] == pytest.approx([w[5] for w in want])


def test_op6_on_the_whole_table(spark, sf_dir, monkeypatch):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    monkeypatch.setattr(maxent, "FREQUENT", 500)
    found = queries.op6_maxent(spark, sf_dir).collect()
    assert_same(got(found), plain_base(docs))
    out = [r for r in found if r.held_out]
    assert len(out) > 10 and sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_a_class_distribution_sums_to_one(spark):
    rows = [("a b a c",), ("b a rare1 rare2 rare2",), ("",), (None,)]
    docs = spark.createDataFrame(rows, "text string")
    vocabulary = maxent.counted(docs)
    assert {bytes(r.word): r.c for r in vocabulary.collect()} == {b"a": 3, b"b": 2, b"c": 1, b"rare1": 1, b"rare2": 2}
    words = maxent.Words.of(vocabulary, 4)
    assert (words.tokens, words.kinds) == (9 + 4, 6)
    frequent = 10.0 ** words.inside()
    for c in range(maxent.CLASSES):
        mine = frequent[words.classes == c].sum()
        assert mine == 0 or mine == pytest.approx(1)
    history = maxent.History(words, [[b"a", b"zz", b"b"], []])
    weights = np.random.default_rng(0).normal(size=(words.rows(), maxent.CLASSES)).astype(np.float32)
    shares = np.exp(maxent.log_shares(words.start(), weights, history.rows))
    assert shares.shape == (5, maxent.CLASSES) and np.allclose(shares.sum(axis=1), 1, atol=1e-5)
    assert (history.classes == maxent.END).sum() == 2 and history.rare == [[b"zz"], []]


def test_rare_classes_agree_with_sql(spark):
    words = [b"", b"a", b"ab", b"abc", "é".encode(), "tré".encode()]
    df = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
    found = [r[0] for r in df.select(maxent.ending_of(F.col("word"), 8)).collect()]
    assert found == [maxent.ending(w, 8) for w in words]


def test_training_learns_what_follows(spark):
    texts = [(f"{i} " + "the cat the dog " * 200,) for i in range(60)]
    texts += [(f"{i} " + "der hund der vogel " * 200,) for i in range(60)]
    docs = spark.createDataFrame(texts, "text string").repartition(3)
    words = maxent.Words.of(maxent.counted(docs), docs.count())
    weights = maxent.train(docs, words)
    history = maxent.History(words, [[b"the", b"cat", b"the"], [b"der", b"hund", b"der"]])
    shares = np.exp(maxent.log_shares(words.start(), weights, history.rows))
    after = words.classes[words.number[b"the"]]
    assert shares[2][after] > 0.8 and shares[6][words.classes[words.number[b"der"]]] > 0.8


def test_scores_equal_a_plain_model(spark, sf_dir, monkeypatch):
    """Counts of classes by feature, weights, and the texts' scores, from dictionaries and loops."""
    monkeypatch.setattr(maxent, "FREQUENT", 300)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    rows = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    raw = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    kept = []
    monkeypatch.setattr(maxent, "tuned", lambda docs, words, weights, bands, fn=maxent.tuned: kept.append(
        fn(docs, words, weights, bands)) or kept[-1])
    found = {r.doc_id: r.score for r in maxent.scores(docs, F.lit(False)).collect()}
    scales = kept[0]

    counts = Counter(w for _, text in rows for w in text)
    bands = Counter(math.floor(math.log2(c) * 8) for c in counts.values())
    least, room = max(bands) + 1, 300
    while least > 1 and bands.get(least - 1, 0) <= room:
        least -= 1
        room -= bands.get(least, 0)
    often = sorted((w for w, c in counts.items() if math.floor(math.log2(c) * 8) >= least), key=lambda w: (-counts[w], w))
    number = {w: i for i, w in enumerate(often)}

    def code(w):
        return number[w] if w in number else len(often) + maxent.ending(w, maxent.RARE)

    def class_of(w):
        if w is None:
            return maxent.END
        if w in number:
            return number[w] if number[w] < maxent.OWN else maxent.OWN + 1 + maxent.ending(w, maxent.SHARED)
        return maxent.END + 1 + maxent.SHARED + maxent.ending(w, maxent.RARE)

    mass = Counter({c: 0.0 for c in range(maxent.CLASSES)})
    for w in often:
        mass[class_of(w)] += counts[w]
    mass[maxent.END] = len(rows)
    for c in range(maxent.RARE):
        mass[maxent.END + 1 + maxent.SHARED + c] = 1
    for w, c in counts.items():
        if w not in number:
            mass[class_of(w)] += c + 1
    floor = {c: max(m, 0.5) for c, m in mass.items()}
    common = np.array([floor[c] / sum(floor.values()) for c in range(maxent.CLASSES)])
    total = sum(counts.values()) + len(rows)
    n_rows = min(maxent.ROWS, max(maxent.LEAST_ROWS, 1 << int(total / maxent.TOKENS_A_ROW).bit_length()))
    quarter = n_rows // 4

    def hashed(history, first, size):
        h = ((history + 1) % 2**64) * 0x9E3779B97F4A7C15 % 2**64
        h = (h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 % 2**64
        return first + (h ^ (h >> 32)) % size

    def events(text):
        codes = [-1, -1, *[code(w) for w in text], None]
        for i, w in enumerate([*text, None]):
            one, two = codes[i + 1], codes[i]
            features = (hashed(one, 0, quarter), hashed(two, quarter, quarter), hashed(one * (1 << 21) + two, 2 * quarter, 2 * quarter))
            yield w, class_of(w), features

    table = Counter()
    for doc, text in rows:
        if zlib.crc32(raw[doc]) % maxent.TUNING:
            for _, c, features in events(text):
                for f in features:
                    table[f, c] += 1
    sums = Counter()
    for (f, _), n in table.items():
        sums[f] += n

    def weight(f, kind):
        cells = np.array([table[f, c] for c in range(maxent.CLASSES)], float)
        own = np.log((cells + maxent.PRIOR * common) / (sums[f] + maxent.PRIOR) / common)
        return scales[kind, int(min(math.log2(sums[f] + 1), maxent.BANDS - 1))] * own

    for doc, text in rows[:25]:
        score = 0.0
        for w, c, features in events(text):
            z = np.log(common) + sum(weight(f, k) for k, f in enumerate(features))
            score += (z[c] - np.log(np.exp(z).sum())) / math.log(10)
            if w in number:
                score += math.log10(counts[w] / mass[c])
            elif w is not None:
                score += math.log10((counts[w] + 1) / mass[c])
        assert found[doc] == pytest.approx(score, rel=1e-4, abs=1e-3)


def test_the_model_does_not_depend_on_the_tasks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    words = maxent.Words.of(maxent.counted(docs), docs.count())
    one, many = (maxent.train(docs.repartition(n), words) for n in (2, 40))
    test = [maxent.words_of((r.text or "").encode()) for r in docs.limit(80).collect()]
    h = maxent.History(words, test)
    own = [maxent.log_shares(words.start(), w, h.rows)[np.arange(len(h.ids)), h.classes].mean() for w in (one, many)]
    base = words.start()[h.classes].mean()
    assert own[0] > base + 0.3 and own[1] == pytest.approx(own[0], abs=1e-3)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "Word word WORD é É"), (3, "Word word WORD é É"), (5, "w " * 50_000)]
    rows += [(i, "x y z") for i in range(10, 40)] + [(50, "long" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    assert_same(got(maxent.scores(docs.repartition(3), out).collect()), plain_base(rows))
    everything = maxent.scores(docs, F.lit(True)).collect()
    assert {r.train_tokens for r in everything} == {0} and {r.n_known for r in everything} == {0}
    assert {r.base_score for r in everything} == {0.0}
    assert maxent.scores(docs.where("false"), F.lit(False)).count() == 0


def test_weights_are_fitted_together(spark, sf_dir, monkeypatch):
    """What the model expects, against a plain sum; an update raises the likelihood of the texts it is fitted to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(80).repartition(3).cache()
    words = maxent.Words.of(maxent.counted(docs), docs.count())
    monkeypatch.setattr(maxent, "HISTORIES", 3000)
    texts = [(r.text or "").encode() for r in docs.collect()]
    fitted_to = [t for t in texts if zlib.crc32(t) % maxent.TUNING]
    history = maxent.History(words, [maxent.words_of(t) for t in fitted_to])
    weights = [maxent.train(docs, words, fits) for fits in range(4)]
    shares = [maxent.log_shares(words.start(), w, history.rows) for w in weights]
    plain = np.zeros(weights[0].shape)
    for kind in history.rows:
        np.add.at(plain, kind, np.exp(shares[0]))
    part = docs.where(F.crc32(F.coalesce("text", F.lit(""))) % maxent.TUNING != 0)
    assert np.allclose(maxent.expected(part, words, weights[0]), plain, rtol=1e-3, atol=1e-3)
    gained = [s[np.arange(len(s)), history.classes].sum() for s in shares]
    assert gained[0] < gained[1] < gained[2] < gained[3]
    assert [t for t in texts if not zlib.crc32(t) % maxent.TUNING]


def test_the_query_fits_weights_together(spark, sf_dir, monkeypatch):
    fits = []
    monkeypatch.setattr(maxent, "fitted", lambda *given, fn=maxent.fitted: fits.append(fn(*given)))
    queries.op6_maxent(spark, sf_dir)
    assert len(fits) == maxent.FITS > 0


def test_products_of_factors_are_the_shares(spark):
    """Also of features that tell opposite things, whose products are none in single precision."""
    docs = spark.createDataFrame([("a b c d e f g " * 40,)], "text string")
    words = maxent.Words.of(maxent.counted(docs), 1)
    start, rows = words.start(), np.array([[0, 1, 2, 9], [3, 4, 2, 9], [5, 4, 1, 9]])
    weights = np.random.default_rng(1).normal(size=(10, maxent.CLASSES)).astype(np.float32)
    weights[0] = np.where(np.arange(maxent.CLASSES) < 24, 40, -40)
    weights[3] = -weights[0]
    factors, common = maxent.factored(weights), np.exp(start)
    parts, total, low = maxent.parted(common, factors, rows)
    assert low.tolist() == [0]
    total[low] = 1
    want = np.exp(maxent.log_shares(start, weights, rows))
    assert np.allclose(parts * common / total[:, None], want, rtol=1e-4, atol=1e-6)
    cells = np.zeros_like(weights)
    codes = (rows[0] << 40) + (rows[1] << 20) + rows[2]
    maxent._expect(cells, common, factors, [codes, codes[1:2]])
    plain = np.zeros_like(weights)
    for kind in rows:
        np.add.at(plain, np.append(kind, kind[1]), np.vstack([want, want[1:2]]))
    assert np.allclose(cells * common, plain, rtol=1e-4, atol=1e-6)


def test_the_driver_gets_tables_by_ranges(spark):
    docs = spark.createDataFrame([("a b a c",), ("b a",)], "text string").repartition(2)
    words = maxent.Words.of(maxent.counted(docs), 2)
    table = np.zeros((words.rows(), maxent.CLASSES))
    for at, counts in maxent.followed(docs, words):
        assert counts.shape == (words.rows() // maxent.PARTS, maxent.CLASSES)
        table[at : at + len(counts)] += counts
    history = maxent.History(words, [[b"a", b"b", b"a", b"c"], [b"b", b"a"]])
    plain = np.zeros_like(table)
    for kind in history.rows:
        np.add.at(plain, (kind, history.classes), 1)
    assert (table == plain).all()
