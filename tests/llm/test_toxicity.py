"""Classifier chains: held-out accuracy, the chain's wiring, and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmart.llm import queries, toxicity

BAD = ["scum", "trash", "moron"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(2)
    words = np.array([f"w{i}" for i in range(400)])
    rows = []
    for i in range(900):
        text = list(rng.choice(words, rng.integers(3, 80)))
        rude, toxic = i % 5 == 0, i % 10 == 0
        if rude:
            text.insert(len(text) // 2, "Rude!")
        if toxic:
            text.insert(1, BAD[i // 30 % 3].upper() + ",")
        rows.append((i, " ".join(text), int(rude), int(toxic), 0.5))
    return spark.createDataFrame(rows, "doc_id long, text string, rude int, toxic int, extra double")


def test_chain_on_planted_words(planted):
    held = F.col("doc_id") % 3 == 0
    labels = planted.where(~held).select("doc_id", "rude", "toxic")
    chain = toxicity.learn(planted, labels, ["rude", "toxic"], per_class=300)
    assert [len(d) for d in chain.dense] == [1, 2]  # earlier categories, then the intercept
    found = toxicity.score(planted.drop("rude", "toxic"), chain)
    assert found.columns == ["doc_id", "text", "extra", "rude", "toxic"]
    for r in found.where(held).collect():
        assert (r.rude >= 0.5) == (r.doc_id % 5 == 0)
        assert (r.toxic >= 0.5) == (r.doc_id % 10 == 0)


def test_a_bounded_sample_decides_like_all_rows(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(2400):
        toxic, odd = i % 10 == 0, i % 10 in (0, 1, 2, 3) and i // 10 % 2 == 0  # one in four with "odd" is toxic
        text = [f"w{k}" for k in rng.integers(0, 60, 12)] + ["odd"] * odd + [BAD[i % 3]] * (toxic and not odd)
        rows.append((i, " ".join(text), int(i % 4 == 0), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, rude int, toxic int")
    labels, names = docs.drop("text"), ["rude", "toxic"]
    sample = toxicity.sampled(docs, labels, names, 120).groupBy("toxic").agg(F.sum("_weight").alias("w")).collect()
    assert {r.toxic: r.w for r in sample} == pytest.approx({1: 120, 0: 120 * 9})
    found = {}
    for per_class in (10_000, 120):
        scored = toxicity.score(docs, toxicity.learn(docs, labels, names, per_class)).collect()
        found[per_class] = {r.doc_id: (r.toxic, r.rude) for r in scored}
    whole, bounded = found[10_000], found[120]
    same = sum((whole[d][0] >= 0.5) == (bounded[d][0] >= 0.5) for d in whole)
    assert same >= 0.99 * len(rows) and sum(p >= 0.5 for p, _ in bounded.values()) <= 130
    for k in (0, 1):
        mean = [np.mean([p[k] for p in f.values()]) for f in (whole, bounded)]
        assert mean[0] == pytest.approx(mean[1], abs=0.05)


def test_out_of_fold_probabilities_come_from_other_folds(planted):
    labels = planted.select("doc_id", "rude", "toxic")
    sample = toxicity.sampled(planted, labels, ["rude", "toxic"], 50)
    assert sample.count() == 100 and sample.where("toxic = 1").count() == 50
    assert {r.fold for r in sample.collect()} == {0, 1, 2}
    rows = sample.withColumn("at", F.array(F.lit(0)))
    models = {f: np.array([0.0, float(f)]) for f in range(4)}
    for r in toxicity._out_of_fold(rows, models, [], "_p0", 1).collect():
        assert r._p0 == pytest.approx(1 / (1 + np.exp(-r.fold)))


def test_fit_separates_and_ignores_noise():
    rng = np.random.default_rng(0)
    y = (np.arange(400) % 2).astype(float)
    sets = [np.unique(np.append(rng.integers(2, 500, 30), [0] if v else [1])) for v in y]
    rows = np.repeat(np.arange(400), [len(s) for s in sets])
    w = toxicity.fit(rows, np.concatenate(sets), np.zeros((400, 0)), y, 500)
    assert w[0] > 1 > -1 > w[1] and np.abs(w[2:500]).max() < 0.5


def test_edge_cases(spark, planted):
    rows = [(1, None), (2, ""), (3, "scum " * 50_000), (4, "Scum"), (4, "Scum")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit("x"))
    chain = toxicity.learn(planted, planted.select("doc_id", "rude", "toxic"), ["rude", "toxic"])
    got = {(r.doc_id, r.toxic >= 0.5) for r in toxicity.score(docs, chain).collect()}
    assert got == {(1, False), (2, False), (3, True), (4, True)}
    assert toxicity.score(docs, chain).count() == 5 and toxicity.score(docs.where("false"), chain).count() == 0
    none = planted.select("doc_id", "rude", "toxic").where("false")
    untaught = toxicity.learn(docs, none, ["rude", "toxic"])
    assert {r.toxic for r in toxicity.score(docs, untaught).collect()} == {0.0}
    one = planted.select("doc_id", "rude", F.lit(1).alias("toxic")).limit(20)
    always = toxicity.learn(planted, one, ["rude", "toxic"])
    assert {r.toxic > 0.5 for r in toxicity.score(docs, always).collect()} == {True}


def test_op7_on_the_whole_table(spark, sf_dir):
    found = queries.op7_toxicity(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = found.join(labels.withColumnRenamed("toxic", "known"), "doc_id").collect()
    right = sum(r.is_toxic == (r.known == 1) for r in rows)
    assert right >= 0.9 * len(rows) > 0


def newton(x, y, ridge):
    """Weights of the same penalised likelihood, by Newton's method on a dense matrix."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
        w = w - step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


def plain_chain(texts, labels, folds):
    """doc -> probabilities of every category: sets, loops and dense matrices. ``labels`` has a tuple per
    labelled document, ``folds`` its fold."""
    sets = {d: toxicity.features((t or "").encode()) for d, t in texts.items()}
    train = sorted(d for d in labels if d in texts)
    often = [f for f in set().union(*[sets[d] for d in train]) if sum(f in sets[d] for d in train) >= toxicity.MIN_DOCS]
    often.sort()
    earlier, found = {d: [] for d in train}, {d: [] for d in texts}
    for k in range(len(labels[train[0]])):
        def model(rows, k=k):
            y = np.array([labels[d][k] for d in rows], float)
            has = np.array([[f in sets[d] for f in often] for d in rows], float)
            tells = toxicity.chi_squared((has * y[:, None]).sum(0), has.sum(0), y) >= toxicity.TELLING
            dense = np.array([[*earlier[d], 1.0] for d in rows])
            x = np.hstack([has[:, tells], dense])
            ridge = np.full(x.shape[1], toxicity.RIDGE)
            ridge[-1] = 1e-3
            w = newton(x, y, ridge)
            names = [f for f, t in zip(often, tells, strict=True) if t]
            own = dict(zip(names, w, strict=False))
            return lambda words, before: 1 / (1 + np.exp(-(sum(own.get(f, 0) for f in words) + w[len(names):] @ [*before, 1.0])))

        whole = model(train)
        others = {f: model([d for d in train if folds[d] != f]) for f in range(toxicity.FOLDS)}
        for d in texts:
            found[d].append(float(whole(sets[d], found[d])))
        earlier = {d: [*earlier[d], float(others[folds[d]](sets[d], earlier[d]))] for d in train}
    return found


def test_op7_equals_a_plain_chain(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").dropna()
    known = known.select("doc_id", "quality", "toxic", F.pmod(F.xxhash64("doc_id"), F.lit(toxicity.FOLDS)).alias("fold"))
    rows = known.collect()
    want = plain_chain(texts, {r.doc_id: (1 - r.quality, r.toxic) for r in rows}, {r.doc_id: r.fold for r in rows})
    found = queries.op7_toxicity(spark, sf_dir).collect()
    assert len(found) == len(texts)
    gaps = [max(abs(r.low_quality - want[r.doc_id][0]), abs(r.toxic - want[r.doc_id][1])) for r in found]
    assert max(gaps) < 0.05 and np.mean(gaps) < 0.005
    assert all(r.is_toxic == (want[r.doc_id][1] >= 0.5) for r in found if abs(want[r.doc_id][1] - 0.5) > 0.05)


def test_rows_that_were_not_learned_from_are_judged_right(spark, sf_dir):
    """Half of the labelled documents teach, the other half are judged."""
    folder = sf_dir.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    known = spark.read.parquet(f"{folder}/labels.parquet").dropna()
    judged = toxicity.judged(docs, known.where("doc_id % 2 = 0")).join(known.where("doc_id % 2 = 1").withColumnRenamed("toxic", "is_toxic"), "doc_id")
    rows = judged.select("is_toxic", "toxic").collect()
    right = [(r.toxic >= 0.5) == bool(r.is_toxic) for r in rows]
    toxic = [r.toxic >= 0.5 for r in rows if r.is_toxic]
    assert len(rows) > 1000 and np.mean(right) > 0.97 and np.mean(toxic) > 0.85, (np.mean(right), np.mean(toxic))
