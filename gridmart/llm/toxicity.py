"""Toxicity by a chain of linear classifiers.

Categories are learned one after the other; each model sees a text's word features and the
probabilities of all earlier categories. While training, those probabilities come from models that
did not see the row (out-of-fold), so later models learn how reliable they are. A text's features
are its distinct words and the distinct first four bytes of its words, ASCII letters in lower
case: presence in the whole text, not frequency, so that one insult in a long text counts.

The models are fitted on a bounded sample of the labelled rows (``PER_CLASS`` of either value of the
last category, by a hash of the id); a feature needs ``MIN_DOCS`` of them. Where a value has more rows
than that, all labelled rows are counted, and the sampled ones weigh in every model as much as the
rows they stand for, so that probabilities do not depend on the table's size. Everything else,
scoring above all, covers every row. Each fold's model is fitted by a task of its own; what reaches the
driver are features and weights, bounded by the sample.

Defined results: null or empty text = no features (the models' intercepts decide); no labelled rows:
probability 0 for all; a category with one value only: about that value for all rows; rows with a
null label are not sampled, of labels that repeat an id the largest count; repeated rows are scored
each; other columns of the docs are kept, those named like the results replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import raw_texts, stored, tidied

PER_CLASS = 6_000
MIN_DOCS = 5
FOLDS = 3
PREFIX = 4
RIDGE = 0.1
TELLING = 10.83  # one in a thousand by chance
LETTERS = bytes(
    b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256)
)


def features(data: bytes) -> set[bytes]:
    """Distinct words, and as ``word*`` their distinct first letters."""
    words = set(data.translate(LETTERS).split())
    return words | {w[:PREFIX] + b"*" for w in words}


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def chi_squared(yes: np.ndarray, all_: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How far each feature's share of positive rows is from chance, with Yates's correction."""
    n, positive = len(y), y.sum()
    no, without = all_ - yes, n - all_
    gap = np.abs(yes * (n - positive - no) - (positive - yes) * no) - n / 2
    margins = all_ * without * positive * (n - positive)
    return np.where(margins > 0, n * np.maximum(gap, 0) ** 2 / np.maximum(margins, 1), 0)


def fit(
    rows: np.ndarray,
    at: np.ndarray,
    dense: np.ndarray,
    y: np.ndarray,
    width: int,
    steps: int = 300,
    weight: np.ndarray | None = None,
) -> np.ndarray:
    """Logistic regression of ``y`` on 0/1 features (row and feature number of each) and dense columns.
    A row counts ``weight`` times.

    Features that tell nothing by themselves (chi-squared under ``TELLING``) have weight 0. Accelerated gradient descent with a step per weight, bounded by how many features share a row
    with it, so that rare telling words move as fast as common ones. Returns the features' weights,
    then those of the dense columns, the intercept last.
    """
    n, dense = len(y), np.column_stack([dense, np.ones(len(y))])
    weight = np.ones(n) if weight is None else weight
    telling = chi_squared(np.bincount(at, y[rows], width), np.bincount(at, None, width), y) >= TELLING
    rows, at = rows[telling[at]], at[telling[at]]
    load = np.bincount(rows, minlength=n) + np.abs(dense).sum(axis=1)

    def down(g: np.ndarray, d: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(at, weights=g[rows], minlength=width), d.T @ g])

    ridge = np.full(width + dense.shape[1], RIDGE)
    ridge[-1] = 1e-3
    curve = 0.25 * down(weight * load, np.abs(dense)) + ridge
    w = v = np.zeros(len(curve))
    for step in range(steps):
        z = np.bincount(rows, weights=v[at], minlength=n) + dense @ v[width:]
        new = v - (down(weight * (sigmoid(z) - y), dense) + ridge * v) / curve
        v = new + step / (step + 3.0) * (new - w)
        w = new
    return w


class Chain:
    """Fitted models: features, and per category the weights (features, earlier categories,
    intercept)."""

    def __init__(self, categories: list[str], vocabulary: dict[bytes, int], weights: list[np.ndarray]):
        self.categories, self.vocabulary = categories, vocabulary
        width = len(vocabulary)
        self.features = np.array([w[:width] for w in weights]).reshape(len(weights), width)
        self.dense = [w[width:] for w in weights]

    def probabilities(self, data: bytes) -> list[float]:
        if not self.dense:
            return [0.0] * len(self.categories)
        vocabulary = self.vocabulary
        at = [vocabulary[f] for f in features(data) if f in vocabulary]
        own = self.features[:, at].sum(axis=1)
        out: list[float] = []
        for z, dense in zip(own, self.dense, strict=True):
            out.append(float(sigmoid(z + dense @ np.array([*out, 1.0]))))
        return out


def sampled(docs: DataFrame, labels: DataFrame, categories: list[str], per_class: int) -> DataFrame:
    """doc_id, the categories, fold, weight and features of a bounded sample of labelled documents.

    A row's weight is how many labelled rows of its value it stands for, in proportion to the value
    that is sampled most densely (weight 1).
    """
    one = labels.groupBy("doc_id").agg(*[F.max(c).cast("int").alias(c) for c in categories])
    one = one.dropna().withColumn("_order", F.xxhash64("doc_id"))
    last = F.col(categories[-1])
    total = {r[0]: r[1] for r in one.where(last.isin(0, 1)).groupBy(last).count().collect()}
    share = {value: n / min(n, per_class) for value, n in total.items()}
    parts = [
        one.where(last == value)
        .orderBy("_order", "doc_id")
        .limit(per_class)
        .withColumn("_weight", F.lit(share.get(value, 1.0) / min(share.values(), default=1.0)))
        for value in (1, 0)
    ]
    picked = parts[0].unionByName(parts[1])  # at most 2 * per_class rows

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(features(t)) for t in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(found, pa.list_(pa.binary()))],
                names=[*kept, "features"],
            )

    kept = ["doc_id", *categories, "fold", "_weight"]
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")
        .dropDuplicates(["doc_id"])
        .withColumn("fold", F.pmod("_order", F.lit(FOLDS)).cast("int"))
        .select(*kept, "text")
    )
    schema = T.StructType(
        [*rows.drop("text").schema.fields, T.StructField("features", T.ArrayType(T.BinaryType()))]
    )
    return rows.mapInArrow(split, schema)


def learn(
    docs: DataFrame, labels: DataFrame, categories: list[str], per_class: int = PER_CLASS
) -> Chain:
    """The chain for the 0/1 columns ``categories`` of ``labels`` (doc_id, categories), in order."""
    spark = docs.sparkSession
    sample = stored(sampled(docs, labels, categories, per_class), "toxicity-sample")
    common = (
        sample.select(F.explode("features").alias("f"))
        .groupBy("f")
        .count()
        .where(F.col("count") >= MIN_DOCS)
    )
    vocabulary = {f: i for i, f in enumerate(sorted(bytes(r["f"]) for r in common.collect()))}
    width = len(vocabulary)
    if not vocabulary and sample.isEmpty():
        return Chain(categories, {}, [])
    held = spark.sparkContext.broadcast(vocabulary)  # bounded by the sample

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            found = batch.column("features").to_pylist()
            at = [sorted(known[f] for f in row if f in known) for row in found]
            yield batch.drop_columns("features").append_column("at", pa.array(at, pa.list_(pa.int32())))

    schema = T.StructType(
        [*sample.drop("features").schema.fields, T.StructField("at", T.ArrayType(T.IntegerType()))]
    )
    rows = stored(sample.mapInArrow(number, schema), "toxicity-numbers")
    weights = []
    for k, category in enumerate(categories):
        earlier = [f"_p{i}" for i in range(k)]

        # model FOLDS sees all rows, model f all but fold f
        dealt = rows.withColumn("model", F.explode(F.lit(list(range(FOLDS + 1)))))
        dealt = dealt.where(F.col("model") != F.col("fold"))
        fitted = dealt.groupBy("model").applyInPandas(
            _fitter(category, earlier, width), "model int, weights binary"
        )
        models = {r["model"]: np.frombuffer(bytes(r["weights"])) for r in fitted.collect()}
        weights.append(models[FOLDS])
        if k + 1 < len(categories):
            rows = stored(_out_of_fold(rows, models, earlier, f"_p{k}", width), "toxicity-folds")
    return Chain(categories, vocabulary, weights)


def _fitter(category: str, earlier: list[str], width: int):
    def fit_group(key, group):
        group = group.sort_values("doc_id")
        at = np.concatenate([*group["at"], np.zeros(0, np.int32)]).astype(np.int64)
        which = np.repeat(np.arange(len(group)), [len(a) for a in group["at"]])
        dense = group[earlier].to_numpy(float).reshape(len(group), len(earlier))
        weight = group["_weight"].to_numpy(float)
        w = fit(which, at, dense, group[category].to_numpy(float), width, weight=weight)
        return pd.DataFrame({"model": [key[0]], "weights": [w.tobytes()]})

    return fit_group


def _out_of_fold(
    rows: DataFrame, models: dict[int, np.ndarray], earlier: list[str], name: str, width: int
) -> DataFrame:
    """Adds each row's probability by the model that did not see its fold."""
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.DoubleType())])

    def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for fold, at, dense in zip(
                part["fold"], part["at"], part[earlier].to_numpy(float), strict=True
            ):
                w = models.get(fold, models[FOLDS])
                found.append(sigmoid(w[at].sum() + w[width:] @ np.append(dense, 1.0)))
            yield part.assign(**{name: np.array(found, float)})

    return rows.mapInPandas(judge, schema)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with a probability column per category, judged by the whole ``text``."""
    names = chain.categories
    held = docs.sparkSession.sparkContext.broadcast(chain)  # bounded by the sample
    docs = docs.drop(*names)
    kept = docs.columns

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            found = []
            for at in range(0, batch.num_rows, 512):
                texts = raw_texts(batch.column("text").slice(at, 512))
                found += [model.probabilities(t) for t in texts]
            columns = [pa.array([f[i] for f in found], pa.float64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], *columns], names=[*kept, *names]
            )

    added = [T.StructField(n, T.DoubleType()) for n in names]
    return docs.mapInArrow(tidied(tasks), T.StructType([*docs.schema.fields, *added]))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    names: tuple[str, str] = ("low_quality", "toxic"),
) -> DataFrame:
    """``docs`` with the probabilities of low quality and toxicity, by the labels quality and toxic."""
    known = labels.select(
        "doc_id", (1 - F.col("quality")).alias(names[0]), F.col("toxic").alias(names[1])
    )
    return score(docs, learn(docs, known, list(names), per_class))
