"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams (one to three letters, with a blank for the edge
of a word) of a language's training texts, or of one document. A document's distance to a language
is the sum, over its own n-grams, of how far out of place each stands in the language's list; one
that the list lacks counts as its whole length. The nearest language is the prediction (ties: the
first by name), its score one minus the distance over the largest possible one.

Letters are folded to lower case and numbered by a fixed rule into 63 classes, so an n-gram is a
small number. Training counts are summed per task and language before the shuffle; profiles
(languages times ``PLACES`` rows) are the only thing that reaches the driver.

Defined results: text null or without a letter: ``und``, score 0; no training rows: ``und`` for all;
repeated rows count each; extra columns are ignored. Whole texts are used, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import tidied

PLACES = 300
CLASSES = 64
ORDERS = 3
BASES = np.cumsum([0] + [CLASSES**n for n in range(1, ORDERS + 1)])
UNKNOWN = "und"
HELD = 4_000_000  # counts of n-grams that a task holds
STEPS = 1_000  # of the scale on which likenesses are counted


def _class(code: int) -> int:
    """0 for what is no letter, 1 to 26 for a to z, 27 to 63 for other letters."""
    char = chr(code)
    if not char.isalpha():
        return 0
    folded = ord(char.lower()[0])
    return folded - 96 if 97 <= folded <= 122 else 27 + folded % 37


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    return np.array([_class(c) for c in range(0x10000)], np.uint8)


def letters(text: str) -> np.ndarray:
    """Letter classes of a text, each stretch of other characters as one 0, with a 0 at both ends;
    empty if there is no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    high = codes >= 0x10000
    found = np.zeros(len(codes) + 2, np.uint8)
    if high.any():
        found[1:-1][~high] = _classes()[codes[~high]]
        found[1:-1][high] = [_class(int(c)) for c in codes[high]]
    else:
        found[1:-1] = _classes()[codes]
    kept = np.ones(len(found), bool)
    kept[1:] = (found[1:] != 0) | (found[:-1] != 0)
    found = found[kept]
    return found.astype(np.int32) if len(found) > 1 else found[:0].astype(np.int32)


def ngrams(found: np.ndarray) -> np.ndarray:
    """The number of every n-gram of a text's letter classes, but for the single blank."""
    codes, parts = found, [found[found > 0]]
    for n in range(2, ORDERS + 1):
        codes = codes[:-1] * CLASSES + found[n - 1 :]
        parts.append(codes + BASES[n - 1])
    return np.concatenate(parts)


def ranked(grams: np.ndarray, places: int = PLACES) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by number."""
    grams = np.sort(grams)
    firsts = np.flatnonzero(np.diff(grams, prepend=-1))
    counts = np.diff(np.append(firsts, len(grams)))
    kinds = grams[firsts].astype(np.int64)
    keys = -counts * (1 << 20) + kinds
    if len(keys) > places:
        keys = np.partition(keys, places - 1)[:places]
    return (np.sort(keys) & ((1 << 20) - 1)).astype(np.int32)


def counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n: how often each n-gram occurs in the texts of each language."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def settled() -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            return keys[first], np.add.reduceat(n, first)

        def send() -> pa.RecordBatch:
            keys, n = settled()
            langs = pa.array(list(number), pa.string()).take(pa.array(keys // BASES[-1]))
            held.clear()
            number.clear()
            grams = pa.array((keys % BASES[-1]).astype(np.int32))
            return pa.RecordBatch.from_arrays([langs, grams, pa.array(n)], names=["lang", "gram", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                grams: dict[str, list[np.ndarray]] = {}
                langs = batch.column(0).slice(at, 512).to_pylist()
                texts = batch.column(1).slice(at, 512).to_pylist()
                for lang, text in zip(langs, texts, strict=True):
                    if len(found := letters(text or "")):
                        grams.setdefault(lang, []).append(ngrams(found))
                for lang, parts in grams.items():
                    own = np.concatenate(parts)
                    if len(own) > BASES[-1] // 8:
                        n = np.bincount(own, minlength=BASES[-1])
                        some = np.flatnonzero(n)
                        n = n[some]
                    else:
                        some, n = np.unique(own, return_counts=True)
                    held.append((number.setdefault(lang, len(number)) * BASES[-1] + some.astype(np.int64), n))
                if sum(len(keys) for keys, _ in held) > HELD:
                    held[:] = [settled()]
                    if len(held[0][0]) > HELD // 2:
                        yield send()
        if held:
            yield send()

    each = docs.select("lang", "text").mapInArrow(tidied(tasks), "lang string, gram int, n long")
    return each.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, places: int = PLACES) -> dict[str, list[int]]:
    """The profile of each non-null ``lang``: its most frequent n-grams in order."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        counts(docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= places)
    )
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "place").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Places:
    """Where n-grams stand in the profiles: of each n-gram, the languages that have it and its place
    there. As large as the profiles together."""

    def __init__(self, profiles: dict[str, list[int]], places: int):
        self.langs, self.places = sorted(profiles), places
        every = [
            (gram, i, place) for i, lang in enumerate(self.langs) for place, gram in enumerate(profiles[lang])
        ]
        gram, self.lang, self.place = np.array(sorted(every), np.int64).reshape(-1, 3).T.copy()
        self.gram, first = np.unique(gram, return_index=True)
        self.bound = np.append(first, len(gram))

    def far(self, text: str | None) -> np.ndarray:
        """A text's distance to each language as a share of the largest; empty if it has no letter."""
        found = letters(text or "")
        if not len(found):
            return np.zeros(0)
        own = ranked(ngrams(found), self.places)
        largest = self.places * len(own)
        if not len(self.gram):
            return np.ones(len(self.langs))
        at = np.minimum(np.searchsorted(self.gram, own), len(self.gram) - 1)
        place = np.flatnonzero(self.gram[at] == own)
        first, end = self.bound[at[place]], self.bound[at[place] + 1]
        # all entries of the n-grams that some profile has
        size = end - first
        entry = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        nearer = self.places - np.abs(self.place[entry] - np.repeat(place, size))
        return (largest - np.bincount(self.lang[entry], nearer, len(self.langs))) / largest


def usual_likeness(
    docs: DataFrame, profiles: dict[str, list[int]], share: float, places: int = PLACES
) -> tuple[float, int]:
    """The likeness to their own ``lang`` that all but ``share`` of the texts reach, rounded down to
    ``STEPS``, and the number of texts that were judged: all with a letter and a language."""
    number = {lang: i for i, lang in enumerate(sorted(profiles))}
    held = docs.sparkSession.sparkContext.broadcast(Places(profiles, places))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(STEPS + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                langs, texts = (batch.column(c).slice(at, 512).to_pylist() for c in (0, 1))
                for lang, text in zip(langs, texts, strict=True):
                    if lang in number and len(far := held.value.far(text)):
                        sums[int((1.0 - far[number[lang]]) * STEPS)] += 1
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(sums[some])], names=["step", "n"]
        )

    each = docs.select("lang", "text").mapInArrow(tidied(tasks), "step int, n long")
    found = sorted((r["step"], r["n"]) for r in each.groupBy("step").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in found)
    under = 0
    for step, n in found:
        under += n
        if under > share * total:
            return step / STEPS, total
    return 0.0, 0


def predict(
    docs: DataFrame,
    profiles: dict[str, list[int]],
    places: int = PLACES,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs`` with the language and its score, judged by ``text`` alone. Other columns are kept,
    columns of these two names replaced."""
    langs = sorted(profiles)
    held = docs.sparkSession.sparkContext.broadcast(Places(profiles, places))

    def judge(text: str | None) -> tuple[str, float]:
        far = held.value.far(text)
        if not len(far):
            return UNKNOWN, 0.0
        best = int(far.argmin())
        return langs[best], 1.0 - float(far[best])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = []
            for at in range(0, batch.num_rows, 512):
                judged += map(judge, batch.column("text").slice(at, 512).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array([j[0] for j in judged], pa.string()),
                    pa.array([j[1] for j in judged], pa.float64()),
                ],
                names=[*kept, *names],
            )

    docs = docs.drop(*names)
    kept = docs.columns
    judged = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *judged])
    return docs.mapInArrow(tidied(tasks), schema)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
