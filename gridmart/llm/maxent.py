"""A hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). Every frequent word belongs to one of a
fixed number of classes (the most frequent have a class of their own, others share one by how they
end); rare and unknown words share classes of their own, by their ending. The class is predicted by
a maximum-entropy model over hashed features of the history: the word before, the pair before, and
the word before that (a skip). Within a class, words follow their counts, which is what maximum
entropy gives for features of the word alone.

Counts cover every training text: they are summed per task, then by word. Frequent words (at most
``FREQUENT``) go to all tasks; a text's rare words meet their counts in a shuffle join.

The weights of a feature are learned from all training texts but one in ``TUNING``: what classes follow
it, counted in every task and summed in Spark, gives the maximum-entropy weights of the feature by
itself. How far to trust them in company, a scale for each kind of feature and how often it occurs, is
learned from the rest by ``EPOCHS`` gradient updates: every task sums the slopes of its texts' loss, and
the sums of all tasks move the scales. So nothing depends on how rows are dealt to tasks, and features
that few tasks see lose nothing. From there all weights are fitted together by ``fits`` updates of
generalised iterative scaling over the same texts: tasks sum how often the model expects each class behind
each feature, and every weight moves by the logarithm of observed to expected, a third of it, as every
token has three features; the likelihood of the texts, with the prior, never falls by it. The table grows with the training tokens up to ``ROWS`` rows, the size
that tasks can hold; features beyond it share rows. Texts are scored in batches of ``TOKENS`` tokens,
sparse rows of weights gathered by feature.

Defined results: null text = empty: its end alone; no training text: the uniform distribution over
nothing but the unknown, as the counts' formula has it; a null id is training text; repeated rows
count and are scored each; extra columns are ignored. Whole texts, whatever their length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import added, raw_texts, stored, tidied

FREQUENT = 200_000
OWN, SHARED, RARE = 23, 16, 8  # classes of one word, of frequent words, of rare words
END = OWN  # the class of the end of a text
CLASSES = OWN + 1 + SHARED + RARE
ROWS = 1 << 18  # of the weight table, at most
LEAST_ROWS = 1 << 10
TOKENS_A_ROW = 16
SHARES = (1, 1, 2)  # of the rows, in quarters, by kind of feature: word before, skip, pair
PRIOR = 8.0  # occurrences that a feature's classes are drawn to the common shares with
BANDS = 20  # of how often a feature occurs, by powers of two
TUNING = 16  # one training text in so many teaches the scales, the others the weights
SCALE, TIE, EPOCHS = 0.4, 20.0, 3  # where scales start, how strongly they are held there, updates
FITS = 1  # updates of all weights together, in the registered query
TOKENS = 2_048
LEAST_SUM = 1e-25  # of a token's products of factors in single precision; smaller ones are worked in double
TOKENS_A_TABLE = 1 << 23  # in a task of such an update
HISTORIES = 1 << 21  # tokens whose equal histories are worked once
PARTS, LANES = 64, 16  # in which tables are added up: ranges of rows, and tasks in a first step
HELD = 400_000  # distinct words that a counting task holds before it sends them on
CELLS = "task int, part int, cells binary, counts binary"
SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
    "rare array<struct<word:binary,n:int>>"
)


def words_of(data: bytes) -> list[bytes]:
    """Runs without ASCII white space, ASCII letters in lower case."""
    return data.lower().split()


def ending(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-2:]) % classes


def ending_of(word: Column, classes: int) -> Column:
    """The same for a binary column."""
    tail = F.expr("substring(word, greatest(length(word) - 1, 1), 2)")
    return (F.crc32(tail) % classes).cast("int")


def counted(docs: DataFrame) -> DataFrame:
    """word, c: occurrences of every word in all texts."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def send() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())],
                names=["word", "c"],
            )
            held.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in raw_texts(batch.column(0).slice(at, 256)):
                    held.update(words_of(text))
                if len(held) > HELD:
                    yield send()
        if held:
            yield send()

    each = docs.select("text").mapInArrow(tidied(tasks), "word binary, c long")
    return each.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Words:
    """Counts of the training texts, as far as every task needs them."""

    number: dict[bytes, int]  # of the frequent words, most frequent first
    count: np.ndarray
    classes: np.ndarray
    rare_total: np.ndarray  # occurrences and kinds of rare words, and one for the unknown, by class
    texts: int
    tokens: int
    kinds: int

    @classmethod
    def of(cls, vocabulary: DataFrame, texts: int) -> Words:
        band = F.floor(F.log2("c") * 8).cast("int").alias("band")
        bands = {r["band"]: r["n"] for r in vocabulary.groupBy(band).agg(F.count("*").alias("n")).collect()}
        least, room = max(bands, default=0) + 1, FREQUENT
        while least > 1 and bands.get(least - 1, 0) <= room:
            least -= 1
            room -= bands.get(least, 0)
        often = F.floor(F.log2("c") * 8) >= least
        frequent = vocabulary.where(often).select("word", "c").toArrow()
        frequent = frequent.sort_by([("c", "descending"), ("word", "ascending")])
        named, count = frequent["word"].to_pylist(), frequent["c"].to_numpy().astype(np.float64)
        rare = (
            vocabulary.where(~often)
            .groupBy(ending_of(F.col("word"), RARE).alias("class"))
            .agg(F.sum("c").alias("c"), F.count("*").alias("n"))
            .collect()
        )
        total = np.ones(RARE)
        for r in rare:
            total[r["class"]] += r["c"] + r["n"]
        classes = [
            i if i < OWN else OWN + 1 + ending(w, SHARED) for i, w in enumerate(named)
        ]
        return cls(
            {w: i for i, w in enumerate(named)},
            count,
            np.array(classes, np.int64),
            total,
            texts,
            int(count.sum()) + sum(r["c"] for r in rare) + texts,
            len(named) + sum(r["n"] for r in rare) + (texts > 0),
        )

    def start(self) -> np.ndarray:
        """Log shares of the classes in the training texts."""
        sums = np.bincount(self.classes, self.count, CLASSES)
        sums[END] = self.texts
        sums[END + 1 + SHARED :] = self.rare_total
        return np.log(np.maximum(sums, 0.5) / np.maximum(sums, 0.5).sum()).astype(np.float32)

    def inside(self) -> np.ndarray:
        """log10 P(word | class) of the frequent words."""
        sums = np.bincount(self.classes, self.count, CLASSES)
        return np.log10(self.count / sums[self.classes])

    def rows(self) -> int:
        """Rows of the weight table: a power of two."""
        wanted = 1 << max(0, int(self.tokens / TOKENS_A_ROW).bit_length())
        return min(ROWS, max(LEAST_ROWS, wanted))


class History:
    """Texts as numbers: words, classes, and the feature rows of every token's history."""

    def __init__(self, words: Words, texts: list[list[bytes]]):
        known, size = words.number.get, len(words.number)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        flat = list(chain.from_iterable(texts))
        found = np.fromiter(map(known, flat, repeat(-1)), np.int64, len(flat))
        rare = np.flatnonzero(found < 0)
        unknown = [flat[i] for i in rare]
        found[rare] = [size + ending(w, RARE) for w in unknown]
        cuts = np.searchsorted(rare, np.cumsum(sizes)).tolist()
        self.rare = [unknown[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        self.ids = np.full(len(flat) + len(texts), size + RARE, np.int64)
        inner = np.ones(len(self.ids), bool)
        inner[ends] = False
        self.ids[inner] = found
        first, second = np.roll(self.ids, 1), np.roll(self.ids, 2)
        first[ends - sizes] = second[ends - sizes] = -1
        second[(ends - sizes + 1)[sizes > 0]] = -1
        self.text = np.repeat(np.arange(len(texts)), sizes + 1)
        self.often = self.ids < size
        self.is_rare = inner & ~self.often
        self.classes = self.ids + (END + 1 + SHARED - size)
        self.classes[self.often] = words.classes[self.ids[self.often]]
        self.classes[ends] = END
        features, starts = (first, second, first * (1 << 21) + second), kind_starts(words.rows())
        self.rows = np.stack([_hashed(f, starts[k], starts[k + 1]) for k, f in enumerate(features)])


def kind_starts(rows: int) -> np.ndarray:
    """Where in the table the rows of each kind of feature begin, and its end."""
    return np.cumsum([0, *SHARES]) * (rows // sum(SHARES))


def _hashed(history: np.ndarray, first: int, end: int) -> np.ndarray:
    """Rows from ``first`` to before ``end``."""
    h = (history.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return (h & np.uint64(end - first - 1)).astype(np.int32) + np.int32(first)  # a power of two of them


def log_shares(start: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """log P(class | history) for each token (column of ``rows``) and class."""
    z = start + weights[rows[0]]
    for feature in rows[1:]:
        z += weights[feature]
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def factored(weights: np.ndarray) -> np.ndarray:
    """The weights as factors of the classes' shares, those of a row by its largest."""
    factors = np.empty_like(weights)
    for at in range(0, len(weights), 4096):
        part = weights[at : at + 4096]
        np.exp(part - part.max(axis=1, keepdims=True), out=factors[at : at + 4096])
    return factors


def parted(common: np.ndarray, factors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token (column of ``rows``) the classes' products of factors, and their sum with ``common``. Last:
    the tokens of too small a sum, whose features tell opposite things; their products are divided by it."""
    parts = np.take(factors, rows[0], axis=0)
    for feature in rows[1:]:
        parts *= np.take(factors, feature, axis=0)
    total = np.einsum("tc,c->t", parts, common)
    low = np.flatnonzero(total < LEAST_SUM)
    if len(low):
        exact = factors[rows[:, low]].astype(np.float64).prod(axis=0)
        total = total.astype(np.float64)
        total[low] = exact @ common
        parts[low] = exact / total[low, None]
    return parts, total, low


def _chunks(texts: Iterator[bytes], words: Words) -> Iterator[History]:
    """Histories of some texts at a time, a few batches of tokens."""
    held, tokens = [], 0
    for text in texts:
        held.append(words_of(text))
        tokens += len(held[-1]) + 1
        if tokens >= 4 * TOKENS:
            yield History(words, held)
            held, tokens = [], 0
    if held:
        yield History(words, held)


def _texts(batch: pa.RecordBatch, column: int = 0) -> Iterator[bytes]:
    for at in range(0, batch.num_rows, 256):
        yield from raw_texts(batch.column(column).slice(at, 256))


def followed(docs: DataFrame, words: Words) -> Iterator[tuple[int, np.ndarray]]:
    """How often each class follows each feature in all texts: ranges of rows, each with its first row.

    Tasks send the cells they have met; those are added in two levels, by ranges of rows. What the
    driver gets is the table, of bounded size, a range at a time.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(words)
    rows = words.rows()

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cells, one = vocabulary.value, np.zeros(rows * CLASSES, np.uint32), np.uint32(1)
        for batch in batches:
            for history in _chunks(_texts(batch), words):
                at = history.rows.astype(np.int64)
                at *= CLASSES
                at += history.classes
                np.add.at(cells, at.ravel(), one)
        yield from _sent(cells)

    yield from _table(docs.select("text").mapInArrow(tidied(tasks), CELLS), rows, "<u4", between="<u4")
    vocabulary.destroy()


def _sent(cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The cells of a task's flat table that hold anything, by ranges of rows."""
    from pyspark import TaskContext

    task, each = TaskContext.get().partitionId(), len(cells) // PARTS
    for part in range(PARTS):
        own = cells[part * each : (part + 1) * each]
        met = np.flatnonzero(own)
        if len(met):
            at = met.astype("<u4").tobytes() if 2 * len(met) < each else b""  # most hold something: all are sent
            blobs = [[at], [(own[met] if at else own).tobytes()]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int32()), pa.array([part], pa.int32()), *map(pa.array, blobs)],
                names=["task", "part", "cells", "counts"],
            )


def _table(
    sent: DataFrame, rows: int, dtype: str, lanes: int = LANES, between: str = "<f4"
) -> Iterator[tuple[int, np.ndarray]]:
    """The sums of what tasks have sent, single precision: ranges of rows, each with its first row."""
    each = rows * CLASSES // PARTS

    def first(key: tuple, sent: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(each, np.float64)
        sent = sent.sort_values("task")
        for cells, counts in zip(sent["cells"], sent["counts"], strict=True):
            at = np.frombuffer(cells, "<u4") if len(cells) else slice(None)
            total[at] += np.frombuffer(counts, dtype)
        return pd.DataFrame({"part": [key[0]], "lane": [key[1]], "total": [total.astype(between).tobytes()]})

    def last(key: tuple, sent: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(t, between).astype("<f8") for t in sent.sort_values("lane")["total"]).astype("<f4")
        return pd.DataFrame({"part": [key[0]], "total": [total.tobytes()]})

    lane = F.pmod("task", F.lit(lanes)).alias("lane")
    some = sent.groupBy("part", lane).applyInPandas(first, "part int, lane int, total binary")
    for row in some.groupBy("part").applyInPandas(last, "part int, total binary").toLocalIterator():
        yield row["part"] * (rows // PARTS), np.frombuffer(row["total"], "<f4").reshape(-1, CLASSES)


def expected(docs: DataFrame, words: Words, weights: np.ndarray) -> np.ndarray:
    """How often the model expects each class behind each feature in all texts: (rows, classes)."""
    table = np.zeros_like(weights)
    for at, part in _expected(docs, words, factored(weights)):
        table[at : at + len(part)] = part
    return table


def _expected(docs: DataFrame, words: Words, factors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The same by ranges of rows, each with its first row."""
    held = docs.sparkSession.sparkContext.broadcast((words, factors))
    rows = len(factors)
    # a task sends a table of a bounded size, however little it reads
    fewer = 1 + words.tokens // TOKENS_A_TABLE
    lanes = min(LANES, 1 + fewer // 64)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, factors = held.value
        common, cells, waiting, n = np.exp(words.start()), np.zeros((rows, CLASSES), np.float32), [], 0
        for batch in batches:
            for history in _chunks(_texts(batch), words):
                first, second, pair = history.rows.astype(np.int64)
                waiting.append((first << 40) + (second << 20) + pair)  # a table has 2^18 rows at most
                n += len(pair)
                if n >= HISTORIES:
                    _expect(cells, common, factors, waiting)
                    n = 0
        if waiting:
            _expect(cells, common, factors, waiting)
        cells *= common
        yield from _sent(cells.ravel())

    sent = docs.select("text").coalesce(fewer).mapInArrow(tidied(tasks), CELLS)
    yield from _table(sent, rows, "<f4", lanes)
    held.destroy()


def _expect(cells: np.ndarray, common: np.ndarray, factors: np.ndarray, waiting: list[np.ndarray]) -> None:
    """Add the classes' shares, less ``common``, to the rows of some tokens' features, equal histories at once."""
    codes = np.concatenate(waiting)
    waiting.clear()
    codes.sort()
    new = np.flatnonzero(np.diff(codes, prepend=-1))
    times = np.diff(new, append=len(codes)).astype(np.float32)
    codes, last = codes[new], (1 << 20) - 1
    # two neighbours are added at once, as a complex number
    flat, half = cells.reshape(-1).view(np.complex64), CLASSES // 2
    each, cell = np.arange(half), np.empty((TOKENS, half), np.int64)
    for at in range(0, len(codes), TOKENS):
        some = codes[at : at + TOKENS]
        rows = np.stack([some >> 40, some >> 20 & last, some & last])
        parts, total, low = parted(common, factors, rows)
        total[low] = 1
        parts *= (times[at : at + TOKENS] / total).astype(np.float32)[:, None]
        for kind in rows:
            np.add(kind[:, None] * half, each, out=cell[: len(kind)])
            np.add.at(flat, cell[: len(kind)].ravel(), parts.reshape(-1).view(np.complex64))


def fitted(
    observed: dict[int, bytes], met: Iterator[tuple[int, np.ndarray]], weights: np.ndarray, start: np.ndarray
) -> None:
    """Move the weights by one update of iterative scaling, by ranges of rows as they arrive."""
    common, still = PRIOR * np.exp(start), dict(observed)

    def update(at: int, seen: np.ndarray | float, size: int) -> None:
        own = _unpacked(still.pop(at, None), size)
        weights[at : at + size] += np.log((own + common) / (seen + common)) / len(SHARES)

    size = len(weights) // PARTS
    for at, part in met:
        update(at, part, size)
    for at in list(still):
        update(at, 0.0, size)


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.tobytes(), 1)


def _unpacked(data: bytes | None, size: int) -> np.ndarray:
    if data is None:
        return np.zeros((size, CLASSES), np.float32)
    return np.frombuffer(zlib.decompress(data), np.float32).reshape(size, CLASSES)


def evidence(counts: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weights that each feature would have by itself, and its band."""
    total, common = counts.sum(axis=1), np.exp(start)
    share = (counts + PRIOR * common) / (total[:, None] + PRIOR)
    return np.log(share) - start, np.minimum(np.log2(total + 1), BANDS - 1).astype(np.int8)


def slopes(
    start: np.ndarray, weights: np.ndarray, bands: np.ndarray, scales: np.ndarray, rows: np.ndarray, classes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of some tokens' loss by the scales (kinds * bands)."""
    own, band = np.take(weights, rows, axis=0), bands[rows].astype(np.int64) + BANDS * np.arange(len(rows))[:, None]
    z = np.tile(start, (rows.shape[1], 1))
    for scale, w in zip(scales[band].astype(np.float32), own, strict=True):
        z += scale[:, None] * w
    z -= z.max(axis=1, keepdims=True)
    shares = np.exp(z, out=z)
    shares /= np.einsum("tc->t", shares)[:, None]
    mean = np.stack([np.einsum("tc,tc->t", shares, w) for w in own])
    met = own[:, np.arange(len(classes)), classes]
    first = np.bincount(band.ravel(), (mean - met).ravel(), len(scales))
    second = np.zeros(len(scales) ** 2)
    for i in range(len(rows)):
        weighed = shares * own[i]
        for j in range(i, len(rows)):
            spread = np.einsum("tc,tc->t", weighed, own[j]) - mean[i] * mean[j]
            second += np.bincount(band[i] * len(scales) + band[j], spread, len(second))
            if i != j:
                second += np.bincount(band[j] * len(scales) + band[i], spread, len(second))
    return first, second


def tuned(docs: DataFrame, words: Words, weights: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """Scales (kinds, bands) after ``EPOCHS`` updates, each by the slopes of all texts, which tasks sum up."""
    held = docs.sparkSession.sparkContext.broadcast((words, weights, bands))
    size = len(SHARES) * BANDS
    scales = np.full(size, SCALE)

    def epoch(scales: np.ndarray):
        def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            words, weights, bands = held.value
            start, sums = words.start(), np.zeros(size + size * size)
            for batch in batches:
                for h in _chunks(_texts(batch), words):
                    for at in range(0, len(h.ids), TOKENS):
                        part = slice(at, at + TOKENS)
                        found = slopes(start, weights, bands, scales, h.rows[:, part], h.classes[part])
                        sums += np.concatenate(found)
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int32()), pa.array([0], pa.int32()), pa.array([sums.tobytes()])],
                names=["task", "part", "data"],
            )

        return docs.select("text").mapInArrow(tidied(tasks), "task int, part int, data binary")

    for _ in range(EPOCHS):
        sums = added(epoch(scales), "<f8")
        if not sums:
            break
        # held to where they started by a little, for bands that hardly occur
        first = sums[0][:size] + TIE * (scales - SCALE)
        second = sums[0][size:].reshape(size, size) + TIE * np.eye(size)
        scales = scales - np.linalg.solve(second, first)
    held.destroy()
    return scales.reshape(len(SHARES), BANDS)


def train(docs: DataFrame, words: Words, fits: int = 0) -> np.ndarray:
    """Class weights (rows, classes) of all features; ``fits`` updates of all weights together, none by default."""
    tuning = F.crc32(F.coalesce("text", F.lit(""))) % TUNING == 0
    rows, start, observed = words.rows(), words.start(), {}
    weights, bands = np.zeros((rows, CLASSES), np.float32), np.zeros(rows, np.int8)
    for at, counts in followed(docs.where(~tuning), words):
        part = slice(at, at + len(counts))
        weights[part], bands[part] = evidence(counts, start)
        observed[at] = _packed(counts)
    scales = tuned(docs.where(tuning), words, weights, bands)
    kinds = np.repeat(np.arange(len(SHARES)), np.diff(kind_starts(len(weights))))
    weights *= scales[kinds, bands][:, None].astype(np.float32)
    for _ in range(fits):
        fitted(observed, _expected(docs.where(~tuning), words, factored(weights)), weights, start)
    return weights


def scored(docs: DataFrame, words: Words, factors: np.ndarray) -> DataFrame:
    """Per row of ``docs`` (doc_id, held_out, text) what the frequent words add to the scores (log10,
    without the base's common divisor), and the rare words that still need their counts. Stored."""
    held = docs.sparkSession.sparkContext.broadcast((words, factors))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, factors = held.value
        common, inside, often = np.exp(words.start()), words.inside(), np.log10(words.count + 1)
        outside, row = np.log10(words.rare_total), TaskContext.get().partitionId() << 33
        for batch in batches:
            done = 0
            for h in _chunks(_texts(batch, 2), words):
                shares = np.empty(len(h.ids))
                for at in range(0, len(h.ids), TOKENS):
                    part = slice(at, at + TOKENS)
                    kinds, own = h.rows[:, part], h.classes[part]
                    _, total, _ = parted(common, factors, kinds)
                    share = factors[kinds, own].astype(np.float64).prod(axis=0)
                    shares[part] = np.log10(share * common[own] / total)
                ids, rare = h.ids[h.often], h.is_rare
                base = np.zeros(len(h.ids))
                base[h.often] = often[ids]
                base[~h.often & ~rare] = np.log10(words.texts + 1)
                shares[h.often] += inside[ids]
                shares[rare] -= outside[h.classes[rare] - END - 1 - SHARED]
                n = len(h.rare)
                size = np.bincount(h.text, minlength=n)
                known = np.bincount(h.text[h.often], minlength=n) + (words.texts > 0)
                lists = [Counter(r) for r in h.rare]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n), pa.int64()),
                        batch.column(0).slice(done, n),
                        batch.column(1).slice(done, n),
                        pa.array(size, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(np.bincount(h.text, base, n)),
                        pa.array(np.bincount(h.text, shares, n)),
                        pa.array(
                            [[{"word": w, "n": k} for w, k in r.items()] for r in lists],
                            pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())])),
                        ),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare"],
                )
                done, row = done + n, row + n

    columns = docs.select(F.col("doc_id").cast("long"), "held_out", "text")
    rows = stored(columns.mapInArrow(tidied(tasks), SCORED), "scored")
    held.destroy()
    return rows


def scores(docs: DataFrame, held_out: Column, fits: int = 0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    training = docs.where(~F.col("held_out"))
    vocabulary = stored(counted(training), "vocabulary")
    words = Words.of(vocabulary, training.count())
    rows = scored(docs, words, factored(train(training, words, fits)))
    rare = rows.select("row", F.inline("rare"))
    # a rare word's count belongs to its texts; unknown words have none and add log10(0 + 1) = 0
    rare = rare.join(vocabulary, "word").groupBy("row").agg(
        F.sum("n").alias("seen"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("logs")
    )
    logs = F.coalesce("logs", F.lit(0.0))
    divisor = float(np.log10(words.tokens + words.kinds + 1))
    return rows.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * divisor).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )
