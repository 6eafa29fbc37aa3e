"""Phrase collocations: frequent n-grams by mergeable summaries, then exact counts.

Pass one. Every n-gram (one to `LONGEST` words) of a language is an item of 32 bits in one of the hash
partitions. Tasks send their items with counts, a blob per partition; a partition's blobs are merged
into one Misra-Gries summary: counters are added, and whenever more than its capacity are
left, the largest counter beyond it is subtracted from all. The capacity exceeds the partition's mass
(all its occurrences) over the least frequency, so less than that is ever subtracted, and every
frequent n-gram survives; memory is bounded by the capacity, not by the distinct n-grams.

Pass two. Survivors mark bits of a map of bounded size, which tasks test n-grams against, those first
whose shorter parts passed. What passes is counted exactly by its text. A map too small for its
survivors lets more through; it never loses any and nothing but the work depends on it.

Words: texts in lower case (A-Z only), cut at ``.,;:!?`` and line ends into pieces, and these at spaces
and tabs. Phrases do not cross pieces.

Defined results: null text = empty; null language = ``und``; texts without words add nothing; repeated
rows count each; ties are broken by a then phrase (UTF-8 byte order); an empty table has no phrases;
extra columns are ignored. Counts pass through 64-bit integers, products through decimals of 38 digits.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, tidied

LEAST = 30  # fixed value: occurrences from which an n-gram is frequent
LONGEST = 4  # fixed value: words of the longest phrase
HELD = 80  # fixed value: percent of a phrase's places that a longer one must hold to replace it
TOP = 2000  # fixed value: phrases reported for a language
NO_LANG = "und"  # fixed value
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
ENDS = b".,;:!?\n\x0b\x0c\r"  # fixed values: what cuts a text into pieces
END = b"."  # stands for all of them; no word holds it
TABLE = bytes.maketrans(UPPER + ENDS, LOWER + END * len(ENDS))
STRETCH = 1 << 21  # bytes of text at a time
MASS = 1 << 22  # occurrences that a hash partition is meant for
PARTITIONS = 1 << 14  # at most
BITS = 1 << 29  # of the survivors' map, at most
BITS_EACH = 16
NONE = -1  # the word number of a piece's end


def stretches(langs: list[str | None], texts: list[bytes | None], size: int = STRETCH) -> Iterator[list[tuple]]:
    """(language, bytes) in lots of about ``size`` bytes; long texts are cut, but only at ends of pieces."""
    lot, held = [], 0
    for lang, text in zip(langs, texts, strict=True):
        text = (text or b"").translate(TABLE)
        at = 0
        while at < len(text):
            stop = text.find(END, at + size - held) if len(text) - at > size - held else -1
            stop = len(text) if stop < 0 else stop + 1
            lot.append((NO_LANG if lang is None else lang, text[at:stop]))
            held += stop - at
            at = stop
            if held >= size:
                yield lot
                lot, held = [], 0
    if lot:
        yield lot


class Lot:
    """The words of some texts as numbers, pieces parted by `NONE`."""

    def __init__(self, lot: list[tuple[str, bytes]]):
        tokens, lengths = [], []
        for _, text in lot:
            found = text.replace(END, b" . ").split()
            found.append(END)
            tokens += found
            lengths.append(len(found))
        coded = pa.array(tokens, pa.binary()).dictionary_encode()
        self.words: list[bytes] = coded.dictionary.to_pylist()
        ids = coded.indices.to_numpy().astype(np.int64)
        ids[ids == self.words.index(END)] = NONE
        self.ids = ids
        names = sorted({lang for lang, _ in lot})
        self.langs = names
        number = {lang: i for i, lang in enumerate(names)}
        self.lang = np.repeat(np.array([number[lang] for lang, _ in lot], np.int64), lengths)

    def words_by_lang(self) -> dict[str, int]:
        counts = np.bincount(self.lang[self.ids != NONE], minlength=len(self.langs))
        return {lang: int(n) for lang, n in zip(self.langs, counts, strict=True) if n}

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each language and word, by position; of no meaning at the ends of pieces."""
        import xxhash

        word = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], np.uint64)
        lang = np.array([xxhash.xxh3_64_intdigest(x.encode(), 1) for x in self.langs], np.uint64)
        return mixed(word[self.ids] ^ lang[self.lang])


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finaliser of a public hash, SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def longer(grams: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of n-grams with one more word behind."""
    return mixed(grams * np.uint64(0x9E3779B97F4A7C15) + words)


def placed(hashes: np.ndarray, partitions: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash partition and the 32-bit item of each hash."""
    part = ((hashes >> np.uint64(32)) % np.uint64(partitions)).astype(np.int64)
    return part, hashes.astype(np.uint32)


def summed(items: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct items in order, with the sums of their counts."""
    order = np.argsort(items, kind="stable")
    items, counts = items[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]])) if len(items) else order
    return items[first], np.add.reduceat(counts, first) if len(items) else counts


class Summary:
    """A Misra-Gries summary of counted items. An item's true count is at least its counter, and at most
    its counter and ``taken`` together."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.items, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, items: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((items, counts))
        self.held += len(items)
        if self.held > self.capacity + 65536:
            self.settle()

    def settle(self) -> None:
        pairs = [(self.items, self.counts), *self.waiting]
        self.waiting, self.held = [], 0
        self.items, self.counts = summed(*[np.concatenate(x) for x in zip(*pairs, strict=True)])
        over = len(self.items) - self.capacity
        if over > 0:
            beyond = np.partition(self.counts, over - 1)[over - 1]
            self.taken += int(beyond)
            self.counts = self.counts - beyond
            left = self.counts > 0
            self.items, self.counts = self.items[left], self.counts[left]

    def survivors(self, least: int) -> np.ndarray:
        self.settle()
        return self.items[self.counts + self.taken >= least]


def summaries(docs: DataFrame, partitions: int) -> DataFrame:
    """Pass one's tasks: per hash partition the items and counts of a stretch of text; and, as
    partition -1, the number of words of each language."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "lang", "mass", "items", "counts"]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
        for lot in _lots(batches):
            words = lot.hashes()
            gram, whole, found = words, lot.ids != NONE, []
            for n in range(1, LONGEST + 1):
                if n > 1:
                    gram = longer(gram[:-1], words[n - 1 :])
                    whole = whole[:-1] & (lot.ids[n - 1 :] != NONE)
                found.append(gram[whole])
            every = np.concatenate(found)
            if not len(every):
                continue
            del words, gram, whole, found
            every.sort()
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            counts = np.diff(np.append(first, len(every))).astype("<u4")
            part, items = placed(every[first], partitions)
            del every, first
            order = np.argsort(part, kind="stable")
            part, items, counts = part[order], items[order].astype("<u4"), counts[order]
            del order
            parts, starts = np.unique(part, return_index=True)
            ends = np.append(starts[1:], len(part))
            rows = [
                (int(p), None, int(counts[a:b].sum(dtype=np.int64)), items[a:b].tobytes(), counts[a:b].tobytes())
                for p, a, b in zip(parts, starts, ends, strict=True)
            ]
            rows += [(-1, lang, n, b"", b"") for lang, n in lot.words_by_lang().items()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "part int, lang string, mass long, items binary, counts binary"
    return docs.select("lang", "text").mapInArrow(tidied(tasks), schema)


def _lots(batches: Iterable[pa.RecordBatch]) -> Iterator[Lot]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for at in range(0, batch.num_rows, 256):  # texts become Python objects few at a time
            langs = batch.column("lang").slice(at, 256).to_pylist()
            for lot in stretches(langs, texts.slice(at, 256).to_pylist()):
                yield Lot(lot)


def survivors(sent: DataFrame, partitions: int, least: int) -> DataFrame:
    """Pass one's merge: the items of each hash partition that may be frequent, as one blob. The driver
    holds a number for each partition."""
    blobs = sent.where("part >= 0")
    masses = {r["part"]: r["all"] for r in blobs.groupBy("part").agg(F.sum("mass").alias("all")).collect()}
    # No join may stand before this shuffle: Spark would leave the shuffle out for the join's own, whose parts
    # need not stay whole when the plan changes, and a partition merged in parts loses what each has too little of.
    dealt = blobs.select("part", "items", "counts").repartitionById(partitions, "part")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, Summary] = {}
        for batch in batches:
            parts = batch.column("part").to_pylist()
            for p, items, counts in zip(parts, batch.column("items"), batch.column("counts"), strict=True):
                if p not in own:
                    own[p] = Summary(masses[p] // least + 1)
                own[p].add(
                    np.frombuffer(items.as_buffer(), "<u4"),
                    np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64),
                )
        for part, summary in own.items():
            found = summary.survivors(least)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([len(found)], pa.int64()),
                 pa.array([found.astype("<u4").tobytes()], pa.binary())],
                names=["part", "n", "items"],
            )

    return dealt.mapInArrow(tidied(merge), "part int, n long, items binary")


class Marks:
    """A map of bits for items of hash partitions, two for each item."""

    def __init__(self, partitions: int, bits: int, data: bytes | None = None):
        self.partitions, self.each = partitions, max(64, bits // partitions // 8 * 8)
        size = self.partitions * self.each // 8
        self.bytes = np.zeros(size, np.uint8) if data is None else np.frombuffer(data, np.uint8)

    def _places(self, part: np.ndarray, items: np.ndarray) -> Iterator[np.ndarray]:
        wide = mixed(items.astype(np.uint64) + np.uint64(1))
        for half in (wide >> np.uint64(32), wide & np.uint64(0xFFFFFFFF)):
            yield part * self.each + (half % np.uint64(self.each)).astype(np.int64)

    def put(self, part: np.ndarray, items: np.ndarray) -> None:
        for at in self._places(part, items):
            np.bitwise_or.at(self.bytes, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        part, items = placed(hashes, self.partitions)
        found = np.ones(len(hashes), bool)
        for at in self._places(part, items):
            found &= (self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found


def marked(found: DataFrame, partitions: int, most_bits: int = BITS) -> Marks:
    """The survivors' map. Each partition sets the bits of its own stretch; what reaches the driver is
    the map, of at most ``most_bits``."""
    n = found.agg(F.sum("n")).first()[0] or 0
    bits = min(most_bits, max(1 << 16, 1 << math.ceil(math.log2(BITS_EACH * n + 1))))
    marks = Marks(partitions, bits)

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, items in zip(batch.column("part").to_pylist(), batch.column("items"), strict=True):
                own = Marks(1, marks.each)
                items = np.frombuffer(items.as_buffer(), "<u4")
                own.put(np.zeros(len(items), np.int64), items)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([own.bytes.tobytes()], pa.binary())], ["part", "bits"]
                )

    size = marks.each // 8
    for row in found.select("part", "items").mapInArrow(stretch, "part int, bits binary").toLocalIterator():
        marks.bytes[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return marks


def counted(docs: DataFrame, marks: Marks) -> DataFrame:
    """Pass two: n-grams that pass the map, with exact counts per stretch of text."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(marks.bytes.tobytes())
    partitions, bits = marks.partitions, marks.partitions * marks.each

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Marks(partitions, bits, sent.value)
        for lot in _lots(batches):
            counts = _passing(lot, own)
            if counts:
                langs, phrases, ns = zip(*counts, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
                     pa.array(ns, pa.int64())],
                    names=["lang", "phrase", "n"],
                )

    return docs.select("lang", "text").mapInArrow(tidied(tasks), "lang string, phrase string, n long")


def _passing(lot: Lot, marks: Marks) -> list[tuple[str, bytes, int]]:
    words, ids = lot.hashes(), lot.ids
    at = np.flatnonzero(ids != NONE)
    passed = np.zeros(len(ids) + LONGEST, bool)
    at = at[marks.has(words[at])]
    passed[at] = True
    # number each language's n-grams one order after the other: exact, whatever their hashes are
    number, kinds = ids[at] * len(lot.langs) + lot.lang[at], len(lot.words) * len(lot.langs)
    gram = words[at]
    out = []
    for n in range(1, LONGEST + 1):
        if n > 1:
            grown = passed[at + n - 1]  # the last word alone is frequent
            at, number, gram = at[grown], number[grown], longer(gram[grown], words[at[grown] + n - 1])
            hit = marks.has(gram)
            at, gram = at[hit], gram[hit]
            number = number[hit] * len(lot.words) + ids[at + n - 1]
        _, first, number, counts = np.unique(number, return_index=True, return_inverse=True, return_counts=True)
        for place, count in zip(at[first].tolist(), counts.tolist(), strict=True):
            phrase = b" ".join([lot.words[i] for i in ids[place : place + n]])
            out.append((lot.langs[lot.lang[place]], phrase, count))
    return out


def frequent(docs: DataFrame, least: int = LEAST, mass: int = MASS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of one to four words with at least ``least`` occurrences, and
    (lang, n): all words."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = size * LONGEST // 6 + 1  # six bytes to a word, at a guess; it only sizes the partitions
    partitions = int(min(PARTITIONS, max(1, expected // mass)))
    sent = stored(summaries(docs, partitions), "phrases-summaries")
    marks = marked(stored(survivors(sent, partitions, least), "phrases-survivors"), partitions)
    totals = sent.where("part < 0").groupBy("lang").agg(F.sum("mass").alias("n"))
    counts = counted(docs, marks).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return stored(counts.where(F.col("n") >= least), "phrases-frequent"), totals


def scored(found: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, size, a) with the counts and score of their lowest-scoring cut."""
    words = F.split("phrase", " ")
    phrases = found.select("lang", "phrase", F.size(words).alias("size"), F.col("n").alias("a")).where("size > 1")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    part = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    cuts = cuts.withColumns(
        {"left": part(F.lit(1), F.col("k")), "right": part(F.col("k") + 1, F.col("size") - F.col("k"))}
    )
    for side, name in (("left", "l"), ("right", "r")):
        counts = found.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
        cuts = cuts.join(counts, ["lang", side])
    exact = "cast((2000000 * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + r) as long)"
    lowest = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(lowest).select("lang", "phrase", "size", "a", "cut.*")


def maximal(candidates: DataFrame, held: int = HELD) -> DataFrame:
    """Candidates that no longer one holds in ``held`` percent or more of their places."""
    words = F.split("phrase", " ")

    def inside(size: int) -> list:
        return [
            F.array_join(F.slice(words, start, length), " ")
            for length in range(2, size)
            for start in range(1, size - length + 2)
        ]

    parts = F.when(F.col("size") == 3, F.array(*inside(3))).when(F.col("size") == 4, F.array(*inside(4)))
    holders = candidates.where("size > 2").select("lang", F.explode(F.array_distinct(parts)).alias("phrase"), "a")
    holders = holders.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(20, 0)")
    hidden = F.coalesce(100 * wide("longer") >= held * wide("a"), F.lit(False))
    return candidates.join(holders, ["lang", "phrase"], "left").where(~hidden).drop("longer")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's best phrases, ranked from 1, with the counts they are scored by."""
    found, totals = frequent(docs, least)
    candidates = stored(scored(found), "phrases-candidates")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = maximal(candidates).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
