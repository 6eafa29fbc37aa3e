"""Hierarchical multi-length packing of documents into training sequences.

Each task takes its documents in pools of about ``pool_tokens``. In a pool, documents are cut into
full windows of the longest tier, their rests routed to the smallest tier they fit. Tiers are packed
from the longest down: the longest rest opens a window of its tier, whose gap is filled with the
best fitting rests of shorter tiers; when none fits whole, the shortest that is too long is cut and
its tail routed anew. So every closed sequence is full. What is left of a pool opens the next one;
the last sequence of a task is cut into windows of falling powers of two, so that only a rest under
``least`` tokens is padded. Sequences are dealt to step groups of equal numbers of tokens.

Nothing is shuffled, and a task holds one pool of ids. Results repeat when a task is run again on
the same rows in the same order; in any case each id is in one piece of one sequence.

Defined results: a null or empty text is the end id alone; repeated rows are packed each; a table
without rows gives none; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidied
from .tokens import word_encoder

WINDOW = 4096
TEXT_BYTES = 4 << 20  # of text that is encoded at a time, about
TIERS = (512, 1024, 2048, 4096)
PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long, window int, step_group long"
)
Piece = tuple[int, int, int]  # length, document, start


class Shelf:
    """Rests of documents in the order of their length."""

    def __init__(self, rests: list[Piece]):
        self.rests = sorted(rests)

    def longest(self) -> Piece:
        return self.rests.pop()

    def best(self, room: int) -> Piece | None:
        """The longest rest of at most ``room`` tokens; else the head of the next longer one."""
        at = bisect_right(self.rests, (room, float("inf"), 0))
        if at:
            return self.rests.pop(at - 1)
        if not self.rests:
            return None
        length, doc, start = self.rests.pop(bisect_left(self.rests, (room, 0, 0)))
        insort(self.rests, (length - room, doc, start + room))
        return room, doc, start


def pack_pool(
    rests: list[Piece], tiers: tuple[int, ...] = TIERS
) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full sequences (window, pieces) of a pool, and what filled no window."""
    window, full, short = tiers[-1], [], []
    for length, doc, start in rests:
        for at in range(0, length - window + 1, window):
            full.append((window, [(window, doc, start + at)]))
        if length % window:
            short.append((length % window, doc, start + length - length % window))
    shelf = Shelf(short)
    while shelf.rests:
        pieces = [shelf.longest()]
        tier = next(t for t in tiers if t >= pieces[0][0])
        room = tier - pieces[0][0]
        while room and (piece := shelf.best(room)):
            pieces.append(piece)
            room -= piece[0]
        if room:
            return full, pieces
        full.append((tier, pieces))
    return full, []


def cut_tail(
    pieces: list[Piece], window: int = WINDOW, least: int = 64
) -> list[tuple[int, list[Piece]]]:
    """The last rest in windows of falling powers of two, each full but the last."""
    out, pieces, left = [], list(pieces), sum(p[0] for p in pieces)
    while left:
        size = 1 << (left.bit_length() - 1)
        room = target = size if size >= least else left
        taken = []
        while room:
            length, doc, start = pieces.pop(0)
            if length > room:
                pieces.insert(0, (length - room, doc, start + room))
                length = room
            taken.append((length, doc, start))
            room -= length
        out.append((target if size >= least else window, taken))
        left -= target
    return out


def step_groups(windows: list[int], group_tokens: int) -> list[int]:
    """A group for each sequence: longest first, always to the group with the fewest tokens."""
    import heapq

    groups = [(0, g) for g in range(max(1, round(sum(windows) / group_tokens)))]
    out = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: (-windows[i], i)):
        held, group = heapq.heappop(groups)
        out[i] = group
        heapq.heappush(groups, (held + windows[i], group))
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    tiers: tuple[int, ...] = TIERS,
    least: int = 64,
    pool_tokens: int = 1 << 20,
    group_tokens: int = 1 << 17,
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their ids, sequence, place, window and step group."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        sequences = groups = 0
        encoder, end = word_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        held: dict[int, tuple[int | None, bytes]] = {}
        rests: list[Piece] = []
        serial = tokens = 0

        def emit(packed: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
            nonlocal sequences, groups
            rows = []
            dealt = step_groups([w for w, _ in packed], group_tokens)
            for (window, pieces), group in zip(packed, dealt, strict=True):
                offset = 0
                for length, doc, start in pieces:
                    key, ids = held[doc]
                    rows.append(
                        (
                            key, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4,
                            base + sequences, offset, window, base + groups + group,
                        )
                    )
                    offset += length
                sequences += 1
            groups += max(dealt) + 1
            kinds = (
                pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(),
                pa.int32(), pa.int64(),
            )
            names = [field.split()[0] for field in PIECES.split(", ")]
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        for batch in batches:
            keys = batch.column(0).to_pylist()
            part = max(1, min(4096, len(keys) * TEXT_BYTES // (batch.nbytes + 1)))
            for at in range(0, len(keys), part):
                texts = batch.column(1).slice(at, part).to_pylist()
                for key, ids in zip(keys[at : at + part], encoder.ids(texts), strict=True):
                    held[serial] = (key, ids + end)
                    rests.append((len(ids) // 4 + 1, serial, 0))
                    tokens += len(ids) // 4 + 1
                    serial += 1
                if tokens >= pool_tokens:
                    packed, rests = pack_pool(rests, tiers)
                    if packed:
                        yield emit(packed)
                    tokens = sum(r[0] for r in rests)
                    held = {doc: held[doc] for _, doc, _ in rests}
        packed, rests = pack_pool(rests, tiers)
        packed += cut_tail(rests, tiers[-1], least)
        if packed:
            yield emit(packed)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(tasks), PIECES)
