"""SentencePiece encoding that keeps every piece's place in the original bytes.

Normalisation is done here, as the model's file states it: at each place the longest prefix that the
compiled character map knows is replaced, white space is trimmed and escaped and the dummy prefix
added as the model asks, and each normalised byte records the source bytes it came from. The
normalised text is then cut into units before each run of escaped spaces (no piece of such a model
holds a space after another character, which is checked when the model is loaded), each unit is
encoded by the model's own merges, frequent units once per worker. The pieces' byte lengths project
them onto the original text.

Defined results: null text = empty; an empty text has the end id only, with an empty span at its
end; very long texts are encoded whole; repeated rows are encoded each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_array
from .tokens import Known

ESCAPED = "▁"
MARK = ESCAPED.encode()
UNITS = re.compile(b"(?:\xe2\x96\x81)*(?:(?!\xe2\x96\x81)[\\s\\S])+|(?:\xe2\x96\x81)+")
ENTRY = 320  # bytes that a unit kept with its pieces takes, about
ENCODED = "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string"


class CharMap:
    """A compiled character map: a double-array trie over UTF-8 prefixes, and the replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]
        self.firsts = frozenset(b for b in range(256) if self.units and self._child(0, b) >= 0)

    def _base(self, unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _child(self, at: int, byte: int) -> int:
        to = at ^ self._base(self.units[at]) ^ byte
        unit = self.units[to] if to < len(self.units) else -1
        return to if unit >= 0 and unit & 0x800000FF == byte else -1

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of ``data`` from ``at`` on."""
        node, found = 0, None
        for i in range(at, len(data)):
            node = self._child(node, data[i])
            if node < 0:
                break
            unit = self.units[node]
            if unit >> 8 & 1:  # the prefix ends here; its value is the place of its replacement
                value = self.units[node ^ self._base(unit)] & 0x7FFFFFFF
                found = i + 1 - at, self.texts[value : self.texts.index(b"\0", value)]
        return found


class Normalizer:
    """Normalised bytes and, for each, where its source character begins and ends."""

    def __init__(self, spec):
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix = spec.add_dummy_prefix
        self.trim = spec.remove_extra_whitespaces
        self.escape = spec.escape_whitespaces

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        if self.trim or self.map.firsts.intersection(data):
            chunks = list(self._chunks(data))
            text = b"".join(new for new, _, _ in chunks)
            sizes = [len(new) for new, _, _ in chunks]
            begins = np.repeat(np.array([b for _, b, _ in chunks], np.int32), sizes)
            ends = np.repeat(np.array([e for _, _, e in chunks], np.int32), sizes)
        else:
            text, (begins, ends) = data, self._same(data)
        if not text:
            return b"", begins[:0], ends[:0]
        if self.escape and b" " in text:
            widths = np.where(np.frombuffer(text, np.uint8) == 32, len(MARK), 1)
            begins, ends = np.repeat(begins, widths), np.repeat(ends, widths)
            text = text.replace(b" ", MARK)
        if self.trim and text.endswith(MARK):  # an escaped space in the source is trimmed as well
            while text.endswith(MARK):
                text = text[: -len(MARK)]
            begins, ends = begins[: len(text)], ends[: len(text)]
        if self.prefix:
            mark = MARK if self.escape else b" "
            none = np.zeros(len(mark), np.int32)
            text = mark + text
            begins, ends = np.concatenate([none, begins]), np.concatenate([none, ends])
        return text, begins, ends

    def _same(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        if data.isascii():
            places = np.arange(len(data) + 1, dtype=np.int32)
            return places[:-1], places[1:]
        leads = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).astype(np.int32)
        sizes = np.diff(np.append(leads, np.int32(len(data)))).astype(np.int32)
        return np.repeat(leads, sizes), np.repeat(leads + sizes, sizes)

    def _chunks(self, data: bytes) -> Iterator[tuple[bytes, int, int]]:
        """(new bytes, source begin, source end) per prefix; white space trimmed if asked."""
        at, out = 0, []
        while at < len(data):
            found = self.map.longest(data, at) if data[at] in self.map.firsts else None
            if found:
                size, new = found
            else:
                size = 1 + sum(data[at] >= lead for lead in (0xC0, 0xE0, 0xF0))
                new = data[at : at + size]
            out.append((new, at, at + size))
            at += size
        if not self.trim:
            yield from out
            return
        gap, begun = None, False  # a gap between words is written as one space, where it begins
        for new, begin, end in out:
            bare = new.lstrip(b" ")
            if len(bare) < len(new) and begun and gap is None:
                gap = (b" ", begin, end)
            if not bare:
                continue
            if gap and begun:
                yield gap
            gap, begun = None, True
            core = re.sub(b" +", b" ", bare.rstrip(b" "))
            yield core, begin, end
            if bare.endswith(b" "):
                gap = (b" ", begin, end)


class PieceEncoder:
    """Ids and spans of texts by one model."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        inner = [p.piece for p in model.pieces if re.search(f"[^{ESCAPED}]{ESCAPED}", p.piece)]
        if inner or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"pieces go across spaces: {inner[:3]}")
        self.normalizer = Normalizer(model.normalizer_spec)
        self.decoder = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = model.normalizer_spec  # the merges alone, for text that is normalised already
        spec.precompiled_charsmap = b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.sizes = np.array(
            [
                1 if p.type == proto.ModelProto.SentencePiece.BYTE else len(p.piece.encode())
                for p in model.pieces
            ],
            np.int32,
        )
        self.unknown = self.merges.unk_id()
        self.known = Known(self._new, entry=ENTRY)

    def _units(self, text: bytes) -> list[bytes]:
        first, *words = text.split(MARK)
        if first or not all(words):  # runs of spaces, or none before the first word
            return UNITS.findall(text)
        return [MARK + word for word in words]

    def _new(self, units: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Ids and byte lengths of the pieces of each unit."""
        for at in range(0, len(units), 65536):
            some = units[at : at + 65536]
            found = self.merges.encode([u.decode() for u in some], num_threads=1)
            counts = np.fromiter(map(len, found), np.int64, len(found))
            first = np.cumsum(counts) - counts
            ids = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
            sizes, unknown = self.sizes[ids], ids == self.unknown
            if unknown.any():
                several = np.add.reduceat(unknown.astype(np.int64), first)
                if several.max() > 1:
                    raise ValueError("two unknown pieces in one unit; their lengths are not known")
                lacking = np.fromiter(map(len, some), np.int64, len(some)) - np.add.reduceat(sizes, first)
                sizes[unknown] += lacking[several > 0].astype(np.int32)
            ids, sizes = ids.tobytes(), sizes.tobytes()
            for begin, end in zip((4 * first).tolist(), (4 * (first + counts)).tolist(), strict=True):
                yield ids[begin:end], sizes[begin:end]

    def encode(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, begins, ends) per text; places count the text's own bytes."""
        normal = [self.normalizer(t) for t in texts]
        units = [self._units(text) for text, _, _ in normal]
        known = self.known.of(set(chain.from_iterable(units)))
        for (text, begins, ends), doc in zip(normal, units, strict=True):
            found = [known[u] for u in doc]
            ids = np.frombuffer(b"".join([f[0] for f in found]), np.int32)
            to = np.cumsum(np.frombuffer(b"".join([f[1] for f in found]), np.int32))
            if len(to) and to[-1] != len(text):
                raise ValueError("the pieces do not cover the normalised text")
            since = np.concatenate([[0], to[:-1]]).astype(np.int64)[: len(to)]
            yield ids, begins[since], ends[to - 1]


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """The encoder of a Python worker, kept over its tasks."""
    return PieceEncoder(path)


def encode(docs: DataFrame, model: str, end_id: int = 2) -> DataFrame:
    """``docs`` (doc_id, text) encoded: ids with the end id, byte spans in the text, and the text
    that the model decodes from the ids."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model)
        names = [field.split()[0] for field in ENCODED.split(", ")]
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, len(texts), 512):
                part = [t or b"" for t in texts.slice(at, 512).to_pylist()]
                ids, begins, ends, counts = [], [], [], []
                for text, (i, b, e) in zip(part, encoder.encode(part), strict=True):
                    last = np.array([len(text)], np.int32)
                    ids += [i, np.array([end_id], np.int32)]
                    begins += [b, last]
                    ends += [e, last]
                    counts.append(len(i) + 1)
                flat = np.concatenate(ids)
                bounds = np.cumsum([0, *counts])
                own = [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 512),
                        list_array(pa.array(flat), counts),
                        list_array(pa.array(np.concatenate(begins)), counts),
                        list_array(pa.array(np.concatenate(ends)), counts),
                        pa.array(encoder.decoder.decode(own), pa.string()),
                    ],
                    names=names,
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tasks, ENCODED)
