"""Token ids of whole texts by a public tokenizer file, with each distinct run of text encoded once."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# str.split() also cuts at these, which the tokenizer does not take for white space.
ODD = re.compile("[\x1c-\x1f]")
ROOM = 48 << 20  # bytes that a store of known texts may take
LONGEST = 48  # characters (or bytes) of a text that is kept
ENTRY = 200  # bytes that a key, its value and its place take besides their characters, about
ONCE = 1 << 23  # marks for texts that came once

# How the tokenizer file normalises and cuts runs of text.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Texts of these characters are normalised by lower case alone, and cut the same way by `plain_parts`.
PLAIN = re.compile("[\t-\r !-~À-ÖØ-öø-ÿ]*")
LATIN = [chr(i) for i in range(256)]
LOWER = bytes(ord(c.lower()) for c in LATIN)
SPACE, LETTER, DIGIT = 1, 2, 3  # kinds of characters; 0 are all others
KINDS = np.array(
    [SPACE if c in "\t\n\v\f\r " else LETTER if c.isalpha() else DIGIT if c in "0123456789" else 0 for c in LATIN],
    np.uint8,
)
PER_CALL = 1024  # words that the library is given in one text


def plain_parts(texts: list[str]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The parts (Latin-1, lower case) into which `CUTS` cuts plain texts, one text after the other, and
    the places among them where the texts begin, with their end."""
    text = " ".join([*texts, "  "]).encode("latin-1").translate(LOWER)
    data = np.frombuffer(text, np.uint8)
    kinds = KINDS[data]
    fresh = kinds == DIGIT
    fresh[0] = True
    fresh[1:] |= kinds[1:] != kinds[:-1]
    quote = np.flatnonzero(fresh & (data == ord("'")))
    one, two = data[quote + 1], data[quote + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    fresh[quote[short | long] + 1] = False
    fresh[quote[short] + 2] = True
    fresh[quote[long] + 3] = True
    inked = kinds != SPACE
    starts = np.flatnonzero(fresh & inked)
    sizes = np.add.reduceat(inked, starts, dtype=np.int64) if len(starts) else starts
    places = np.append(0, np.cumsum(sizes))
    parts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[inked])]
    )
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return parts, np.searchsorted(starts, begins)


class Known(dict):
    """Texts and what was made of them, within a budget of bytes. A text is kept when it comes for the
    second time, so those that never return take no room; what is long, or comes when the budget is
    spent, is made again each time."""

    def __init__(self, make: Callable[[list], Iterable], room: int = ROOM, entry: int = ENTRY):
        super().__init__()
        self.make, self.room, self.entry = make, room, entry
        self.once = bytearray(ONCE // 8)

    def of(self, wanted: set) -> dict:
        """A dictionary that holds all ``wanted``."""
        new = list(wanted.difference(self))
        if not new:
            return self
        made = dict(zip(new, self.make(new), strict=True))
        look = made | {w: self[w] for w in wanted if w not in made}
        self._keep(new, made.values())
        return look

    def each(self, wanted: list, make: Callable[[list], Iterable]) -> list:
        """What ``make`` makes of each of ``wanted``, which are distinct, or made of it before."""
        values = list(map(self.get, wanted))
        places = [i for i, value in enumerate(values) if value is None]
        if places:
            new = [wanted[i] for i in places]
            made = list(make(new))
            for i, value in zip(places, made, strict=True):
                values[i] = value
            self._keep(new, made)
        return values

    def _keep(self, new: list, made: Iterable) -> None:
        if self.room <= 0:
            return
        once = self.once
        for text, value in zip(new, made, strict=True):
            mark = hash(text) % ONCE
            if not once[mark >> 3] >> (mark & 7) & 1:
                once[mark >> 3] |= 1 << (mark & 7)
            elif self.room > 0 and len(text) <= LONGEST:
                self[text] = value
                self.room -= self.entry + 5 * len(text)


class WordEncoder:
    """Ids of texts, for tokenizers whose pre-tokenizer never joins text across white space.

    Such a tokenizer gives a run between white space the same ids wherever it stands, so runs are
    encoded once per lot and frequent ones kept. Where the file says how runs are cut, plain texts are
    cut here into the same parts (words without capitals and punctuation), of which there are fewer,
    by passes over whole arrays. The library gets new parts many in a text that is cut at spaces alone;
    as the model ends each with an id that stands nowhere else, its answer is cut after those.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit, Sequence

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Known(self._encode)
        told = json.loads(self.tokenizer.to_str())
        steps = [n["type"] for n in (told["normalizer"] or {}).get("normalizers", [])]
        cuts = [p.get("pattern", {}).get("Regex") for p in (told["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.added = [t["content"] for t in told["added_tokens"]]
        model, vocab = told["model"], self.tokenizer.get_vocab()
        last = model.get("end_of_word_suffix")
        self.cut_alike = (
            steps == NORMALIZERS
            and cuts == [CUTS, None]
            and bool(last)
            and not model.get("dropout")
            and all(c in vocab and c + last in vocab for c in ByteLevel.alphabet())
        )
        if self.cut_alike:
            self.words = Tokenizer(self.tokenizer.model)
            bytewise = ByteLevel(add_prefix_space=False, use_regex=False)
            self.words.pre_tokenizer = Sequence([CharDelimiterSplit(" "), bytewise])
            self.lasts = np.zeros(max(vocab.values()) + 1, bool)
            self.lasts[[i for token, i in vocab.items() if token.endswith(last)]] = True

    def _plain(self, text: str) -> bool:
        return bool(PLAIN.fullmatch(text)) and not any(t in text for t in self.added)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null counts as empty."""
        texts = [t or "" for t in texts]
        plain = [self.cut_alike and self._plain(t) for t in texts]
        found = iter(self._plain_ids([t for t, p in zip(texts, plain, strict=True) if p]))
        parts = [None if p else [t] if ODD.search(t) else t.split() for t, p in zip(texts, plain, strict=True)]
        wanted = set(chain.from_iterable(filter(None, parts)))
        look = self.known.of(wanted) if wanted else {}
        return [next(found) if doc is None else b"".join([look[p] for p in doc]) for doc in parts]

    def _plain_ids(self, texts: list[str]) -> Iterator[bytes]:
        """As `ids`, of plain texts."""
        if not texts:
            return
        parts, begins = plain_parts(texts)
        parts = parts.dictionary_encode()
        made = self.known.each(parts.dictionary.to_pylist(), self._encode_parts)
        found = pa.array(made, pa.large_binary()).take(parts.indices)
        places = np.append(0, np.cumsum(pc.binary_length(found).to_numpy()))[begins].tolist()
        data = memoryview(found.buffers()[2] or b"")
        for begin, end in zip(places, places[1:], strict=False):
            yield data[begin:end].tobytes()

    def _encode(self, parts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(parts), 8192):
            for e in self.tokenizer.encode_batch_fast(parts[at : at + 8192], add_special_tokens=False):
                yield np.array(e.ids, "<u4").tobytes()

    def _encode_parts(self, parts: list[bytes]) -> Iterator[bytes]:
        for at in range(0, len(parts), PER_CALL):
            text = b" ".join(parts[at : at + PER_CALL]).decode("latin-1")
            (found,) = self.words.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            ends = (4 * np.flatnonzero(self.lasts[ids]) + 4).tolist()
            data = ids.tobytes()
            for begin, end in zip([0, *ends], ends, strict=False):
                yield data[begin:end]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a Python worker, kept over its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)
