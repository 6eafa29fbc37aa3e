"""Packing and piece encoding against the libraries, on whole small tables and odd texts."""

import itertools
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from gridmart.llm import packing, pieces, queries
from gridmart.llm.tokens import ENTRY, Known, WordEncoder, word_encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts(n=300):
    dice = random.Random(5)
    letters = "aé ▁\n'sStT1!½日́  😀\x1d\x85\x00"
    made = ["".join(dice.choices(letters, k=dice.randint(1, 50))) for _ in range(n)]
    return ["", " ", "  a  b ", "x▁ y▁▁", "é ́z", "ΑΣ ΑΣ", "İ ǅ", "</s><s>", "A" * 9000, *made]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", i) for i, t in enumerate([*odd_texts(), None, "same text", "same text"])]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int")


def test_words_are_encoded_as_whole_texts():
    texts = odd_texts()
    encoder = word_encoder(WORDS)
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)]
    assert got == [e.ids for e in want]


def test_known_texts_stay_within_their_budget():
    made = []

    def make(new):
        made.extend(new)
        return [t.upper() for t in new]

    known = Known(make, room=3 * (ENTRY + 10))
    lots = [{"aa", "bb", "cc"}, {"aa", "bb", "dd"}, {"aa", "ee", "x" * 99}, {"cc", "dd", "x" * 99}, {"cc", "dd", "ee"}]
    for wanted in lots:
        look = known.of(wanted)
        assert {w: look[w] for w in wanted} == {w: w.upper() for w in wanted}
    # kept when they came for the second time, until the budget was spent; long ones never
    assert {"aa", "bb"} < set(known) < {"aa", "bb", "cc", "dd"}
    assert made.count("aa") == 2 and made.count("x" * 99) == 2


def test_plain_and_other_texts_are_cut_alike():
    encoder = word_encoder(WORDS)
    assert encoder.cut_alike
    dice = random.Random(8)
    letters = "abzAZ'sStTdDmMlLvVeErR09.,;!?\"-_#éÀßÿ×÷¡ \n\t\r\x0b\x0c" + "ªµº\xa0\xad\x85²ſŉ"
    texts = ["".join(dice.choices(letters, k=dice.randint(1, 60))) for _ in range(4000)]
    texts += ["it's I'LL they've'd 12.5", "<|endoftext|> a<|startoftext|>b", "ÀÉß×ÿ", "''s't''"]
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)] == [e.ids for e in want]


def test_contractions_are_cut_alike():
    encoder = word_encoder(WORDS)
    texts = ["".join(made) for n in range(1, 5) for made in itertools.product("'stdmrevlLé1! ", repeat=n)]
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)] == [e.ids for e in want]


def test_new_and_known_words_of_all_lots():
    encoder, dice = WordEncoder(WORDS), random.Random(3)
    letters = "aeinorstÀé日'"
    words = ["".join(dice.choices(letters, weights=[9] * 8 + [1] * 4, k=dice.randint(1, 9))) for _ in range(9000)]
    for _ in range(3):
        texts = [" ".join(dice.choices(words, k=60)) for _ in range(200)] + ["", " ", "日本", "a" * 5000]
        want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids([*texts, None])] == [*(e.ids for e in want), []]
    assert encoder.ids([]) == [] and encoder.ids([None, "", "\n"]) == [b"", b"", b""]


def test_known_words_cost_less_than_cutting_texts_word_by_word():
    encoder, dice = word_encoder(WORDS), random.Random(4)
    words = ["".join(dice.choices("aeinorst", k=dice.randint(2, 7))) for _ in range(2000)]
    texts = [" ".join(dice.choices(words, k=3000)) for _ in range(300)]
    look = dict(zip(words, encoder.ids(words), strict=True))

    def word_by_word():
        return [b"".join([look[w] for w in re.findall("[a-z]+", t)]) for t in texts]

    def seconds(job):
        begin = time.process_time()
        job()
        return time.process_time() - begin

    assert encoder.ids(texts) == word_by_word()
    ours, plain = (min(seconds(job) for _ in range(3)) for job in (lambda: encoder.ids(texts), word_by_word))
    assert ours < plain


def assert_packed(found, docs, tiers=packing.TIERS, padded=1):
    """Every id in one piece, sequences gapless and full but for ``padded`` per task."""
    encoder = word_encoder(WORDS)
    ids = encoder.ids([d.text for d in docs])
    want = sorted((d.doc_id, np.frombuffer(i, "<u4").tolist() + [2]) for d, i in zip(docs, ids))
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    got = []
    for doc, parts in by_doc.items():
        parts.sort(key=lambda r: r.start)
        assert [r.start for r in parts] == list(np.cumsum([0, *[r.length for r in parts]])[:-1])
        whole = np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist()
        assert {r.doc_tokens for r in parts} == {len(whole)}
        got.append((doc, whole))
    assert sorted(got) == want
    sizes = []
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        ends = np.cumsum([0, *[r.length for r in parts]])
        assert [r.offset for r in parts] == list(ends[:-1]) and ends[-1] <= tiers[-1]
        sizes.append(int(ends[-1]))
    assert sum(s & (s - 1) != 0 for s in sizes) <= padded
    return sizes


def test_pack_odd_rows(odd):
    unique = odd.where("text is null or text <> 'same text'")
    found = packing.pack(unique.repartition(3), WORDS, pool_tokens=500).collect()
    assert_packed(found, unique.collect(), padded=3)


def test_pack_long_documents_in_small_pools(spark):
    rows = [(i, "word " * (37 * i % 9001)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = packing.pack(docs.coalesce(1), WORDS, pool_tokens=20_000, group_tokens=8192).collect()
    assert_packed(found, docs.collect())
    groups = {}
    for r in found:
        groups[r.step_group] = groups.get(r.step_group, 0) + r.length
    full = sorted(groups.values())[1:]
    assert max(full) <= 2.5 * min(full)


def test_pack_repeated_rows_and_no_rows(odd):
    same = odd.where("text = 'same text'")
    assert packing.pack(same, WORDS).agg(F.sum("length")).first()[0] == 2 * 3
    assert packing.pack(odd.where("false"), WORDS).count() == 0


def test_op1_on_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = packing.pack(docs, WORDS).collect()
    sizes = assert_packed(found, docs.collect())
    assert sum(sizes) > 100_000
    query = {(r.doc_id, r.start): r for r in queries.op1_packing(spark, sf_dir).collect()}
    assert len(query) == len(found)
    for r in found:
        assert query[r.doc_id, r.start].ids_crc32 == zlib.crc32(r.ids)


def test_pieces_equal_the_library(odd):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = odd.collect()
    found = {r.doc_id: r for r in pieces.encode(odd.repartition(2), MODEL).collect()}
    assert len(found) == len(rows)
    for row in rows:
        text, got = row.text or "", found[row.doc_id]
        want = model.encode(text)
        assert got.ids == [*want, 2] and got.decoded == model.decode([*want, 2])
        data = text.encode()
        for piece, begin, end in zip(model.encode(text, return_type="proto").pieces, got.begins, got.ends):
            assert not piece.surface or data[begin:end].decode() == piece.surface
        assert got.begins[-1] == got.ends[-1] == len(data)
    assert pieces.encode(odd.where("false"), MODEL).count() == 0


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nmt_nfkc_cf", "nfkc_cf"])
def test_character_maps_equal_the_library(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    model = proto.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    own = pieces.Normalizer(model.normalizer_spec)
    for text in odd_texts():
        new, begins, ends = own(text.encode())
        assert new.decode() == library.normalize(text)
        assert len(begins) == len(ends) == len(new)
        assert (begins <= ends).all() and (np.diff(begins) >= 0).all()
    new, begins, ends = own("x ﬁ".encode())
    if rule != "identity":  # both letters come from the three bytes of the ligature
        assert new.endswith(b"fi") and set(begins[-2:]) == {2} and set(ends[-2:]) == {5}


def test_op2_on_the_whole_table(spark, sf_dir):
    import hashlib

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op2_pieces(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = [*model.encode(texts[r.doc_id]), 2]
        assert r.n_tokens == len(ids) and r.n_bytes == len(texts[r.doc_id].encode())
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
