"""Licence scans and language profiles against plain versions of the same rules."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridmart.llm import langid, licences, queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_base(text):
    words, starts, labels = plain_words(text), [], set()
    for label, phrases in licences.PHRASES.items():
        for phrase in phrases:
            want = phrase.split()
            here = [i for i in range(len(words)) if words[i : i + len(want)] == want]
            starts += here
            labels |= {label} if here else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), labels


def random_texts(n):
    dice = random.Random(3)
    parts = [t for texts in licences.TEMPLATES.values() for t in texts]
    parts += ["under the MIT License", "Apache License,\nVersion 2", "CC BY-NC", "été the of license"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(dice.randint(0, 6)):
            part = dice.choice(parts).split()
            a = dice.randint(0, len(part))
            words += part[a : a + dice.randint(0, len(part))] + ["zzz"] * dice.randint(0, 2)
        out.append(" ".join(words))
    return out


def test_matching_statistics_are_the_longest_matches():
    scanner = licences.Scanner(licences.TEMPLATES, licences.PHRASES, 3, 0.7)
    runs = {tuple(s[i:j]) for s in scanner.sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for text in random_texts(200):
        words = [scanner.vocabulary.get(w.encode(), 0) for w in plain_words(text)]
        state = length = 0
        for i, word in enumerate(words):
            state, length = scanner.automaton.step(state, length, word)
            want = max((n for n in range(i + 2) if tuple(words[i + 1 - n : i + 1]) in runs), default=0)
            assert length == want
            ends = {
                (s, p)
                for s, seq in enumerate(scanner.sequences)
                for p in range(length - 1, len(seq))
                if seq[p - length + 1 : p + 1] == words[i + 1 - length : i + 1]
            }
            assert not length or set(scanner.automaton.ends[state]) == ends


def test_scan_finds_all_base_places_and_spans(spark):
    texts = [*random_texts(300), None, "", "mit", "under the mit license " * 3000]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    found = {r.doc_id: r for r in licences.scan(docs.repartition(3)).collect()}
    assert len(found) == len(texts) and licences.scan(docs.where("false")).count() == 0
    for i, text in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, set(r.base_labels)) == plain_base(text)
        assert 0 <= r.score <= 1 and all(0.7 <= s.coverage <= 1 for s in r.spans)
    assert len(found[len(texts) - 1].spans) == 3000 or found[len(texts) - 1].n_base == 3000


def test_a_template_with_changed_words_is_one_chain():
    scanner = licences.Scanner(licences.TEMPLATES, licences.PHRASES, 3, 0.7)
    words = licences.TEMPLATES["mit"][1].split()
    words[7] = "everyone"
    words[20:21] = ["a", "b"]
    _, n, *_, labels, spans, score = scanner.scan(" ".join(["x", *words, "y"]).encode())
    assert n == 0 and labels == [] and [(s[0], s[1], s[2]) for s in spans] == [("mit", 1, len(words))]
    assert score == spans[0][3] == pytest.approx((len(licences.TEMPLATES["mit"][1].split()) - 2) / len(licences.TEMPLATES["mit"][1].split()), abs=0.05)
    assert scanner.scan(b"the license of the work is in the under")[5] == []


def test_every_copy_of_a_template_is_a_span():
    scanner = licences.Scanner(licences.TEMPLATES, licences.PHRASES, 3, 0.7)
    line = licences.TEMPLATES["mit"][0].split()
    for k in (1, 2, 3, 50, 3000):
        spans = scanner.scan(" ".join(line * k).encode())[5]
        assert spans == [("mit", 5 * i, 5 * i + 4, 1.0) for i in range(k)]
    long = licences.TEMPLATES["mit"][1].split()
    size = len(long)
    for k, gap in ((2, 0), (3, 0), (4, 3), (300, 0)):
        for changes in ([7] * k, [5 + i * 3 % (size - 10) for i in range(k)]):
            words = []
            for c in changes:
                words += [*long[:c], "changed", *long[c + 1 :], *["x"] * gap]
            spans = scanner.scan(" ".join(words).encode())[5]
            assert [s[0] for s in spans] == ["mit"] * k
            assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))
            if len(set(changes)) == 1:
                at = [i * (size + gap) for i in range(k)]
                assert [s[1:3] for s in spans] == [(a, a + size - 1) for a in at]
    inserted = long[:12] + ["y"] * 15 + long[12:]
    assert [s[1:] for s in scanner.scan(" ".join(inserted).encode())[5]] == [(0, size + 14, 1.0)]


def test_op3_on_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.op3_licences(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    labelled = 0
    for d in docs:
        r, (n, places, first, last, labels) = found[d.doc_id], plain_base(d.text)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, places, first, last)
        assert r.base_labels == ",".join(sorted(labels))
        assert labels <= set(r.labels.split(",")) | {""}
        labelled += bool(r.labels)
        assert bool(r.labels) == bool(re.search("licensed? under|the MIT License", d.text or "", re.I)) or not r.labels
    assert labelled


def plain_letters(text):
    out = [0]
    for c in text + " ":
        k = langid._class(ord(c))
        if k or out[-1]:
            out.append(k)
    return out if any(out) else []


def plain_grams(text):
    x, c = plain_letters(text), Counter()
    for n in (1, 2, 3):
        for i in range(len(x) - n + 1):
            if n > 1 or x[i]:
                code = 0
                for k in x[i : i + n]:
                    code = code * 64 + k
                c[(0, 64, 64 + 4096)[n - 1] + code] += 1
    return c


def plain_profile(counter):
    return [g for g, _ in sorted(counter.items(), key=lambda kv: (-kv[1], kv[0]))[:300]]


def plain_prediction(text, profiles):
    own = plain_profile(plain_grams(text or ""))
    if not own or not profiles:
        return "und", 0.0
    far = {
        lang: sum(abs(p.index(g) - i) if g in p else 300 for i, g in enumerate(own))
        for lang, p in profiles.items()
    }
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (300 * len(own))


def test_op9_equals_plain_profiles_and_holds_up_on_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    counters = {}
    for d in docs:
        if zlib.crc32(str(d.doc_id).encode()) % 4 != 2 and d.lang is not None:
            counters.setdefault(d.lang, Counter()).update(plain_grams(d.text or ""))
    profiles = {lang: plain_profile(c) for lang, c in counters.items()}
    found = {r.doc_id: r for r in queries.op9_langid(spark, sf_dir).collect()}
    right = total = 0
    for d in docs:
        r = found[d.doc_id]
        lang, score = plain_prediction(d.text, profiles)
        assert r.lang_pred == lang and r.score == pytest.approx(score)
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        right, total = right + (r.held_out and lang == d.lang), total + r.held_out
    assert right >= 0.95 * total > 0


def test_language_edge_cases(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (4, "The cat and the dog", "en"),
            (5, "Der Hund und die Katze", "de"), (5, "Der Hund und die Katze", "de"), (6, "x" * 200_000, None),
            (7, "𐐀𐐁 😀", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumn("score", docs.lang)
    profiles = langid.learn(docs.drop("score"))
    assert set(profiles) == {"de", "en"}
    found = langid.predict(docs, profiles)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = sorted((r.doc_id, r.lang_pred) for r in found.collect())
    assert [g for g in got if g[0] < 6] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (5, "de")]
    assert dict(got)[6] in profiles and dict(got)[7] in profiles
    assert langid.predict(docs, {}).where("lang_pred <> 'und' or score <> 0").count() == 0
    assert langid.learn(docs.where("false").drop("score")) == {}


def test_ranked_keeps_the_most_frequent():
    grams = np.array([5, 5, 9, 1, 1, 7])
    assert langid.ranked(grams, 3).tolist() == [1, 5, 7]
