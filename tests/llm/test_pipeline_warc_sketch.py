"""The pipeline's decisions stage by stage, WARC round trips and sketches against exact sets."""

import base64
import gzip
import hashlib
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridmart.llm import langid, queries, sketch, warc
from gridmart.session import scratch_path
from test_jaccard import plain
from test_packing_pieces import assert_packed
from workload.compare import connect, difference


def test_pipeline_stages_on_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language", "near_duplicates", "packing"]
    kept, before = docs, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        rows = kept.collect()
        kept = corpus_pipeline.stored(stage(spark, kept, sf_dir), name)
        assert kept.columns == docs.columns
        after = {r.doc_id for r in kept.collect()}
        assert after <= before
        if name == "toxicity":
            wrong = [d for d in before if d in labels and (d in after) == bool(labels[d].toxic)]
            assert len(wrong) <= 0.1 * len(labels) and after != before
            assert not [d for d in before - after if d in labels and not labels[d].toxic]
        elif name == "language":
            assert after == {r.doc_id for r in rows if any(c.isalpha() for c in r.text or "")}
        else:
            assert after == {d for d, _, c in plain([(r.doc_id, r.text) for r in rows]) if d == c}
        before = after
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert_packed(found, kept.collect(), padded=8)


def test_pipeline_edge_cases(spark, sf_dir):
    text = "der und die und das ist ein Text mit Wörtern"
    rows = [(1, None, "de"), (2, "", "de"), (3, "12 34", "de"), (4, text, "de"), (4, text, "de"), (5, text, "de"),
            (None, text + " x", "de"), (6, "word " * 40_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumns({"toxic": F.lit(1), "lang_pred": F.lit("z"), "score": F.lit(0), "node": F.lit(1)})
    civil = corpus_pipeline.keep_civil(spark, docs, sf_dir)
    assert civil.columns == docs.columns and civil.count() == len(rows)
    spoken = corpus_pipeline.keep_language(spark, docs, sf_dir)
    assert spoken.columns == docs.columns and spoken.count() == 5
    single = corpus_pipeline.keep_one_of_each(spark, spoken, sf_dir)
    assert single.columns == docs.columns
    assert sorted(str(r.doc_id) for r in single.collect()) == ["4", "6", "None"]
    assert corpus_pipeline.pack(spark, single, sf_dir).agg(F.sum("length")).first()[0] > 40_000
    none = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0


def test_no_column_of_the_documents_is_lost(spark, sf_dir):
    """Whatever the stages call their own columns; also where ids repeat."""
    text = "der und die und das ist ein Text mit Wörtern"
    names = ["toxic", "low_quality", "likeness", "lang_known", "node", "root", "text_hash", "first"]
    names += [f"_{n}" for n in ("toxic", "low_quality", "likeness", "lang", "node", "hash", "first")] + ["n", "id", "count"]
    rows = [(i, f"{text} {i} " * 9, "de") for i in (1, 2, 2)] + [(2, "ganz anders " + text, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test-columns")
        assert docs.columns == ["doc_id", "text", "lang", *names]
        assert all(r[n] == f"{n}{r.doc_id}" for r in docs.collect() for n in names)
    assert docs.count() >= 2


def test_texts_of_a_repeated_id_are_judged_each(spark, sf_dir):
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(2, a), (4, a + " x"), (4, b), (4, b), (7, c), (7, c + " y"), (7, a + " z"), (8, c + " v"), (9, ""), (9, None),
            (None, a), (5, b + " w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.keep_one_of_each(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    of_seven = [t for d, t in kept if d == 7]
    assert len(of_seven) == 1 and of_seven[0] in (c, c + " y")
    assert [k for k in kept if k[0] != 7] == sorted([(2, a), (4, b), (9, ""), (9, None), (None, a)], key=str)


def test_unlearned_languages_and_gibberish_leave(spark, sf_dir):
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz    "))
    foreign = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
        "Minden emberi lény szabadon születik és egyenlő méltósága és joga van",
        *["".join(rng.choice(letters, n)) for n in (80, 400, 3000)],
        *[base64.b64encode(rng.bytes(n)).decode() for n in (80, 400, 3000)],
    ]
    own = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rows = [(-1 - i, text, None) for i, text in enumerate(foreign)]
    docs = own.unionByName(spark.createDataFrame(rows, own.schema))
    kept = {r.doc_id for r in corpus_pipeline.keep_language(spark, docs, sf_dir).collect()}
    assert kept == {r.doc_id for r in own.collect() if any(c.isalpha() for c in r.text or "")}
    profiles = langid.learn(own)
    found = sorted(plain_likeness(r.text, profiles[r.lang]) for r in own.collect() if any(c.isalpha() for c in r.text or ""))
    usual, n = langid.usual_likeness(own, profiles, 0.05)
    assert n == len(found) and usual == pytest.approx(found[int(0.05 * n)], abs=0.002)
    assert langid.usual_likeness(own, {}, 0.05) == langid.usual_likeness(own.where("false"), profiles, 0.05) == (0.0, 0)


def plain_likeness(text, profile):
    own = langid.ranked(langid.ngrams(langid.letters(text))).tolist()
    return 1 - sum(abs(profile.index(g) - i) if g in profile else 300 for i, g in enumerate(own)) / (300 * len(own))


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_warc_round_trip(spark):
    pages = [(7, "http://a/ ü", "same"), (3, "http://b", "same"), (9, None, "same"), (3, "http://b", "same"),
             (1, "u", None), (2, "u", ""), (4, "u", "WARC/1.0\r\n\r\n\r\n"), (5, "u", "é\n\r\n\r\n" * 50_000),
             (None, "u", "same"), (6, "x\r\nWARC-Type: revisit", "other")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("original", F.lit(1))
    path = scratch_path(spark, "test-warc")
    warc.write_archives(df.repartition(3), path, records_per_file=2)
    found = sorted((tuple(r)[0:1] + tuple(r)[2:] for r in warc.read_archives(spark, path).collect()), key=str)
    want = []
    for page, _, html in pages:
        first = min(p for p, _, h in pages if p is not None and (h or "") == (html or ""))
        later = page is not None and page > first
        payload = (html or "").encode()
        want.append(
            (page, len(payload), digest(html), "revisit" if later else "response",
             first if later else None, None if later else payload)
        )
    assert found == sorted(want, key=str)
    files = [f for f in Path(path.removeprefix("file://")).rglob("*.gz")]
    assert len(files) >= 5
    for f in files:
        with gzip.open(f, "rb") as g:
            assert g.read(10) == b"WARC/1.0\r\n"
    warc.write_archives(df, path + "-large", min_bytes=5)
    kinds = warc.read_archives(spark, path + "-large").groupBy("record_type").count().collect()
    assert {r.record_type: r["count"] for r in kinds} == {"response": len(pages)}
    warc.write_archives(df.where("false"), path + "-none")
    assert warc.read_archives(spark, path + "-none").count() == 0


def test_cut_off_archives_are_refused():
    record = b"WARC/1.0\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    assert [b for _, b in warc._parse(iter([record, record[:20], record[20:]]))] == [b"abcde"] * 2
    for cut in (8, 30, 36):
        with pytest.raises(ValueError):
            list(warc._parse(iter([record[:cut]])))


def other_record(kind, body, **fields):
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\nwarc-type: {kind}\r\n{head}content-length:{len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("layout", ["one member", "a member each", "small steps"])
def test_archives_of_other_writers_are_read_whole(spark, tmp_path, layout, monkeypatch):
    """Three pages among records of other types, whatever the members; and a page that inflates a lot."""
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    bodies = [b"one", b"", b"0" * 3_000_000]
    every = [other_record("warcinfo", b"software: x\r\n")]
    for body in bodies:
        every += [other_record("request", b"GET / HTTP/1.1\r\n\r\n"), other_record("response", http + body, **{"WARC-Target-URI": "u:x"})]
    every.append(other_record("revisit", http, **{"WARC-Payload-Digest": "sha1:ABC"}))
    parts = [b"".join(every)] if layout == "one member" else every
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    content = (tmp_path / "a" / "x.warc.gz").read_bytes()
    if layout == "small steps":
        pieces = list(warc._inflate(content, 1000))
        assert max(map(len, pieces)) <= 1000 and b"".join(pieces) == b"".join(every)
    found = warc.read_archives(spark, str(tmp_path)).collect()
    assert [(r.payload_bytes, r.record_type, r.page_id) for r in found] == [
        (3, "response", None), (0, "response", None), (3_000_000, "response", None), (None, "revisit", None)]
    assert [r.payload_digest for r in found[:3]] == [digest(b.decode()) for b in bodies]
    for bad in (content[:-20], content + b"junk"):
        with pytest.raises((ValueError, zlib.error)):
            list(warc._inflate(bad))


def test_large_pages_share_no_archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SIZES", ((10, 100), (100, 2), (1 << 31, 1)))
    pages = [(i, "u", "x" * n) for i, n in enumerate([1, 2, 3, 50, 60, 70, 500, 600, 3])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"))
    files = {p.name: len(list(p.glob("*.gz"))) for p in (tmp_path / "w").iterdir()}
    assert files["size=1"] >= 2 and files["size=2"] >= 2
    found = warc.read_archives(spark, str(tmp_path / "w"))
    assert sorted((r.page_id, r.record_type) for r in found.collect()) == [
        (i, "revisit" if i == 8 else "response") for i in range(9)]


def test_op8_equals_plain_digests(spark, sf_dir):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    first = {}
    for page, html in sorted(pages):
        first.setdefault(digest(html), page)
    want = [
        (p, len((h or "").encode()), digest(h), *(("revisit", first[digest(h)]) if first[digest(h)] < p else ("response", None)))
        for p, h in pages
    ]
    found = queries.op8_warc(spark, sf_dir)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def exact(text):
    words = (text or "").lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_op5_against_exact_sets_and_sql(spark, sf_dir):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    found = {r.doc_id: r for r in queries.op5_fingerprints(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    same = {}
    for i, (doc, text) in enumerate(docs):
        r, following = found[doc], docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = exact(text), exact(edited), exact(following)
        jaccard = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert abs(r.near_edited - jaccard(a, b)) < 0.3 and abs(r.near_next - jaccard(a, c)) < 0.3
        assert abs(r.distinct_shingles - len(a)) <= 0.6 * len(a)
        assert same.setdefault(text, r.fingerprint) == r.fingerprint
        if len(a | b) <= sketch.K:
            assert r.near_edited == pytest.approx(jaccard(a, b)) and r.distinct_shingles == len(a)
    digests = queries.op5_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")
    assert difference(connect(sf_dir), digests, EDITED) is None
    plan = queries.op5_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "RDD" not in plan.replace("MapPartitionsRDD", "")


EDITED = """
WITH next AS (
    SELECT doc_id, coalesce(text, '') AS t,
           coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id),
                    first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS u
    FROM documents
)
SELECT doc_id, length(t) AS n_chars,
       sha256(substr(t, 1, length(t) - length(t) // 2) || substr(u, 1, length(t) // 2)) AS edited_sha256
FROM next
"""


def test_sketches_merge_and_estimate(spark):
    parts = [("x", " ".join(f"w{i}" for i in range(a, a + 300))) for a in (0, 200, 400)]
    df = spark.createDataFrame(parts, "g string, t string").withColumn("s", sketch.sketch(F.col("t")))
    merged = sketch.merged(df, ["g"], "s").first().s
    whole = spark.createDataFrame([(" ".join(f"w{i}" for i in range(700)),)], "t string")
    row = whole.select(sketch.sketch(F.col("t")).alias("s")).select("s", sketch.distinct_count(F.col("s")).alias("n")).first()
    assert merged == row.s and len(merged) == sketch.K and 450 < row.n < 1000
    a, b, _ = df.collect()
    pair = spark.createDataFrame([(a.s, b.s)], "a array<long>, b array<long>")
    near = pair.select(
        sketch.merge(F.col("a"), F.col("b")).alias("m"),
        sketch.resemblance(F.col("a"), F.col("b")).alias("r"),
        sketch.containment(F.col("a"), F.col("b")).alias("c"),
    ).first()
    assert near.m == sorted(set(a.s) | set(b.s))[: sketch.K]
    assert abs(near.r - 96 / 496) < 0.2 and abs(near.c - 96 / 296) < 0.3


def test_sketch_edge_cases_and_neighbours(spark):
    rows = [(10**12, "z"), (3, None), (3, None), (None, "n"), (-5, ""), (7, "a b"), (8, "x " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_slice", F.lit("q"))
    made = sketch.fingerprints(df, {"text": "s"})
    sizes = {str(r.doc_id): len(r.s) for r in made.collect()}
    assert sizes == {"1000000000000": 1, "3": 0, "None": 1, "-5": 0, "7": 1, "8": 1}
    found = sketch.with_next(df.repartition(3), "doc_id", {"text": "after"}, per_slice=2)
    assert found.columns == ["doc_id", "text", "_slice", "after"]
    got = sorted(((r.doc_id, r.after) for r in found.collect()), key=str)
    assert got == sorted(
        [(None, ""), (-5, None), (3, None), (3, "a b"), (7, "x " * 100_000), (8, "z"), (10**12, "n")], key=str
    )
    assert sketch.with_next(df.where("false"), "doc_id", {"text": "after"}).count() == 0
