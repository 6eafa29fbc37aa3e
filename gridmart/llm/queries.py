"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gridmart.session import scratch_path

from . import (
    covertree, jaccard, langid, licences, manifest, maxent, mixing, packing, phrases, pieces, sketch, toxicity, warc,
)
from .common import stored, table
from .oracle import SQL

Query = Callable[[SparkSession, str], DataFrame]
SPARK: dict[str, Query] = {}


def query(fn: Query) -> Query:
    if fn.__name__ in SPARK:
        raise ValueError(f"{fn.__name__} is registered already")
    SPARK[fn.__name__] = fn
    return fn


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in full sequences; the ids stay behind once their checksum is taken."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    found = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded with its byte spans, and decoded again."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    found = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    last = F.element_at("ends", -1).cast("long")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        last.alias("n_bytes"),
        F.xxhash64("begins", "ends").alias("spans_hash"),
    )


@query
def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template spans of every text."""
    found = licences.scan(table(spark, sf_dir, "documents"))
    named = F.array_union("base_labels", F.transform("spans", lambda s: s["label"]))
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        joined(F.col("base_labels")).alias("base_labels"),
        joined(named).alias("labels"),
        "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


@query
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their five-word shingles."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k sketches of every document and of its half-replaced edit, and their likeness."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    docs = sketch.fingerprints(docs, {"text": "sketch"})
    pairs = sketch.with_next(docs, "doc_id", {"text": "next_text", "sketch": "next_sketch"})
    n = F.length("text")
    half = (n / 2).cast("int")
    edited = F.concat(
        F.substring("text", 1, n - half), F.substring("next_text", F.lit(1), half)
    )
    both = sketch.fingerprints(pairs.withColumn("edited", edited), {"edited": "edited_sketch"})
    return both.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch.as_text(F.col("sketch")).alias("fingerprint"),
        sketch.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketch.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketch.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        sketch.containment(F.col("sketch"), F.col("edited_sketch")).alias("held_by_edited"),
        sketch.distinct_count(F.col("sketch")).alias("distinct_shingles"),
    )


@query
def op6_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all texts by counts and by the class model of six sevenths of them."""
    out = langid.held_out(F.col("doc_id"), 7, 2)
    return maxent.scores(table(spark, sf_dir, "documents"), out, maxent.FITS)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of every document by a chain fitted on labelled documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.judged(docs, table(spark, sf_dir, "labels")).drop("text")
    return found.withColumn("is_toxic", F.col("toxic") >= 0.5)


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages as deduplicated archives and reads them back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).drop("payload", "url")


@query
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicts every text's language from profiles of three quarters of the documents."""
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"), 4, 2)
    profiles = langid.learn(docs.where(~out))
    judged = langid.predict(docs.select("doc_id", out.alias("held_out"), "text"), profiles)
    return judged.drop("text")


@query
def op10_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors by cosine within their label."""
    vectors = table(spark, sf_dir, "embeddings")
    return covertree.near_duplicates(vectors, "vec_id", "embedding", "label", 0.98)


@query
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest DAG of all documents, a proof of every leaf, and the root that each leaf leads to when
    the line feeds of some texts are deleted."""
    docs = table(spark, sf_dir, "documents")
    fields = {f: F.col(f) for f in manifest.FIELDS}
    odd = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = fields | {"text": F.when(odd, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    leaves = docs.select(
        "source", "doc_id", manifest.leaf(*fields.values()).alias("digest"),
        manifest.leaf(*tampered.values()).alias("tampered"),
    )
    found = manifest.proofs(manifest.build(stored(leaves, "manifest-digests"), carry=("tampered",)))
    folded = found.withColumn("folded_root", manifest.folded(F.col("tampered"), F.col("path")))
    return folded.select(
        F.col("key").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        manifest.siblings_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document gives to a mixture of the sources by weight."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source", "begin")
