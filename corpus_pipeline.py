"""The corpus pipeline: toxicity, language, near duplicates, packing.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but the last
return the columns of ``documents``. Rows without an id pass the near-duplicate stage; rows that
repeat another in id and text leave it once, and an id's different texts are judged each; texts that are null or without a letter leave at the
language stage. An empty table passes all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm import jaccard, langid, packing, toxicity
from gridmart.llm.common import spare, stored, table

TOXIC = 0.5  # probability from which a document is rejected
USUAL = 0.5  # of the likeness that all but ODD of the texts with a language have to it: under that, rejected
ODD = 0.05
PRIOR, PRIOR_TEXTS = 0.1, 20  # that likeness counts as known to be PRIOR from so many texts besides
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DROPPED = 2_000_000  # ids that are broadcast; more are joined by a shuffle


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on labelled ones, does not take for toxic."""
    names = spare(docs, "low_quality", "toxic")
    judged = toxicity.judged(docs, table(spark, sf_dir, "labels"), names=tuple(names))
    return judged.where(F.col(names[1]) < TOXIC).drop(*names)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents' own ``lang`` teaches."""
    lang, likeness = names = spare(docs, "lang_known", "likeness")
    profiles = langid.learn(docs)
    usual, texts = langid.usual_likeness(docs, profiles, ODD)
    least = USUAL * (usual * texts + PRIOR * PRIOR_TEXTS) / (texts + PRIOR_TEXTS)
    judged = langid.predict(docs, profiles, names=tuple(names))
    known = (F.col(lang) != langid.UNKNOWN) & (F.col(likeness) >= least)
    return judged.where(known).drop(*names)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; where that id repeats with
    several texts of the group, one of these."""
    node, root, text, first_of = spare(docs, "node", "root", "text_hash", "first")
    found = stored(jaccard.near_duplicates(docs, nodes=(node, root)), "near-duplicates")
    dropped = found.where("doc_id <> component_id").select("doc_id").dropDuplicates()
    twice = found.groupBy("doc_id").count().where("count > 1 and doc_id is not null")
    if twice.isEmpty():
        return without(docs, dropped).select(docs.columns)
    repeated = stored(twice.select("doc_id"), "repeated-ids")
    once = without(docs.join(repeated, "doc_id", "left_anti"), dropped)
    rows = docs.join(repeated, "doc_id").dropDuplicates(["doc_id", "text"])
    rows = jaccard.with_node(rows, node).withColumn(text, F.xxhash64("text"))
    rows = stored(rows, "repeated-rows")
    groups = found.where("doc_id = component_id").where(F.col(node).isNotNull())
    groups = groups.join(repeated, "doc_id", "left_semi").select("doc_id", node, root).dropDuplicates()
    first = rows.select("doc_id", node, text).join(groups, ["doc_id", node])
    first = first.groupBy("doc_id", root).agg(F.min(F.struct(node, text)).alias(first_of))
    first = first.select("doc_id", f"{first_of}.*")
    kept = rows.where(F.col(node).isNull()).unionByName(
        rows.join(first, ["doc_id", node, text], "left_semi")
    )
    return once.select(docs.columns).unionByName(kept.select(docs.columns))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    if dropped.count() <= DROPPED:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, "doc_id", "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as token sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", keep_civil),
    ("language", keep_language),
    ("near_duplicates", keep_one_of_each),
    ("packing", pack),
]

ORACLE_SQL = None  # none of the stages can be said in SQL; tests hold them against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
