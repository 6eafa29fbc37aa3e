"""The Merkle manifest against plain hashing."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gridmart.llm import manifest, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes):
    """The root of ``nodes`` and each node's siblings, bottom up, as (left, right) texts."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for leaf, place in enumerate(at):
            run, digit = runs[place // 3], place % 3
            paths[leaf].append(("".join(run[:digit]), "".join(run[digit + 1 :])))
            at[leaf] = place // 3
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def fold(digest, path):
    for left, right in path:
        digest = h(left, digest, right)
    return digest


def plain(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, held in by_source.items():
        held.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[source] = plain_tree([plain_leaf(r) for r in held])
    root, upper = plain_tree([trees[s][0] for s in order])
    out = []
    for source, above in zip(order, upper, strict=True):
        subroot, paths = trees[source]
        for row, path in zip(by_source[source], paths, strict=True):
            path = path + above
            changed = dict(row)
            key = row["doc_id"]
            if key is not None and zlib.crc32(str(key).encode()) % 2 == 0 and row["text"] is not None:
                changed["text"] = row["text"].replace("\n", "")
            led = fold(plain_leaf(changed), path)
            proof = h(*[left + right for left, right in path])
            out.append((key, plain_leaf(row), subroot, root, proof, led, led == root))
    return sorted(out, key=str)


def run(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [r.asDict() for r in docs.select(*SCHEMA.replace(",", "").split()[::2]).collect()]
    found = queries.SPARK["op11_manifest"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.collect()), key=str), plain(rows) if rows else []


def test_equals_plain_hashing(spark, tmp_path, sf_dir):
    found, expected = run(spark, tmp_path, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert found == expected and {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("page_levels", [1, 2, 6])
def test_pages_of_any_size_give_the_same(spark, tmp_path, monkeypatch, page_levels):
    """Sources of one leaf, of full runs, of one more, a hot one; null and odd names; repeated rows."""
    monkeypatch.setattr(manifest, "LEVELS", page_levels)
    monkeypatch.setattr(manifest, "PAGE", 3**page_levels)
    rng, rows = random.Random(1), []
    for source, n in [("b", 1), ("é", 9), ("Z", 10), (None, 27), ("", 28), ("hot", 100), ("a,b", 2)]:
        for i in range(n):
            text = rng.choice([None, "", "x\ny", "\n", "é" * 5000, "same\nline"])
            rows.append((rng.choice([None, i, i * 7, -i, 5]), source, rng.choice([None, "en"]), i % 3 or None, text))
    rows += [rows[-1]] * 3
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"tree": F.lit(1), "rank": F.lit("x"), "path": F.lit(2)})
    found, expected = run(spark, tmp_path, docs)
    assert found == expected


def test_many_sources_and_one_row(spark, tmp_path):
    rows = [(i, f"s{i}", "en", 1, "a\nb") for i in range(40)]
    found, expected = run(spark, tmp_path / "many", spark.createDataFrame(rows, SCHEMA))
    assert found == expected
    found, expected = run(spark, tmp_path / "one", spark.createDataFrame([(2, None, None, None, None)], SCHEMA))
    assert found == expected and found[0][1] == found[0][2] == found[0][3] and found[0][4] == h("")


def test_empty_table(spark, tmp_path):
    found, _ = run(spark, tmp_path, spark.createDataFrame([], SCHEMA))
    assert found == []


def test_records_lead_from_the_root_to_every_leaf(spark):
    rows = [(i, "s" if i % 3 else "t", "en", 1, f"text {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    leaves = docs.withColumn("digest", manifest.leaf(*[F.col(f) for f in manifest.FIELDS]))
    built = manifest.build(leaves)
    records = {r["digest"]: r["children"] for r in built.records().collect()}
    assert all(h(*children) == digest for digest, children in records.items())
    seen, todo = set(), [built.root()]
    while todo:
        node = todo.pop()
        seen.add(node)
        todo += records.get(node, [])
    assert {r["digest"] for r in leaves.collect()} <= seen
