"""The dataset manifest against a plain tree, with subtrees of every size."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from enrichlab.llm import manifest
from tests.llm.conftest import EDGES

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """The root, and each node's proof as (before, after) per level."""
    proofs, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(places):
            first = at - at % 3
            proofs[i].append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 3])))
            places[i] = at // 3
        nodes = [H(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], proofs


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, steps) of rows (doc_id, source, lang, n_chars, text)."""
    order = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    sources = sorted({r[1] for r in rows}, key=order)
    trees = []
    for s in sources:
        leaves = sorted(((r[0], leaf_of(r)) for r in rows if r[1] == s), key=lambda x: (order(x[0]), x[1]))
        trees.append((leaves, *plain_tree([h for _, h in leaves])))
    root, above = plain_tree([t[1] for t in trees])
    return sorted(((i, h, subroot, root, p + above[k]) for k, (leaves, subroot, proofs) in enumerate(trees) for (i, h), p in zip(leaves, proofs, strict=True)), key=str)


def rows_of(proofs):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [(s.before, s.after) for s in r.steps]) for r in proofs.collect()), key=str)


@pytest.mark.parametrize("stride", [1, 2, 6])
def test_proofs_equal_a_plain_tree(spark, stride):
    sizes = {"hot": 300, "two": 2, "three": 3, "four": 4, "nine": 9, "ten": 10, "é": 1, "Z": 28, None: 5}
    rows = [(k * 1000 + i * 7 % 997, s, "en" if i % 3 else None, i, f"text {i}\n") for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert rows_of(manifest.prove(manifest.build_manifest(df, stride=stride))) == plain_manifest(rows)


def test_every_proof_folds_to_the_root_and_tampering_shows(spark, docs):
    shorter = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in COLUMNS]
    proofs = manifest.prove(manifest.build_manifest(docs, carry={"found": manifest.leaf_digest(shorter), "seq": F.col("text"), "_range": F.col("source")}))
    got = proofs.select("doc_id", "root", F.col("seq").alias("text"), manifest.fold(F.col("leaf"), F.col("steps")).alias("whole"), manifest.fold(F.col("found"), F.col("steps")).alias("folded")).collect()
    assert len(got) == docs.count()
    assert all(r.whole == r.root and (r.folded == r.root) == ("\n" not in r.text) for r in got)


def test_query(spark):
    from enrichlab.llm.queries import op12_dataset_manifest

    rows = [tuple(r[c] for c in COLUMNS) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = {r[0]: r for r in rows}
    want = {i: (leaf, sub, root, steps) for i, leaf, sub, root, steps in plain_manifest(rows)}
    for r in op12_dataset_manifest(spark, "/root/testdata/sf0.001").collect():
        leaf, sub, root, steps = want[r.doc_id]
        node = leaf
        if zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
            row = texts[r.doc_id]
            node = leaf_of((*row[:4], row[4].replace("\n", "")))
        for before, after in steps:
            node = H(before, node, after)
        assert (r.leaf, r.subroot, r.root, r.folded_root, r.verified) == (leaf, sub, root, node, node == root)
        assert r.proof_sha256 == H(*(b + a for b, a in steps))


def test_edges(spark, edges, nothing):
    rows = [(i, source, lang, n, text) for i, text, lang, source, n in EDGES]
    assert rows_of(manifest.prove(manifest.build_manifest(edges))) == plain_manifest(rows)
    empty = manifest.build_manifest(nothing)
    assert empty.root is None
    assert manifest.prove(empty).count() == 0
    one = manifest.build_manifest(edges.filter("doc_id = 5"))
    (proof,) = manifest.prove(one).collect()
    assert proof.leaf == proof.subroot == proof.root == one.root and proof.steps == []
