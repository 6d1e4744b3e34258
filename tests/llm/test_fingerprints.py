"""Document fingerprints against plain Python trees."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from enrichlab.llm import fingerprints
from tests.llm.conftest import EDGES

PIECES = re.compile(r"[^.,;:!?|]{1,48}[.,;:!?|]*|[.,;:!?|]+")


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(text):
    """(fingerprint, marks, paragraph digests)."""
    tree = [[[H(x) for x in PIECES.findall(p)] for p in s.split("\n")] for s in text.split("\n\n")]
    paragraphs = [[H("p:" + "".join(p)) for p in s] for s in tree]
    root = H("r:" + "".join(H("s:" + "".join(s)) for s in paragraphs))
    short = "|".join(";".join("".join(h[:8] for h in p) for p in s) for s in tree)
    return f"{root}:{short}", {h[:8] for s in tree for p in s for h in p}, paragraphs


def near(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def plain_rows(rows):
    """(doc_id, n_chars, edited, fingerprint, edited fingerprint, near_edited, near_next)."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, text) in enumerate(order):
        after, cut = order[(k + 1) % len(order)][1], len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        (f, m, _), (e, em, _), (_, am, _) = plain(text), plain(edited), plain(after)
        out.append((i, len(text), edited, f, e, near(m, em), near(m, am)))
    return sorted(out, key=str)


def rows_of(found):
    return sorted(((r.doc_id, r.n_chars, r.edited, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in found.collect()), key=str)


@pytest.mark.parametrize("size", [1 << 28, 50_000])
def test_pairs_equal_a_plain_loop(spark, docs, size):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000 + i, "".join(rng.choice(["a", "é", "中", "😀", ".", ", ", "\n", "\n\n", " ", "long word"]) for _ in range(rng.randint(0, 80)))) for i in range(100)]
    rows += [(2000, None), (2001, ""), (2002, "no end " * 40), (-5, "x"), (None, "no id.\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(fingerprints.compare_with_edited(df, range_bytes=size)) == plain_rows(rows)


def test_differing_branches_show_the_edit(spark):
    a, b = "One.\nTwo.\n\nThree, four.\nFive.", "One.\nTwo.\n\nThree, 4.\nFive.\nSix."
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "a_"), "b", "b_")
    (r,) = df.select(fingerprints.differing(F.col("b_paragraphs"), F.col("a_paragraphs")).alias("new"), fingerprints.differing(F.col("a_paragraphs"), F.col("b_paragraphs")).alias("old")).collect()
    assert [tuple(x) for x in r.new] == [(1, 0), (1, 2)]
    assert [tuple(x) for x in r.old] == [(1, 0)]


def test_roots_tell_texts_apart(spark):
    texts = ["", "a", "a\n", "\na", "a\n\n", "a\n\nb", "a\nb", "a.b", "ab", "a. b", "." * 200, "." * 201, "x" * 48, "x" * 49, "x" * 96, "a\n\n\nb", "a\n\n\n\nb"]
    df = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string")
    got = fingerprints.fingerprint(df).collect()
    by_text = {}
    for r in got:
        by_text.setdefault(texts[r.doc_id % len(texts)], set()).add((r.root, r.fingerprint))
    assert all(len(v) == 1 for v in by_text.values())
    assert len({r.root for r in got}) == len(texts)
    assert all(r.fingerprint == plain(texts[r.doc_id % len(texts)])[0] for r in got)


def test_edges(edges, nothing):
    rows = rows_of(fingerprints.compare_with_edited(edges))
    assert len(rows) == len(EDGES)
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r)
    assert by_id[2][0][3] == by_id[3][0][3]  # an empty and a null text
    assert by_id[5][0][3] == by_id[6][0][3]
    assert len(by_id[1]) == 2 and {r[3] for r in by_id[1]} == {plain(EDGES[0][1])[0]}
    assert fingerprints.compare_with_edited(nothing).count() == 0
    assert fingerprints.fingerprint(nothing).count() == 0
    (alone,) = fingerprints.compare_with_edited(edges.filter("doc_id = 8")).collect()
    assert (alone.near_next, alone.edited) == (1.0, "x")


def test_rows_of_one_id_are_split(spark):
    rows = [(7, f"text number {i}.") for i in range(60)] + [(8, "eight"), (6, "six")]
    got = fingerprints.compare_with_edited(spark.createDataFrame(rows, "doc_id long, text string"), range_bytes=100).collect()
    assert len(got) == 62
    # every row is followed by another one: each text's start is taken once
    assert sum(r.doc_id == 7 for r in got) == 60


def test_the_plan_has_no_python(spark, docs):
    plan = fingerprints.compare_with_edited(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
    assert plan.count("Window") >= 1
