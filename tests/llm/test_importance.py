"""Importance resampling: features, weights and draws against a plain loop."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from enrichlab.llm import importance
from tests.llm.conftest import EDGES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PIECES = ["a", "Bc", "é", "É", "中", "😀", " ", "  ", "\n", "\x00", "-", "9", "x" * 40, "ab cd", "_", "\x85", "\xa0"]


def plain_features(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return words, [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_resample(docs, target, percent=5):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(plain_features(text)[1])
    for text in target:
        t.update(plain_features(text)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (s.total() + 10000.0) / ((s[b] + 1.0) * (t.total() + 10000.0)))) for b in range(10_000)}
    rows = []
    for i, text in docs:
        words, features = plain_features(text)
        weight = sum(gain[b] for b in features)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], (0, 0) if r[0] is None else (1, r[0])))
    rank = {id(r): k + 1 for k, r in enumerate(fit[: percent * len(fit) // 100])}
    return sorted(((*r, rank.get(id(r))) for r in rows), key=str)


def test_matrix_checksums():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 300):
        rows = rng.integers(0, 256, (50, n), np.uint8)
        assert importance.crc32_columns(rows.T).tolist() == [zlib.crc32(r.tobytes()) for r in rows]


@pytest.mark.parametrize(("words", "size", "few"), [(120_000, 1 << 21, 32), (7, 5, 1), (1, 1, 32), (3, 50, 2)])
def test_features_do_not_depend_on_blocks(monkeypatch, words, size, few):
    for name, value in (("BLOCK_WORDS", words), ("BLOCK_BYTES", size), ("FEW_ROWS", few)):
        monkeypatch.setattr(importance, name, value)
    rng = random.Random(words)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(150)] + ["", None]
    got, n_words = [[] for _ in texts], [0] * len(texts)
    for found, owner, numbers, new in importance.text_features([None if t is None else t.encode() for t in texts], 10_000):
        for b, i in zip(found.tolist(), owner.tolist(), strict=True):
            got[i].append(b)
        for i, n in zip(numbers.tolist(), new.tolist(), strict=True):
            n_words[i] += n
    for text, features, n in zip(texts, got, n_words, strict=True):
        words_, want = plain_features(text)
        assert sorted(features) == sorted(want)
        assert n == len(words_)


@pytest.mark.parametrize("percent", [5, 37, 100])
def test_draws_equal_a_plain_loop(spark, docs, percent):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, "w " * 30), (7, "w " * 30), (7, "w " * 30)]
    target = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_resample(rows, target, percent)


def test_edges(edges, nothing):
    rows = importance.resample(edges, nothing, percent=50).collect()
    want = plain_resample([(r[0], r[1]) for r in EDGES], [], 50)
    assert sorted((tuple(r) for r in rows), key=str) == want
    assert importance.resample(nothing, edges).count() == 0
    ids = [r.rank for r in rows if r.rank is not None]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_long_texts_in_linear_time():
    """Words of very many lengths give groups of one row each; a megabyte of them takes seconds."""
    import time

    text = " ".join("x" * n for n in range(1, 1500)).encode()
    start = time.time()
    total = sum(len(found) for found, *_ in importance.text_features([text], 10_000))
    assert total == 3 * 1499 - 3
    assert time.time() - start < 20
