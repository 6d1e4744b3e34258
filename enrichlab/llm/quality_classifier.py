"""A quality classifier: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader updates and scored as sparse dot products.

Features of a text are its word uni- and bigrams as written, the uni-, bi- and trigrams of the word
shapes (``AND!!`` has the shape ``X!``), and marks for a word that repeats the one before or the one
before that; all are hashed into ``DIMS`` buckets, and the counts are scaled to length 1.

Training takes a bounded sample of labelled rows (``train_rows``, about; chosen by a hash of the
id).  They are dealt by hash to a fixed number of shards; each shard runs the updates over its rows
in hash order, and the weights of the shards are averaged.  So training takes the same time at
every input size, and only ``shards`` vectors of ``DIMS`` numbers meet on the driver.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichlab.llm.common import RecentDict, mix64, text_slices, texts_of, word_hash

DIMS = 1 << 18
TRAIN_ROWS = 24_000
SHARDS = 8
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shape(word: str) -> str:
    """The kinds of characters of a word, runs as one: X upper, x lower case, 9 digit, else itself."""
    kinds = ("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return "".join(k for k, _ in itertools.groupby(kinds))


def _packed(word: str) -> int:
    """44 bits of the word's hash and 20 of its shape's."""
    return (word_hash(word) >> 20 << 20) | (word_hash("shape " + shape(word)) >> 44)


_PACKED = RecentDict(_packed, 250_000)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (distinct, ascending) and values of a text; a constant feature is always there."""
    words = _WORD.findall(text)
    v = np.fromiter(map(_PACKED.__getitem__, words), np.uint64, len(words))
    surface, form = v >> np.uint64(20), v & np.uint64((1 << 20) - 1)
    k = np.uint64(0x9E3779B97F4A7C15)
    kinds = [surface, surface[:-1] * k + surface[1:], form, form[:-1] * k + form[1:], (form[:-2] * k + form[1:-1]) * k + form[2:]]
    kinds += [np.zeros(int((v[d:] == v[:-d]).sum()), np.uint64) + np.uint64(d) for d in (1, 2)]
    hashed = [mix64(x + np.uint64((i + 1) << 58)) >> np.uint64(64 - 18) for i, x in enumerate(kinds)]
    at, n = np.unique(np.concatenate([*hashed, np.zeros(1, np.uint64)]).astype(np.int64), return_counts=True)
    value = n.astype(np.float64)
    return at, value / np.sqrt((value * value).sum())


def probability(weights: np.ndarray, text: str) -> float:
    at, value = features(text)
    return float(1 / (1 + np.exp(-np.clip(weights[at] @ value, -35, 35))))


class Ftrl:
    """Per-coordinate follow-the-regularised-leader with L1 and L2 terms."""

    def __init__(self, dims: int = DIMS) -> None:
        self.z, self.n = np.zeros(dims), np.zeros(dims)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = grown


def train(docs: DataFrame, labels: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights learned from the rows of ``labels`` where ``use`` holds and the label is 0 or 1, and
    their texts.

    An id with several labels has the lowest.  Ids without a document, null ids and null labels
    teach nothing; without any row the weights are 0 and every score 0.5.
    """
    usable = labels.filter(use & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    n = usable.count()
    share = min(1_000_000, train_rows * 1_000_000 // max(n, 1))
    pick = F.crc32(F.concat(F.col("id").cast("string"), F.lit("/q")))
    # about train_rows rows of two numbers: a bounded side, so it may be broadcast
    chosen = usable.filter(pick % 1_000_000 < share).groupBy("id").agg(F.min("label").alias("label"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").withColumn("order", F.xxhash64(F.col("id").cast("string"), F.lit(11)))
    dealt = rows.withColumn("shard", F.pmod("order", F.lit(SHARDS))).repartition(SHARDS, "shard").sortWithinPartitions("shard", "order", "text").select("shard", "text", "label")

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, made = None, []

        def out() -> pa.RecordBatch:
            model = Ftrl()
            for _ in range(EPOCHS):
                for at, value, label in made:
                    model.update(at.astype(np.int64), value.astype(np.float64), label)
            w = model.weights()
            at = np.flatnonzero(w)
            return pa.RecordBatch.from_arrays([pa.array([len(made)], pa.int64()), pa.array([at.astype("<i4").tobytes()], pa.binary()), pa.array([w[at].astype("<f8").tobytes()], pa.binary())], ["n", "at", "w"])

        for piece in text_slices(batches, 1):
            for s, text, label in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                if made and s != shard:
                    yield out()
                    made = []
                shard = s
                at, value = features(text)
                made.append((at.astype(np.int32), value.astype(np.float32), label))
        if made:
            yield out()

    weights, total = np.zeros(DIMS), 0
    for r in sorted(dealt.mapInArrow(fit, "n long, at binary, w binary").collect(), key=lambda r: (r.n, bytes(r.w))):
        weights[np.frombuffer(r.at, "<i4")] += r.n * np.frombuffer(r.w, "<f8")
        total += r.n
    return weights / max(total, 1)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``score``, the probability of label 1 by the text
    alone.  Null texts count as empty; null ids stay, repeated rows repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, 1):
            scores = [probability(shared.value, t) for t in texts_of(piece, 1)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
