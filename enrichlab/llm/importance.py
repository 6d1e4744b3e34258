"""Importance resampling: draw the documents whose hashed n-grams look most like a target's.

**Features** of a text are all runs of one to three consecutive words, joined by one space, hashed to
``buckets`` by CRC-32.  A block of words is hashed at once: its distinct runs are grouped by byte length, each
group is a two-dimensional matrix of bytes, and one table step per column moves the checksums of all its
rows on; the buckets are then scattered back to the occurrences.

**Weights.**  Counts per bucket over all documents and over all target texts give each bucket a gain (a scaled,
floored log ratio); a document's weight is the sum over its features, its score adds a Gumbel number made from
its id, and the highest scores are drawn: sampling without replacement in proportion to the weights.

Two scans of the texts; only narrow rows are ranked, by range buckets, and only those that can be drawn.
The driver holds one number per hash bucket and one per range bucket.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrichlab.llm.common import stored, text_slices
from enrichlab.operators.binning import range_bucket_expr

BUCKETS = 10_000
RUN = 3
#: Words that are hashed together, and bytes of a text that are split into words at a time.
BLOCK_WORDS, BLOCK_BYTES = 120_000, 2 << 20
#: Bytes of one matrix, and rows below which stepping through columns does not pay.
MATRIX_BYTES, FEW_ROWS = 4 << 20, 32

# bytes of words stay, A-Z become a-z, all else is a space: word bytes are 0-9, a-z and those of code points over 0x7F
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_TABLE = _crc_table()


def crc32_columns(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of the strings in ``matrix``, a uint8 array of (byte, string), all of one length."""
    crc = np.full(matrix.shape[1], 0xFFFFFFFF, np.uint32)
    for column in matrix:
        crc = _TABLE[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def crc32_of_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start : start + length]`` for each span, by groups of equal length.  Groups of few rows, where
    a matrix has nothing to share, are taken span by span."""
    out = np.empty(len(start), np.uint32)
    short = len(length) and int(length.max()) < 1 << 16
    order = np.argsort(length.astype(np.uint16) if short else length, kind="stable")  # 16 bits are sorted by radix
    ordered = length[order]
    cuts = [0, *(np.flatnonzero(np.diff(ordered)) + 1).tolist(), len(order)] if len(order) else [0]
    for a, b in zip(cuts, cuts[1:], strict=False):
        n = int(ordered[a])
        if b - a < FEW_ROWS:
            for i in order[a:b].tolist():
                out[i] = zlib.crc32(data[start[i] : start[i] + n])
            continue
        step = max(FEW_ROWS, MATRIX_BYTES // max(n, 1))
        for c in range(a, b, step):
            rows = order[c : min(c + step, b)]
            out[rows] = crc32_columns(data[start[rows][None, :] + np.arange(n)[:, None]])
    return out


def _distinct(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of ``keys`` from 0, and for each code one of the places ``at`` where it occurs."""
    codes, uniques = pd.factorize(keys)
    place = np.empty(len(uniques), np.int64)
    place[codes] = at
    return codes, place


def run_buckets(words: list[bytes], owner: np.ndarray, known: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, owner) of each feature of a block of words that ends after its first ``known`` words."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(b" ".join(words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(sizes + 1) - 1
    start = end - sizes
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    codes, at, many = ids, np.arange(len(words)), len(index)
    firsts, lasts, parts = [], [], []
    for k in range(RUN):
        if k:  # lengthen each run by a word of the same text
            inside = np.flatnonzero(owner[at + k] == owner[at]) if len(at) else at
            keys = codes[inside] * many + ids[at[inside] + k]
            at = at[inside]
            codes, place = _distinct(keys, at)
        else:
            codes, place = _distinct(ids, at)
        firsts.append(place)
        lasts.append(place + k)
        parts.append((codes, at, at + k))
        at, codes = (at[:-1], codes[:-1]) if len(at) and at[-1] + k + 1 >= len(words) else (at, codes)
    a, b = start[np.concatenate(firsts)], end[np.concatenate(lasts)]
    hashed = (crc32_of_spans(data, a, b - a) % np.uint32(buckets)).astype(np.int64)
    found, owners, base = [], [], 0
    for (codes, first, last), places in zip(parts, firsts, strict=True):
        new = last >= known
        found.append(hashed[base + codes[new]])
        owners.append(owner[first[new]])
        base += len(places)
    return np.concatenate(found), np.concatenate(owners)


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    clean, at = text.translate(_CLEAN), 0
    while at < len(clean):
        end = clean.find(b" ", at + BLOCK_BYTES)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def text_features(texts: Iterable[bytes | None], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket, owner, numbers of texts, their words) for blocks of about ``BLOCK_WORDS`` words; a
    long text goes through several blocks, each starting with the last words of the one before."""
    words: list[bytes] = []
    numbers: list[int] = []
    counts: list[int] = []
    known = 0

    def block():
        owner = np.repeat(np.array(numbers, np.int64), counts)
        new = np.array(counts, np.int64)
        if len(new):
            new[0] -= known
        return (*run_buckets(words, owner, known, buckets), np.array(numbers, np.int64), new)

    for i, text in enumerate(texts):
        numbers.append(i)
        counts.append(0)
        for part in _word_blocks(text or b""):
            words += part
            counts[-1] += len(part)
            if len(words) >= BLOCK_WORDS:
                yield block()
                known = min(RUN - 1, counts[-1])
                words, numbers, counts = words[len(words) - known :], [i], [known]
    yield block()


def _binary(piece: pa.RecordBatch, column: int) -> list[bytes | None]:
    return piece.column(column).cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of a column of texts fall in each bucket; every task adds up its own first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for piece in text_slices(batches, 0):
            for found, *_ in text_features(_binary(piece, 0), buckets):
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` for each of the ``B`` buckets."""
    whole, aim, b = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (whole + b) / ((s + 1.0) * (aim + b)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight) of ``docs`` (id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for piece in text_slices(batches, 1):
            n = piece.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for found, owner, numbers, new in text_features(_binary(piece, 1), len(table)):
                np.add.at(words, numbers, new)
                features += np.bincount(owner, minlength=n)
                weight += np.bincount(owner, table[found], minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column(0), *map(pa.array, (words, features, weight))], ["id", "n_words", "n_features", "weight"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def gumbel_number(name: Column, seed: str) -> Column:
    """``floor(-1000 ln(-ln((h + 0.5) / 2^32)))``, h from the first 8 hex digits of ``sha256(seed:name)``."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = 5, min_words: int = 20, buckets: int = BUCKETS, seed: str = "42") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (1, 2, 3 for the
    highest scores, ties to the smaller id; null if not drawn).  Of the documents with at
    least ``min_words`` words, ``floor(percent * N / 100)`` are drawn.

    Null texts have no words.  A null id counts as an empty name and comes first among equal scores.  Repeated rows are
    ranked one after the other.  An empty target leaves gains that only follow ``docs``; an empty ``docs`` gives an empty result.
    """
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    gains = bucket_gains(bucket_counts(frame.select("text"), buckets), bucket_counts(target.select(F.col(target_col).cast("string").alias("text")), buckets))
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    scored = stored(weigh(frame, gains).withColumn("score", F.col("weight") + gumbel_number(name, seed)), "scores")
    return draw(scored, F.col("n_words") >= min_words, percent).withColumnRenamed("id", id_col)


def draw(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` (a stored table with id and score) with the ``rank`` of the drawn rows."""
    order = ["_neg", "id", "weight", "n_features"]
    rows = scored.withColumn("_neg", -F.col("score"))
    fit = rows.filter(eligible)
    fit = fit.withColumn("_bucket", range_bucket_expr(fit, order))
    held = dict(fit.groupBy("_bucket").agg(F.count("*")).collect())  # one row per range bucket
    wanted, before, starts = percent * sum(held.values()) // 100, 0, {}
    for b in sorted(held):
        if before < wanted:
            starts[b] = before
        before += held[b]
    last = max(starts, default=-1)
    offsets = F.array(*[F.lit(starts.get(b, 0)).cast("long") for b in range(last + 1)] or [F.lit(0).cast("long")])
    at = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)) + F.element_at(offsets, F.col("_bucket") + 1)
    near = fit.filter(F.col("_bucket") <= last).withColumn("rank", F.when(at <= wanted, at))
    far = fit.filter(F.col("_bucket") > last).unionByName(rows.filter(~F.coalesce(eligible, F.lit(False))).withColumn("_bucket", F.lit(0)))
    return near.unionByName(far.withColumn("rank", F.lit(None).cast("long"))).drop("_neg", "_bucket")
