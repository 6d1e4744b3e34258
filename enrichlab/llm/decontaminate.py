"""Benchmark decontamination: SimHash of item-sized windows, a multi-index on Hamming blocks, exact
verification.

Every benchmark item has a 64-bit SimHash of its shingles (five words, weighted by how often they
occur).  A document's words are read through windows of an item's size; the SimHash of a window comes
from running sums of its shingles' signs.  Fingerprints are compared through ``BLOCKS`` blocks of 8 bits:
two that differ in at most ``RADIUS`` bits agree in some block up to ``RADIUS // BLOCKS`` bits, so looking
each block up in a table of its near values finds all of them.  Windows within the radius are verified by
the exact weighted Jaccard similarity of their shingles with the item's.

A window without any shingle of an item has similarity 0, so an exact look-up of shingles chooses the windows that are
fingerprinted, and the multi-index chooses the items that each of them is compared with.  Fingerprints of windows at similarity 0.8 differ in about 10 bits; ``RADIUS`` lies
more than four deviations above.

The items are broadcast in blocks of at most ``block_shingles`` shingles (one pass over the documents
each), so what is broadcast is bounded however large the benchmark is; documents are never shuffled.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrichlab.llm.common import shingle_hashes, text_slices, texts_of, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 8
RADIUS = 23
BLOCK_SHINGLES = 2_000_000
#: What an item counts in a block besides its text: a block has at most 10,000 items, its tables 20 MB.
ITEM_SIZE = 200
#: Windows that are compared at a time.
WINDOWS = 4096
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NEAR = np.array([[bin(a ^ b).count("1") <= RADIUS // BLOCKS for b in range(256)] for a in range(256)])
_ONES = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each hash."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints (rows of 8 bytes) of rows of 64 sums."""
    return np.packbits(sums > 0, axis=1)


class Items:
    """A block of benchmark items of one process: by size, their fingerprints, block tables and
    shingle counts."""

    def __init__(self, items: list[tuple]) -> None:
        self.by_size: dict[tuple[int, int], dict] = {}
        sizes: dict[int, list] = {}
        for item_id, text in items:
            words = WORD.findall(text or "")
            if words:
                k = min(SHINGLE, len(words))
                h = shingle_hashes(word_hashes(words), k)
                sizes.setdefault(len(words), []).append((item_id, h, k))
        shingle_sizes: dict[int, list] = {}
        for size, group in sizes.items():
            finger = np.concatenate([_pack(_signs(h).sum(axis=0, keepdims=True)) for _, h, _ in group])
            # near[b][value, item]: block b of the item is within reach of the value
            near = [_NEAR[:, finger[:, b]] for b in range(BLOCKS)]
            self.by_size[size] = {"ids": [g[0] for g in group], "finger": finger, "near": near, "counts": [Counter(g[1].tolist()) for g in group], "k": group[0][2]}
            for _, h, k in group:
                shingle_sizes.setdefault(k, []).append((h, np.full(len(h), size)))
        #: by shingle length: all shingles in order with the item sizes they occur in, and a bit filter
        self.shingles = {}
        for k, parts in shingle_sizes.items():
            h, size = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.lexsort((size, h))
            h, size = h[order], size[order]
            first = np.concatenate([[True], (h[1:] != h[:-1]) | (size[1:] != size[:-1])])
            h, size = h[first], size[first]
            maybe = np.zeros(1 << 22, bool)
            maybe[h >> np.uint64(42)] = True
            self.shingles[k] = h, size, maybe

    def find(self, text: str) -> list[tuple]:
        """``(item_id, start_word, n_words, similarity, bits)`` for every item that some window of the
        text is similar to: its most similar window, the first of them; bits is the distance of
        the fingerprints."""
        words = WORD.findall(text)
        if not words:
            return []
        out, hashed = [], word_hashes(words)
        for k, (known, size_of, maybe) in self.shingles.items():
            h = shingle_hashes(hashed, k)
            if not len(h):
                continue
            at = np.flatnonzero(maybe[h >> np.uint64(42)])
            lo, hi = np.searchsorted(known, h[at], "left"), np.searchsorted(known, h[at], "right")
            starts: dict[int, list[int]] = {}
            for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                for size in size_of[a:b].tolist():
                    starts.setdefault(size, []).append(p)
            for size, hits in sorted(starts.items()):
                out += self._windows(h, len(words), size, np.array(hits), k)
        return out

    def _windows(self, h: np.ndarray, n_words: int, size: int, hits: np.ndarray, k: int) -> list[tuple]:
        group, s = self.by_size[size], min(size, n_words) - k + 1  # shingles of a window
        last = len(h) - s  # a text shorter than the item is one window
        # all windows that hold a hit
        edge = np.zeros(len(h) + 2, np.int64)
        np.add.at(edge, np.maximum(hits - s + 1, 0), 1)
        np.add.at(edge, np.minimum(hits, last) + 1, -1)
        where = np.flatnonzero(np.cumsum(edge)[: last + 1] > 0)
        best: dict[int, tuple] = {}
        for a in range(0, len(where), WINDOWS):
            run = where[a : a + WINDOWS]
            for part in np.split(run, np.flatnonzero(np.diff(run) > s) + 1):
                base = part[0]
                sums = np.cumsum(np.concatenate([np.zeros((1, 64), np.int32), _signs(h[base : part[-1] + s])]), axis=0)
                finger = _pack(sums[part - base + s] - sums[part - base])
                reach = np.zeros((len(part), len(group["ids"])), bool)
                for b in range(BLOCKS):
                    reach |= group["near"][b][finger[:, b]]
                for i, j in zip(*np.nonzero(reach), strict=True):
                    bits = int(_ONES[finger[i] ^ group["finger"][j]].sum())
                    if bits > RADIUS:
                        continue
                    start, want = int(part[i]), group["counts"][j]
                    both = sum(min(n, want[x]) for x, n in Counter(h[start : start + s].tolist()).items() if x in want)
                    alike = both / (s + sum(want.values()) - both)
                    if alike >= SIMILARITY and (j not in best or alike > best[j][3]):
                        best[j] = group["ids"][j], start, min(size, n_words), alike, bits
        return [best[j] for j in sorted(best)]


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_shingles: int) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size, each text once, by the least id that has it."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")).filter("item is not null and text is not null")
    items = items.groupBy("item", "text").count().select("item", "text", (F.length("text") / 2 + ITEM_SIZE).cast("long").alias("size"))
    total = items.agg(F.sum("size")).first()[0] or 0
    blocks = int(total // block_shingles) + 1
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).orderBy("item", "text").collect()
        if rows or b == 0:
            yield [(r.item, r.text) for r in rows]


_MADE: dict[int, tuple] = {}


def _made(shared) -> Items:
    """The items of a broadcast, prepared once per worker process."""
    if id(shared.value) not in _MADE:
        _MADE.clear()
        _MADE[id(shared.value)] = shared.value, Items(shared.value)
    return _MADE[id(shared.value)][1]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document row and item that a window of the text is similar to: the id,
    ``item_id``, ``start_word`` and ``n_words`` of its most similar window, ``similarity`` (0.8 or
    more) and ``bits``, the distance of the fingerprints.

    Windows have the item's number of words; a shorter text is one window.  Items or texts that are
    null or have no word match nothing; items of under five words are one shingle.  Null document ids
    stay; repeated documents repeat their rows.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()

    def pass_over(items: list[tuple]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(items)
        item_type = pa.string() if item_kind == "string" else pa.int64() if item_kind == "bigint" else pa.int32() if item_kind == "int" else None

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _made(shared)
            for piece in text_slices(batches, 1):
                rows = [(i, m) for i, t in enumerate(texts_of(piece, 1)) for m in found.find(t)]
                columns = list(zip(*(m for _, m in rows), strict=True)) if rows else [()] * 5
                kinds = (item_type, pa.int64(), pa.int64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array([i for i, _ in rows], pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["id", "item_id", "start_word", "n_words", "similarity", "bits"])

        return narrow.mapInArrow(run, f"id {kind}, item_id {item_kind}, start_word long, n_words long, similarity double, bits long")

    passes = [pass_over(items) for items in _item_blocks(benchmark, item_col, item_text_col, block_shingles)]
    return functools.reduce(DataFrame.unionByName, passes).withColumnRenamed("id", id_col)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs`` without any window similar to an item, with all their columns.  Rows with a null or empty text or a
    null id stay, repeated rows are judged alike, an empty ``docs`` or ``benchmark`` changes nothing."""
    at = docs.columns.index(text_col)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    for items in _item_blocks(benchmark, item_col, item_text_col, block_shingles):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = _made(shared)
            for piece in text_slices(batches, at):
                yield piece.filter(pa.array([not found.find(t) for t in texts_of(piece, at)], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
