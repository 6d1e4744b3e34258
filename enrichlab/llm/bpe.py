"""Byte-level BPE by corpus-level merge replay, and decoding.

A task gathers the distinct pre-tokens of a block of texts that it has not met before, lays all
their bytes out as one linked list of symbols (``REPLAY_WORDS`` at a time), and keeps an inverted index from merge rank to the
positions whose pair has that rank.  Merges are then replayed over the whole block in rank
order; each one touches only the listed positions and their two neighbours, whose new pairs go into
the index.  The ids of a pre-token are kept in a bounded worker cache, and a text's ids are the
concatenation over its pre-tokens.

Blocks are cut by bytes within a partition, so nothing is shuffled, no task holds more than a
block and its caches, and a lost task recomputes its own partition only.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichlab.llm.common import fast_findall, text_slices, texts_of

#: Pre-tokens kept per generation of a worker's cache.
CACHE_WORDS = 160_000
#: Pre-tokens whose merges are replayed at a time, and characters of them (one pre-token at least).
REPLAY_WORDS, REPLAY_CHARS = 25_000, 1 << 19
#: Bytes beyond which a block, one very long pre-token, is kept in packed arrays: slower, a fifth of the memory.
LONG_BLOCK = 1 << 20


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank from a rank file (``base64 rank`` lines)."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def _ints(values=b"") -> array:
    """32-bit integers, from their bytes or any numbers."""
    out = array("i")
    out.frombytes(values) if isinstance(values, bytes) else out.extend(values)
    return out


class MergeReplay:
    """Encodes blocks of byte strings with one rank table."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.byte_pairs = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int64)
        #: left id * n + right id -> id of the joined token, for every split of every token
        self.n = len(self.tokens)
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    self.pairs[a * self.n + b] = rank

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as packed little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        todo = []
        for i, w in enumerate(words):
            rank = self.ranks.get(w)
            if rank is None:
                todo.append(i)
            else:  # a whole token is one id without any merge
                out[i] = rank.to_bytes(4, "little")
        if not todo:
            return out
        pairs, n = self.pairs, self.n
        # symbol at each position (-1 between words; a merged-away position is stepped over)
        raw = np.frombuffer(b"\0".join([words[i] for i in todo]) + b"\0", np.uint8)
        size = len(raw)
        small = size <= LONG_BLOCK
        ends = np.cumsum([len(words[i]) + 1 for i in todo]) - 1
        symbols = self.byte_ids[raw].astype(np.int32)
        symbols[ends] = -1
        starts = np.concatenate([[0], ends[:-1] + 1])
        pair = np.full(size, -1, np.int32)
        pair[:-1] = self.byte_pairs[raw[:-1], raw[1:]]
        pair[ends] = -1
        pair[ends - 1] = -1
        order = np.argsort(pair, kind="stable").astype(np.int32)
        order = order[np.searchsorted(pair[order], 0) :]
        ranked = pair[order]
        cuts = np.flatnonzero(np.diff(ranked)) + 1
        index = {int(r): x.tolist() if small else _ints(x.tobytes()) for r, x in zip(ranked[np.concatenate([[0], cuts])], np.split(order, cuts), strict=True)} if len(ranked) else {}
        # rank_at: rank of the pair that starts here; right, left: next and previous live position
        held = list if small else _ints
        ids, rank_at = (x.tolist() if small else _ints(x.tobytes()) for x in (symbols, pair))
        right, left, gone = held(range(1, size + 1)), held(range(-1, size - 1)), held()
        del symbols, pair, order, ranked
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            places = index.pop(r, None)
            if places is None:
                continue
            places = sorted(places)
            base = r * n
            for k, p in enumerate(places):
                if rank_at[p] != r:
                    continue  # a neighbour's merge took this pair
                q = right[p]
                ids[p] = r
                rank_at[q] = -1
                gone.append(q)
                s = right[p] = right[q]
                left[s] = p
                again = False
                rank_at[p] = -1
                if (b := ids[s]) >= 0 and (x := pairs.get(base + b)) is not None:
                    rank_at[p] = x
                    again = x < r
                    if x in index:
                        index[x].append(p)
                    else:
                        index[x] = [p] if small else _ints((p,))
                        heapq.heappush(heap, x)
                o = left[p]
                if o >= 0 and (b := ids[o]) >= 0:
                    if (x := pairs.get(b * n + r)) is None:
                        rank_at[o] = -1
                    else:
                        rank_at[o] = x
                        again = again or x < r
                        if x in index:
                            index[x].append(o)
                        else:
                            index[x] = [o] if small else _ints((o,))
                            heapq.heappush(heap, x)
                if again and places[k + 1 :]:  # an earlier merge became possible: it goes first
                    index.setdefault(r, []).extend(places[k + 1 :])
                    heapq.heappush(heap, r)
                    break
        live = np.array(ids, np.int32)
        keep = live >= 0
        keep[np.array(gone, np.int64)] = False
        before = np.concatenate([[0], np.cumsum(keep)])
        packed = live[keep].astype("<u4").tobytes()
        for i, a, b in zip(todo, before[starts].tolist(), before[ends].tolist(), strict=True):
            out[i] = packed[4 * a : 4 * b]
        return out

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


class TextCodec:
    """Whole texts to packed ids and back, with a cache of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, bound: int = CACHE_WORDS) -> None:
        self.replay = MergeReplay(ranks)
        self.find = fast_findall(pattern)
        self.known: dict[str, bytes] = {}
        self.bound = bound

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [self.find(t) for t in texts]
        new = list(set().union(*words).difference(self.known)) if words else []
        if len(self.known) + len(new) > self.bound:
            used = set().union(*words)
            # the newer half stays beside what this block needs
            recent = list(self.known)[-self.bound // 2 :]
            self.known = {w: self.known[w] for w in {*recent, *(used & self.known.keys())}}
        part, size = [], 0
        for i, w in enumerate(new):
            part.append(w)
            size += len(w)
            if len(part) >= REPLAY_WORDS or size >= REPLAY_CHARS or i + 1 == len(new):
                self.known.update(zip(part, self.replay.encode([x.encode() for x in part]), strict=True))
                part, size = [], 0
        get = self.known.__getitem__
        return [b"".join(map(get, w)) for w in words]

    def decode(self, packed: bytes) -> bytes:
        return self.replay.decode(packed)


_WORKER: dict[str, TextCodec] = {}


def _codec(key: str, ranks: bytes, pattern: str) -> TextCodec:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = TextCodec(load_ranks(ranks), pattern)
    return _WORKER[key]


def _inputs(df: DataFrame, ranks_path: str | None, pattern: str):
    """The rank file, broadcast, and a key of its content: workers keep one codec for all calls."""
    with open(ranks_path or default_ranks(), "rb") as f:
        data = f.read()
    return df.sparkSession.sparkContext.broadcast(data), xxhash.xxh3_128_hexdigest(data + pattern.encode())


def _kind(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per row of ``docs``: the id and ``ids``, the token ids packed as little-endian
    unsigned 32-bit integers (binary).

    Only the two named columns are read; a null text is an empty one, null ids stay, repeated
    rows repeat, an empty table gives an empty result.
    """
    pattern = pattern or default_pattern()
    ranks, key = _inputs(docs, ranks_path, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, ranks.value, pattern)
        for piece in text_slices(batches, 1):
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(codec.encode(texts_of(piece, 1)), pa.binary())], ["id", "ids"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {_kind(narrow, 'id')}, ids binary").withColumnRenamed("id", id_col)


def decode_ids(encoded: DataFrame, ids_col: str = "ids", out_col: str = "decoded", ranks_path: str | None = None) -> DataFrame:
    """``encoded`` with its packed ids replaced by the decoded bytes (``out_col``, binary; null
    ids decode to null); all other columns stay."""
    pattern = default_pattern()
    ranks, key = _inputs(encoded, ranks_path, pattern)
    others = [c for c in encoded.columns if c != ids_col]
    frame = encoded.select(*others, ids_col)
    schema = frame.drop(ids_col).schema.add(out_col, "binary")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, ranks.value, pattern)
        for piece in text_slices(batches, len(others)):
            done = [None if x is None else codec.decode(x) for x in piece.column(len(others)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(done, pa.binary())], [*others, out_col])

    return frame.mapInArrow(run, schema)


def encode_and_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encode_texts`` and ``decode_ids`` in one pass: the id, ``ids`` and ``decoded``, both binary.  Null texts are
    empty, null ids stay, repeated rows repeat, an empty table gives an empty result; a very long text without
    blanks is one pre-token, whose merges take about 60 bytes of memory a byte."""
    pattern = pattern or default_pattern()
    ranks, key = _inputs(docs, ranks_path, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, ranks.value, pattern)
        for piece in text_slices(batches, 1):
            ids = codec.encode(texts_of(piece, 1))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.binary())], ["id", "ids", "decoded"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {_kind(narrow, 'id')}, ids binary, decoded binary").withColumnRenamed("id", id_col)
