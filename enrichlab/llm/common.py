"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichlab.session import forget_at_exit

#: Text bytes that a task turns into Python strings at a time.
SLICE_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the test data: a Parquet file or folder."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_bucket(col: str, n: int) -> Column:
    """``crc32(col as text) mod n``; null for null."""
    return F.crc32(F.col(col).cast("string")) % F.lit(n)


def text_slices(batches: Iterable[pa.RecordBatch], text: int | str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in pieces of about ``size`` text bytes (one row at least),
    so that memory follows the longest text and not the batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(lengths.astype(np.int64)) // size
        starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            yield batch.slice(a, b - a)
        _give_back()


def _give_back() -> None:
    """Free memory of this worker goes back to the machine, so that workers that live through several
    operators do not add up their peaks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def texts_of(batch: pa.RecordBatch, column: int | str) -> list[str]:
    """Texts of a column, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


class RecentDict(dict):
    """A cache of at most ``2 * bound`` entries: two generations, the older one dropped when the
    younger is full.  ``compute(key)`` fills misses."""

    def __init__(self, compute, bound: int) -> None:
        super().__init__()
        self.compute, self.bound, self.old = compute, bound, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.bound:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _ranges(unicode_class: str) -> str:
    """The code points below 2**16 of a Unicode class, as the inside of a plain character class."""
    import regex

    whole = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    out = []
    for m in regex.finditer(unicode_class + "+", whole):
        first, last = m.group()[0], m.group()[-1]
        # a run may jump the surrogate gap, which no text can hold
        out.append(re.escape(first) + ("-" + re.escape(last) if first != last else ""))
    return "".join(out)


def fast_findall(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of a pattern that uses ``\\p{L}``, ``\\p{N}``, ``\\s`` and ``\\S``.

    The classes are written as explicit ranges for the standard ``re`` module: same matches, about
    twice as fast.  That holds below code point 2**16 (a bitmap lookup); texts with
    characters beyond go to the ``regex`` module.
    """
    import regex

    known = {c: _ranges(c) for c in (r"\p{L}", r"\p{N}", r"\s")}
    out, inside, i = [], False, 0
    while i < len(pattern):
        token = next((c for c in known if pattern.startswith(c, i)), None)
        if token:
            out.append(known[token] if inside else f"[{known[token]}]")
            i += len(token)
        elif pattern.startswith(r"\S", i) and not inside:
            out.append(f"[^{known[chr(92) + 's']}]")
            i += 2
        elif pattern[i] == "\\":
            out.append(pattern[i : i + 2])
            i += 2
        else:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
            out.append(pattern[i])
            i += 1
    narrow, wide = re.compile("".join(out)).findall, regex.compile(pattern).findall

    def find(text: str) -> list[str]:
        if text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text):
            return narrow(text)
        return wide(text)

    return find


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective): neighbouring inputs give unrelated outputs."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_hash(word: str) -> int:
    """A 64-bit hash of a word that is the same in every process."""
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


_HASHES = RecentDict(word_hash, 80_000)


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of every window of ``k`` word hashes, in order; empty when there are fewer words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mix64(h)


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a scratch one only where none is set
    (local sessions and tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-work-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: computed once, lineage cut,
    nothing lost with an executor.  The folder goes when the application ends."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    forget_at_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def let_go(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` or ``bounded_side`` wrote and nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(df.stored_at)
        folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Bytes of a side that may be broadcast.
BROADCAST_BYTES = 48 << 20


def bounded_side(rows: DataFrame, size: Column | int = 48) -> DataFrame:
    """``rows`` stored and measured: with a broadcast hint if their sizes (bytes a row, an upper estimate) add up to
    at most ``BROADCAST_BYTES``, else to be joined by shuffle."""
    rows = stored(rows, "side")
    size = F.lit(size) if isinstance(size, int) else size
    total = rows.agg(F.sum(size.cast("long"))).first()[0] or 0
    side = F.broadcast(rows) if total <= BROADCAST_BYTES else rows
    side.stored_at = rows.stored_at
    return side
