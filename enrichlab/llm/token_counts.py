"""Token counts of whole texts, without encoding them whole.

Two tiers of pre-token lengths replace the tokenizer in the common case:

* a compact table of frequent pre-tokens and their token counts, broadcast to every worker.  Its
  words are the most frequent ones of a bounded sample of documents (``sample_docs``), at most
  ``table_words`` of them, so its size is bounded whatever the corpus.  It is a cache: what it
  holds changes the speed, never a count;
* a bounded cache in each Python worker for the rest; a miss there is encoded by the
  tokenizer's own model.

Every text is split where it lies, so no pre-token is shuffled; the output is one narrow row per
document.  Null texts count as empty, null ids stay null, repeated rows give repeated rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichlab.llm.common import RecentDict, fast_findall, text_slices, texts_of

SAMPLE_DOCS = 10_000
TABLE_WORDS = 60_000
#: Entries per generation of a worker's cache, and words that a sampling task may return.
CACHE_WORDS = 250_000
TASK_WORDS = 60_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _unassigned() -> re.Pattern:
    """Code points below 2**16 that this Python's Unicode tables do not know."""
    parts, start = [], None
    for c in range(0x10001):
        new = c < 0x10000 and not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn"
        if new and start is None:
            start = c
        elif not new and start is not None:
            parts.append(f"\\u{start:04x}-\\u{c - 1:04x}")
            start = None
    return re.compile(f"[{''.join(parts)}]")


_NEW = _unassigned()
_WIDE = re.compile("[\U00010000-\U0010ffff]")


def newer(text: str) -> bool:
    """Does a text hold code points that a newer Unicode may have given a meaning?"""
    if text.isascii():
        return False
    return bool(_NEW.search(text)) or any(unicodedata.category(c) == "Cn" for c in set(_WIDE.findall(text)))


class Splitter:
    """Texts to pre-tokens and single pre-tokens to token counts, as the tokenizer file says.

    Special strings are cut out of the raw text first and count one token each; the segments
    between are normalised and split on their own.
    """

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_str(spec)
        parts = json.loads(spec)
        added = sorted((t["content"] for t in parts["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        norm = [x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])]
        pre = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        plain = all(not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) for t in parts["added_tokens"])
        if not (norm == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in pre] == ["Split", "ByteLevel"] and plain and pre[0]["invert"] and pre[0]["behavior"] == "Removed"):
            raise ValueError("only tokenizers that lower-case, split by one pattern and map bytes are supported")
        self.find = fast_findall(pre[0]["pattern"]["Regex"])
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def words(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many special strings it holds."""
        if self.special is None or "<" not in text:
            return self._segment(text), 0
        segments = self.special.split(text)
        if len(segments) == 1:
            return self._segment(text), 0
        return [w for s in segments for w in self._segment(s)], len(segments) - 1

    def _segment(self, text: str) -> list[str]:
        if not text.isascii():
            # lower-casing is by character: no special form of the final sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.find(text.lower())

    def whole(self, text: str) -> int:
        """Tokens of a text by the library alone."""
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def length(self, word: str) -> int:
        return len(self.tok.model.tokenize(self.bytes.pre_tokenize_str(word)[0][0]))


_WORKER: dict[str, tuple[Splitter, RecentDict]] = {}


def _worker(key: str, spec: str, table: bytes | None) -> tuple[Splitter, RecentDict]:
    """The splitter and cache of this worker process, made once per broadcast."""
    if key not in _WORKER:
        _WORKER.clear()
        splitter = Splitter(spec)
        frequent: dict[str, int] = {}
        if table:
            words, lengths = table.split(b"\0", 1)
            frequent = dict(zip(words.decode().split("\n"), lengths, strict=True))
        cache = RecentDict(lambda w: frequent.get(w) or splitter.length(w), CACHE_WORDS)
        _WORKER[key] = splitter, cache
    return _WORKER[key]


def frequent_words(docs: DataFrame, spec, text_col: str, sample_docs: int, table_words: int) -> bytes | None:
    """The compact table: newline-joined words, a zero byte, one length byte each (words longer
    than 255 tokens are left to the second tier)."""
    n = docs.count()
    if not n:
        return None

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, seen = Splitter(spec.value), Counter()
        for piece in text_slices(batches, 0):
            for text in texts_of(piece, 0):
                seen.update(splitter.words(text)[0])
            if len(seen) > 4 * TASK_WORDS:
                seen = Counter(dict(seen.most_common(TASK_WORDS)))
        top = [x for x in seen.most_common(TASK_WORDS) if x[1] > 1]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([c for _, c in top], pa.int64())], ["word", "n"])

    sample = docs.select(F.col(text_col).cast("string").alias("text")).sample(min(1.0, sample_docs / n), seed=7)
    rows = sample.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(table_words).collect()
    splitter = Splitter(spec.value)
    sized = [(r.word, k) for r in rows if 0 < (k := splitter.length(r.word)) < 256 and "\n" not in r.word and "\0" not in r.word]
    return "\n".join(w for w, _ in sized).encode() + b"\0" + bytes(k for _, k in sized) if sized else None


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, sample_docs: int = SAMPLE_DOCS, table_words: int = TABLE_WORDS) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes`` (UTF-8) and ``n_tokens``.

    ``docs`` may have any further columns; only the two named are read.  Empty tables give empty
    results, null and empty texts 0 and 0.
    """
    sc = docs.sparkSession.sparkContext
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as f:
        spec = sc.broadcast(f.read())
    table = sc.broadcast(frequent_words(docs, spec, text_col, sample_docs, table_words))
    key = uuid.uuid4().hex
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, lengths = _worker(key, spec.value, table.value)
        for piece in text_slices(batches, 1):
            n_tokens = []
            for text in texts_of(piece, 1):
                if newer(text):  # how these are lower-cased and split, only the library's own tables tell
                    n_tokens.append(splitter.whole(text))
                    continue
                words, specials = splitter.words(text)
                n_tokens.append(specials + sum(map(lengths.__getitem__, words)))
            n_bytes = pc.cast(pc.fill_null(pc.binary_length(piece.column(1)), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column(0), n_bytes, pa.array(n_tokens, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
