"""Quality rules: base counts of a text and its divergence from language references.

A reference describes one language by two distributions over the whole corpus: character classes
and the ``common`` most widespread words (plus one bin for all others).  A document is compared
with every reference by Jensen-Shannon distance; it is rejected when its nearest reference is
still too far by characters, or by common words and somewhat by characters too.  Short texts give unreliable histograms, so each
test asks for a minimum length and passes below it.

References are counted over all documents.  Every document has the same weight in them (its
histogram is scaled to a fixed total of integers, so sums do not depend on the order of tasks), and a
word counts once per document; neither long nor repetitive documents nor a hot source can shift
them by their length.  Word counts are combined in each task before the one shuffle; what reaches
the driver is ``common`` words and one class histogram per language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrichlab.llm.common import text_slices, texts_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "sentence", "quote", "symbol", "other")
#: Parts into which a document's character histogram is scaled.
PARTS = 1_000_000
#: Words that a task gathers before it hands its partial counts on.
TASK_WORDS = 200_000


@dataclass(frozen=True)
class Limits:
    """A text is rejected when its character distance is above ``max_char_distance``, or when both
    its word distance and its character distance are above ``max_word_distance`` and
    ``odd_char_distance``.  ``min_chars`` and ``min_words`` are the lengths from which the
    character and the word test apply."""

    max_char_distance: float = 0.34
    odd_char_distance: float = 0.14
    max_word_distance: float = 0.39
    min_chars: int = 200
    min_words: int = 100
    min_base_words: int = 10
    max_repeat_percent: int = 20
    common: int = 100


def _class_table() -> np.ndarray:
    """Class of every code point below 2**16."""
    table = np.full(0x10000, CLASSES.index("other"), np.uint8)
    for c in range(0x10000):
        ch = chr(c)
        if ch.islower():
            table[c] = 0
        elif ch.isupper():
            table[c] = 1
        elif ch.isdigit():
            table[c] = 2
        elif ch.isspace():
            table[c] = 3
        elif ch.isalpha():  # letters without case
            table[c] = 0
    for name, chars in (("sentence", ".,;:!?-"), ("quote", "\"'()[]«»“”‘’"), ("symbol", SYMBOLS)):
        table[[ord(c) for c in chars]] = CLASSES.index(name)
    return table


_TABLE: list[np.ndarray] = []


def class_counts(text: str) -> np.ndarray:
    """How many characters of each class a text has."""
    if not _TABLE:
        _TABLE.append(_class_table())
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.bincount(_TABLE[0][np.minimum(points, 0xFFFF)], minlength=len(CLASSES))


def plain_words(text: str) -> list[str]:
    """Words in lower case without the punctuation around them."""
    return [w for x in WORD.findall(text.lower()) if (w := x.strip(".,;:!?\"'()"))]


def repeat_words(words: list[str], k: int = 5) -> int:
    """Words that lie in a window of ``k`` words which occurs twice or more (the first included)."""
    n = len(words) - k + 1
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, len(words))
    # exact window numbers: join one word at a time and renumber
    window = ids[:n]
    for i in range(1, k):
        _, window = np.unique(window * np.uint64(len(numbers)) + ids[i : i + n], return_inverse=True)
        window = window.astype(np.uint64)
    twice = np.bincount(window.astype(np.int64))[window.astype(np.int64)] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + k, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, repeated words."""
    words = WORD.findall(text)
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
        elif WORD.search(line):
            seen.add(line)
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup_lines, repeat_words(words)


def distances(p: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (square root of the divergence in bits) to each row of
    ``references``; all are distributions."""
    mean = (p + references) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / mean), 0).sum(axis=1)
        b = np.where(references > 0, references * np.log2(references / mean), 0).sum(axis=1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def language_references(docs: DataFrame, text_col: str, lang_col: str, common: int) -> list[dict]:
    """One dict per language: class shares, common words, and their shares of all words.

    Languages come from ``lang_col`` (null: ``und``).  A language that holds under a thousandth
    of the documents tells too little and gives no reference unless no other does.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, dict[str, int]] = {}  # documents in the upper bits, occurrences in the lower 40
        parts: dict[str, np.ndarray] = {}

        def out(rows: list[tuple]) -> pa.RecordBatch:
            lang, word, n, total = zip(*rows, strict=True) if rows else ([], [], [], [])
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64()), pa.array(total, pa.int64())], ["lang", "word", "n", "total"])

        def partial() -> list[tuple]:
            return [(lang, w, v >> 40, v & (1 << 40) - 1) for lang, c in words.items() for w, v in c.items()]

        for piece in text_slices(batches, 0):
            for text, lang in zip(texts_of(piece, 0), piece.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                lang = lang or "und"
                c = class_counts(text)
                parts[lang] = parts.get(lang, 0) + np.append(c * PARTS // c.sum(), 1)
                seen = words.setdefault(lang, {})
                for w, k in Counter(plain_words(text)).items():
                    seen[w] = seen.get(w, 0) + (1 << 40) + k
            if sum(map(len, words.values())) > TASK_WORDS:
                yield out(partial())
                words.clear()
        yield out(partial())
        # class sums travel as words that no text can hold
        yield out([(lang, f" {i}", int(v), 0) for lang, row in parts.items() for i, v in enumerate(row)])

    counted = (
        docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
        .mapInArrow(count, "lang string, word string, n long, total long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    return _collect(counted, common)


def _collect(counted: DataFrame, common: int) -> list[dict]:
    from enrichlab.llm.common import stored

    counted = stored(counted, "quality-words")
    # at most a thousand languages hold a thousandth of the documents: nothing of the others leaves the cluster
    docs = counted.filter(F.col("word") == f" {len(CLASSES)}").select("lang", "n")
    whole = docs.agg(F.sum("n")).first()[0] or 0
    enough = sorted(r.lang for r in docs.filter(F.col("n") * 1000 >= whole).collect())
    kept = counted.filter(F.col("lang").isin(enough))
    classes: dict[str, dict[int, int]] = {}
    for r in kept.filter(F.col("word").startswith(" ")).collect():
        classes.setdefault(r.lang, {})[int(r.word)] = r.n
    words = kept.filter(~F.col("word").startswith(" "))
    totals = {r.lang: r.total for r in words.groupBy("lang").agg(F.sum("total").alias("total")).collect()}
    top: dict[str, list] = {}
    for lang in enough:  # a top-k each: partial in every task, never a sort of all words
        rows = words.filter(F.col("lang") == lang).orderBy(F.desc("n"), "word").limit(common).collect()
        top[lang] = [(r.word, r.total) for r in rows]
    out = []
    for lang in enough:
        shares = np.array([classes[lang].get(i, 0) for i in range(len(CLASSES))], float)
        listed = np.array([t for _, t in top[lang]], float)
        whole = max(totals.get(lang, 0), 1)
        out.append({"lang": lang, "classes": (shares / shares.sum()).tolist(), "words": [w for w, _ in top[lang]], "shares": [*(listed / whole).tolist(), 1 - listed.sum() / whole]})
    return out


class Judge:
    """Measures and verdict of one text against the references."""

    def __init__(self, references: list[dict], limits: Limits) -> None:
        self.limits = limits
        self.classes = np.array([r["classes"] for r in references]).reshape(len(references), len(CLASSES))
        self.words = [({w: i for i, w in enumerate(r["words"])}, np.array(r["shares"])[None, :]) for r in references]

    def verdict(self, text: str) -> tuple:
        lim = self.limits
        n_words, word_chars, n_symbols, dup_lines, repeated = base_counts(text)
        failed = n_words < lim.min_base_words or 100 * repeated > lim.max_repeat_percent * n_words
        by_char = by_word = None
        if self.words and len(text) >= lim.min_chars:
            c = class_counts(text)
            by_char = float(distances(c / c.sum(), self.classes).min())
        if self.words and n_words >= lim.min_words and (words := plain_words(text)):
            counts, best = Counter(words), []
            for index, shares in self.words:
                p = np.zeros(shares.shape[1])
                for w in counts.keys() & index.keys():
                    p[index[w]] = counts[w]
                p[-1] = len(words) - p.sum()
                best.append(float(distances(p / len(words), shares)[0]))
            by_word = min(best)
        far = (by_char or 0) > lim.max_char_distance
        far = far or (by_word or 0) > lim.max_word_distance and (by_char or 0) > lim.odd_char_distance
        kept = not (failed or far)
        return n_words, word_chars, n_symbols, dup_lines, repeated, failed, by_char, by_word, kept


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, char_distance double, word_distance double, kept boolean"


def measure_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """One row per row of ``docs``: the id, the base counts, ``base_failed``, the distances to the
    nearest reference (null where a text is too short for the test) and ``kept``.

    Null texts count as empty (no words, so base_failed); null ids stay; repeated rows repeat; an
    empty table gives an empty result.  Only the three named columns are read.
    """
    references = docs.sparkSession.sparkContext.broadcast(language_references(docs, text_col, lang_col, limits.common))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["id", *(x.split()[0] for x in MEASURES.split(", "))]
    kinds = [{"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[x.split()[1]] for x in MEASURES.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(references.value, limits)
        for piece in text_slices(batches, 1):
            columns = zip(*map(judge.verdict, texts_of(piece, 1)), strict=True)
            yield pa.RecordBatch.from_arrays([piece.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, {MEASURES}").withColumnRenamed("id", id_col)


def keep_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` that the rules keep, with all their columns.  Null texts count as empty and go (no words); null ids and
    repeated rows stay as they are; an empty table gives an empty result."""
    references = docs.sparkSession.sparkContext.broadcast(language_references(docs, text_col, lang_col, limits.common))
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(references.value, limits)
        for piece in text_slices(batches, at):
            yield piece.filter(pa.array([judge.verdict(t)[-1] for t in texts_of(piece, at)], pa.bool_()))

    return docs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema]))
