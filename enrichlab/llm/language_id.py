"""Language identification by error-correcting output codes.

Every learned language has a codeword of bits; one binary n-gram classifier predicts each bit from
the character 1- to 3-grams of a text (lower case, everything but letters as one blank).  A bit's
classifier is a table of log-likelihood ratios between the languages whose bit is set and the
others, learned from n-gram counts over all training documents.  Decoding sums, over the bits, the
logistic loss of the classifier's margin against each codeword, weighted by how often that
bit was right for that language on a bounded sample of training documents (``weigh_docs``), and takes
the codeword of least loss.  A small gap to the second one flags the text as ambiguous.

N-grams are hashed into ``DIMS`` counters, summed in each task before the shuffle; what reaches the
driver and is broadcast is ``DIMS`` numbers per language and bit.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichlab.llm.common import text_slices, texts_of

DIMS = 1 << 15
WEIGH_DOCS = 20_000
#: Languages that a model learns at most.
MAX_LANGS = 256
#: Margins are mean log-likelihood ratios per n-gram times this.
SHARPNESS = 8.0
#: Texts whose two best scores are closer than this are ambiguous.
AMBIGUOUS_GAP = 0.2
_SEEDS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_LETTERS: list[np.ndarray] = []


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, with 32 for all that is no letter."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x10000)]))
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    plain = _LETTERS[0][np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points > 0xFFFF)
    if len(far):
        plain[far] = [chr(c).isalpha() for c in points[far].tolist()]
    return np.where(plain, points, np.uint32(32))


def ngram_buckets(text: str) -> np.ndarray:
    """Hash bucket of every character 1-, 2- and 3-gram that has a letter; empty without letters."""
    points = _letters(text)
    solid = points != 32
    if not solid.any():
        return np.empty(0, np.int64)
    points = np.concatenate([[32], points, [32]]).astype(np.uint64)
    solid = np.concatenate([[False], solid, [False]])
    out = []
    h, any_letter = np.zeros(len(points), np.uint64), np.zeros(len(points), bool)
    for k in range(3):
        n = len(points) - k
        h = (h[:n] + points[k:]) * np.uint64(_SEEDS[k] | 1)
        any_letter = any_letter[:n] | solid[k:]
        g = h[any_letter]
        out.append(((g ^ (g >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15))
    return np.concatenate(out).astype(np.int64)


def codewords(k: int) -> np.ndarray:
    """``k`` rows of +1/-1 bits: the exhaustive code up to 7 classes, else the best of seeded random
    codes by smallest distance between rows (columns that do not split the classes left out)."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 7:
        columns = [(1, *x) for x in itertools.product((1, -1), repeat=k - 1) if -1 in x]
        return np.array(columns, float).T
    rng, bits = np.random.default_rng(k), max(15, math.ceil(10 * math.log2(k)))
    best, best_gap = None, -1
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], (k, bits))
        m = m[:, np.abs(m.sum(axis=0)) < k]
        gap = min(int((a != b).sum()) for a, b in itertools.combinations(m, 2))
        if gap > best_gap:
            best, best_gap = m, gap
    return best


@dataclass
class LanguageModel:
    langs: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    table: np.ndarray  # DIMS x bits, log-likelihood ratios
    weights: np.ndarray  # languages x bits, rows sum to 1

    def margins(self, text: str) -> np.ndarray | None:
        """One margin per bit; None without a letter."""
        grams = ngram_buckets(text)
        if not len(grams):
            return None
        total = np.zeros(self.table.shape[1])
        for a in range(0, len(grams), 1 << 16):
            total += self.table[grams[a : a + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return SHARPNESS * total / len(grams)

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, score and whether it is ambiguous."""
        margin = self.margins(text) if self.langs else None
        if margin is None:
            return "und", 0.0, True
        loss = (self.weights * np.logaddexp(0, -self.code * margin)).sum(axis=1)
        share = np.exp(SHARPNESS * (loss.min() - loss))
        share /= share.sum()
        order = np.argsort(-share, kind="stable")
        second = share[order[1]] if len(order) > 1 else 0.0
        return self.langs[order[0]], float(share[order[0]]), bool(share[order[0]] - second < AMBIGUOUS_GAP)


def _gram_counts(train: DataFrame) -> dict[str, np.ndarray]:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for piece in text_slices(batches, 0):
            for text, lang in zip(texts_of(piece, 0), piece.column(1).to_pylist(), strict=True):
                sums[lang] = sums.get(lang, 0) + np.bincount(ngram_buckets(text), minlength=DIMS)
        for lang, v in sums.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(v[at], pa.int64())], ["lang", "bucket", "n"])

    rows = train.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    out = {}
    for lang, part in rows.groupby("lang"):
        out[lang] = np.zeros(DIMS)
        out[lang][part["bucket"].to_numpy()] = part["n"].to_numpy()
    return out


def _bit_weights(train: DataFrame, model: LanguageModel, weigh_docs: int) -> np.ndarray:
    """Share of sample documents of each language for which each bit is right, rows scaled to 1."""
    n = train.count()
    shared = train.sparkSession.sparkContext.broadcast(model)

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, right = shared.value, {}
        at = {lang: i for i, lang in enumerate(m.langs)}
        for piece in text_slices(batches, 0):
            for text, lang in zip(texts_of(piece, 0), piece.column(1).to_pylist(), strict=True):
                margin = m.margins(text)
                if margin is not None and lang in at:
                    hit = (m.code[at[lang]] * margin > 0).astype(np.int64)
                    right[lang] = right.get(lang, 0) + np.append(hit, 1)
        rows = [(lang, i, int(v)) for lang, r in right.items() for i, v in enumerate(r)]
        lang, bit, v = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(bit, pa.int32()), pa.array(v, pa.int64())], ["lang", "bit", "n"])

    share = min(1_000_000, weigh_docs * 1_000_000 // max(n, 1))
    sample = train.filter(F.crc32(F.concat(F.col("id"), F.lit("/w"))) % 1_000_000 < share)
    right = np.zeros((len(model.langs), model.code.shape[1] + 1))
    for r in sample.select("text", "lang").mapInArrow(tally, "lang string, bit int, n long").groupBy("lang", "bit").agg(F.sum("n").alias("n")).collect():
        right[model.langs.index(r.lang), r.bit] = r.n
    share = (right[:, :-1] + 1) / (right[:, -1:] + 1)
    return share / share.sum(axis=1, keepdims=True)


def learn(docs: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", weigh_docs: int = WEIGH_DOCS, max_langs: int = MAX_LANGS) -> LanguageModel:
    """A model from the rows of ``docs`` where ``use`` holds and neither text nor language is null.

    At most ``max_langs`` languages are learned, those with most documents (dirty tags may be many; what the driver holds is
    bounded by this).  No such row gives a model without languages, which predicts ``und`` everywhere.
    """
    train = docs.filter(use & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    common = train.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs + 1).collect()
    if len(common) > max_langs:
        train = train.filter(F.col("lang").isin([r.lang for r in common[:max_langs]]))
    counts = _gram_counts(train)
    langs = sorted(counts)
    code = codewords(len(langs))
    if not langs:
        return LanguageModel([], code, np.zeros((DIMS, 1), np.float32), np.ones((0, 1)))
    share = np.array([(counts[x] + 0.05) / (counts[x].sum() + 0.05 * DIMS) for x in langs])
    columns = []
    for bit in code.T:
        on, off = share[bit > 0], share[bit < 0]
        columns.append(np.log(on.mean(axis=0)) - np.log(off.mean(axis=0)) if len(off) else np.ones(DIMS))
    model = LanguageModel(langs, code, np.array(columns, np.float32).T.copy(), np.full(code.shape, 1 / code.shape[1]))
    model.weights = _bit_weights(train, model, weigh_docs)
    return model


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``.

    The text alone decides.  Texts that are null or have no letter get ``und``, 0 and true.  Null
    ids stay, repeated rows repeat, empty tables give empty results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, 1):
            lang, score, odd = zip(*map(shared.value.predict, texts_of(piece, 1)), strict=True)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(odd, pa.bool_())], ["id", "lang_pred", "score", "ambiguous"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, lang_pred string, score double, ambiguous boolean").withColumnRenamed("id", id_col)
