"""Secret scans: a keyword automaton, anchored patterns near its hits, checksum validation.

One pass of an Aho-Corasick automaton over the lower-cased text finds every keyword; only there
is a pattern tried, anchored at the keyword.  Long hexadecimal runs have no keyword and are
searched on their own.  Kinds with an embedded checksum or header are kept only if it holds.

Each text is scanned whole where it lies; nothing is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrichlab.llm.common import text_slices, texts_of

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "private_key")
BASE_KINDS = KINDS[:3]
#: Keywords in lower case, and the kind that is tried where one is found.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign", "apikey": "assign",
    "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm",
    "eyj": "jwt",
    "-----begin ": "private_key",
}
_PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+"),
    "private_key": re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----[A-Za-z0-9+/=\s]+-----END \1-----"),
}
_JWT_RUN = re.compile(r"[A-Za-z0-9_-]*")
_HEX = re.compile(r"[0-9a-f]{16,}")
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: str) -> str:
    """The six base-62 digits of a body's CRC-32, as token issuers append them."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = _BASE62[r] + out
    return out


def _is_json(part: str) -> bool:
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))), dict)
    except (binascii.Error, ValueError):
        return False


_VALID = {
    "assign": lambda m: len(m[2]) >= 12,
    "access": lambda m: len(m[0]) >= 18,
    "github": lambda m: checksum62(m[1]) == m[2],
    "npm": lambda m: checksum62(m[1]) == m[2],
    "jwt": lambda m: _is_json(m[1]) and _is_json(m[2]),
    "private_key": lambda m: True,
}
_RANK = {k: i for i, k in enumerate(KINDS)}
_AUTOMATON = None


def _automaton():
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick

        _AUTOMATON = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            _AUTOMATON.add_word(word, (len(word), kind))
        _AUTOMATON.make_automaton()
    return _AUTOMATON


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points, by start and then kind.  Matches of a kind are the
    leftmost non-overlapping ones; those that fail validation are dropped after that."""
    low = text.lower()
    if len(low) != len(text):  # some character grew: lower-case ASCII only
        low = text.translate(_ASCII_LOWER)
    hits = sorted((end + 1 - n, kind) for end, (n, kind) in _automaton().iter(low))
    found = [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    past = dict.fromkeys(KINDS, 0)
    for start, kind in hits:
        if start < past[kind]:
            continue
        if not (m := _PATTERNS[kind].match(text, start)):
            if kind == "jwt":  # what follows the run decides, so no later start inside it can do better
                past[kind] = _JWT_RUN.match(text, start).end()
            continue
        past[kind] = m.end()
        if _VALID[kind](m):
            found.append((start, m.end(), kind))
    found.sort(key=lambda x: (x[0], _RANK[x[2]]))
    return found


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each stretch covered by spans replaced by the name of its first kind."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``spans``, an array of (start, end, kind) in code
    points, end exclusive, by start and then kind; empty where nothing is found.

    Null texts count as empty, null ids stay, repeated rows repeat; further columns are not read.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, 1):
            spans = [[dict(zip(("start", "end", "kind"), s, strict=True)) for s in find_secrets(t)] for t in texts_of(piece, 1)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(spans, pa.list_(_SPAN))], ["id", "spans"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, spans array<struct<start:int,end:int,kind:string>>").withColumnRenamed("id", id_col)


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by its kind in brackets.  All rows and
    columns stay, nulls too."""
    at = docs.columns.index(text_col)
    frame = docs.withColumn(text_col, F.col(text_col).cast("string"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, at):
            clean = [None if t is None else redact(t, find_secrets(t)) for t in piece.column(at).to_pylist()]
            columns = list(piece.columns)
            columns[at] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(columns, piece.schema.names)

    return frame.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in frame.schema]))
