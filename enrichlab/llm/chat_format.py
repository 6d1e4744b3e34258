"""Chat formatting of typed content parts, with a loss mask, and reading it back.

A turn is a list of parts: ``text``, ``image``, ``audio`` or ``document``.  A visitor flattens the
parts in order: text is escaped, any other part becomes a placeholder that carries its number in
the turn; its reference and the tokens that it expands to are recorded beside.  A turn is written as

    <|turn|>ROLE<|body|>CONTENT<|end|>

and its content is under the loss mask if its role is the assistant's.  Escaping puts a backslash
after each backslash and after the first character of any control string in a role or text, so no
text can look like a mark, and undoing it is exact.

Turns are formatted row by row.  One shuffle by conversation brings its turns together in order;
they are streamed, and a conversation longer than ``chunk_chars`` leaves in several rows, so that no
task ever holds a whole long conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichlab.llm.common import text_slices

#: Marks of this template, and control strings of common templates that texts may hold.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
CONTROL = re.compile(r"\\|<\||<(?=/?s>)|\[(?=/?INST\])|<(?=/?SYS>)")
_MAY_NEED = re.compile(r"[\\<\[]")
MARK = re.compile(r"<\|turn\|>(.*?)<\|body\|>(.*?)<\|end\|>", re.DOTALL)
PLACEHOLDER = re.compile(r"<\|(image|audio|document):(\d+)\|>")
#: Tokens of one unit of a part: image tiles, seconds of audio, document pages.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}
CHUNK_CHARS = 4_000_000
LOSS_ROLE = "assistant"
PART_TYPE = "array<struct<type:string,text:string,ref:string,units:int>>"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text) if _MAY_NEED.search(text) else text


_ESCAPED = re.compile(r"\\(\\?)")


def unescape(text: str) -> str:
    """Undoes ``escape``: a double backslash is one, any other backslash was put in."""
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


class PartVisitor:
    """Flattens the parts of one turn.  Adjacent text parts are one text, so that what looks like a control string only when
    they are put together is escaped too.  A part of an unknown type becomes a ``<|part:i|>`` placeholder of no tokens."""

    def __init__(self) -> None:
        self.content: list[str] = []
        self.attachments: list[dict] = []
        self.texts: list[str] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['type'] or 'text'}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.texts.append(part["text"] or "")

    def finish(self) -> str:
        """The content so far, with the open text."""
        if self.texts:
            self.content.append(escape("".join(self.texts)))
            self.texts.clear()
        return "".join(self.content)

    def _place(self, part: dict, name: str, tokens: int) -> None:
        self.finish()
        self.content.append(f"<|{name}:{len(self.attachments)}|>")
        self.attachments.append({"type": part["type"], "ref": part["ref"], "tokens": tokens})

    def _attach(self, part: dict) -> None:
        units = 1 if part["units"] is None else part["units"]
        self._place(part, part["type"], units * UNIT_TOKENS[part["type"]])

    visit_image = visit_audio = visit_document = _attach

    def visit_unknown(self, part: dict) -> None:
        self._place(part, "part", 0)


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, list[dict], int, int]:
    """The formatted turn, its attachments, and the span of its content."""
    visitor = PartVisitor()
    for part in parts or []:
        visitor.visit(part)
    head = TURN + escape(role or "") + BODY
    content = visitor.finish()
    return head + content + END, visitor.attachments, len(head), len(head) + len(content)


_ATTACHMENT = pa.struct([("turn_no", pa.int64()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
_MASK = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per conversation: its id, ``chunk`` 0, ``n_turns``, ``formatted``, ``loss_mask``
    (spans of ``formatted``), ``attachments`` (turn number, type, reference, tokens) and
    ``expanded_tokens``, their sum.  A conversation longer than ``chunk_chars`` has further rows with
    chunk 1, 2, ..., cut between turns; spans count from the start of their own row.

    Turns go by turn number, ties by role and then by their parts, nulls first; equal rows are
    all kept.  Null parts and texts are empty, a null role is an empty one, turns with a null
    conversation form one with a null id.  Rows of a conversation stay in one partition, in order.
    """
    frame = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(parts_col).cast(PART_TYPE).alias("parts"),
    )
    ordered = frame.repartition("conv").sortWithinPartitions("conv", "turn", "role", "parts")
    kind = frame.schema["conv"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        conv, chunk, turn_no, size = None, 0, 0, 0
        texts: list[str] = []
        mask: list[dict] = []
        attached: list[dict] = []
        started = False
        conv_type = None

        def row() -> tuple:
            return conv, chunk, len(texts), "".join(texts), list(mask), list(attached), sum(a["tokens"] for a in attached)

        def out() -> pa.RecordBatch:
            kinds = (conv_type, pa.int64(), pa.int64(), pa.string(), pa.list_(_MASK), pa.list_(_ATTACHMENT), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["conv", "chunk", "n_turns", "formatted", "loss_mask", "attachments", "expanded_tokens"])

        held = 0
        for batch in batches:
            conv_type = batch.column(0).type
            for a in range(0, batch.num_rows, 500):
                piece = batch.slice(a, 500)
                for c, role, parts in zip(piece.column(0).to_pylist(), piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True):
                    if started and (c != conv or size > chunk_chars):
                        rows.append(row())
                        held += size
                        chunk, turn_no = (chunk + 1, turn_no) if c == conv else (0, 0)
                        size = 0
                        texts.clear(), mask.clear(), attached.clear()
                        if held > chunk_chars or len(rows) >= 2000:
                            yield out()
                            rows.clear()
                            held = 0
                    conv, started = c, True
                    text, found, begin, end = format_turn(role, parts)
                    if role == LOSS_ROLE:
                        mask.append({"start": size + begin, "end": size + end})
                    attached += [{"turn_no": turn_no, **x} for x in found]
                    texts.append(text)
                    size += len(text)
                    turn_no += 1
        if started:
            rows.append(row())
            yield out()

    schema = f"conv {kind}, chunk long, n_turns long, formatted string, loss_mask array<struct<start:long,end:long>>, attachments array<struct<turn_no:long,type:string,ref:string,tokens:long>>, expanded_tokens long"
    return ordered.mapInArrow(run, schema).withColumnRenamed("conv", conv_col)


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What ``format_chats`` wrote, parsed: per conversation ``n_turns``, ``turns_sha256`` (of role,
    newline, text, newline per turn, unescaped), ``loss_chars`` and ``loss_sha256`` of all text under
    the loss mask, and ``formatted_chars``.  An empty frame gives an empty result, a null id stays null.

    Takes the frame of ``format_chats`` itself, whose rows lie in order within a partition; each text
    is hashed as it streams by.
    """
    frame = formatted.select(F.col(conv_col).alias("conv"), "chunk", "formatted", "loss_mask")
    kind = frame.schema["conv"].dataType.simpleString()
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, started, n, n_loss, chars = None, False, 0, 0, 0
        all_text, loss_text = hashlib.sha256(), hashlib.sha256()
        rows: list[tuple] = []
        conv_type = None

        def out() -> pa.RecordBatch:
            kinds = (conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            conv_type = batch.column(0).type
            for piece in text_slices([batch], 2):
                for c, chunk, text, mask in zip(*(x.to_pylist() for x in piece.columns), strict=True):
                    if chunk == 0 and started:
                        rows.append((conv, n, all_text.hexdigest(), n_loss, loss_text.hexdigest(), chars))
                        n, n_loss, chars = 0, 0, 0
                        all_text, loss_text = hashlib.sha256(), hashlib.sha256()
                    conv, started = c, True
                    chars += len(text)
                    for m in MARK.finditer(text):
                        n += 1
                        all_text.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    for span in mask:
                        said = unescape(text[span["start"] : span["end"]])
                        n_loss += len(said)
                        loss_text.update(said.encode())
                if len(rows) >= 2000:
                    yield out()
                    rows.clear()
        if started:
            rows.append((conv, n, all_text.hexdigest(), n_loss, loss_text.hexdigest(), chars))
            yield out()

    return frame.mapInArrow(run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumnRenamed("conv", conv_col)
