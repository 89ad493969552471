"""Formats conversations for training, with a loss mask over the assistants' texts.

Turns are written one after another between control strings; control strings inside texts are
escaped, so the format can be read back. Whole turns are joined to segments of bounded size, and each
segment is encoded once with offsets. Whether a token counts is found by binary search of its span
among the sorted spans of the assistants' texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from fareflow.llm.common import struct, emit

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Strings that no escaped text holds. None of them has a backslash, or an n as second letter.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
    "<<SYS>>", "<</SYS>>",
)
LOSS_ROLE = "assistant"
#: Characters of turns that are encoded together; a longer turn is a segment of its own.
SEGMENT_CHARS = 1_000_000

_CONTROL = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE), re.S)


def escape(text: str) -> str:
    """Doubles backslashes and puts one after the first character of a control string."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


@dataclass
class Segment:
    """Whole turns of a conversation: the formatted text, its tokens and which of them count."""

    text: str
    ids: list[int]
    spans: np.ndarray  # of tokens, start and end
    loss: np.ndarray  # of tokens: the part of the span inside an assistant's text, empty if none

    def turns(self) -> Iterator[tuple[str, str]]:
        """The roles and texts, read back from the formatted text."""
        for m in _TURN.finditer(self.text):
            yield unescape(m[1]), unescape(m[2])

    def loss_text(self) -> str:
        """What the counting tokens stand for, each character once.

        Pieces of one text are joined before they are unescaped; between texts stands more than a
        token's end, so no escape is cut.
        """
        pieces, runs, reach = [], [], 0
        for start, end in self.loss[self.loss[:, 1] > self.loss[:, 0]].tolist():
            start = max(start, reach)
            if start > reach and pieces:
                runs.append("".join(pieces))
                pieces = []
            if end > start:
                pieces.append(self.text[start:end])
                reach = end
        return "".join(map(unescape, [*runs, "".join(pieces)]))


def intersect(tokens: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Of each token span the part inside the sorted, disjoint ``spans``; (0, 0) if there is none.

    A token that reaches into several spans is given the first: control strings lie between them, so
    the tokenizer would have to join a text's end, a control string and a text's start in one token.
    """
    out = np.zeros_like(tokens)
    if len(spans) and len(tokens):
        at = np.searchsorted(spans[:, 1], tokens[:, 0], side="right")
        inside = at < len(spans)
        near = spans[np.minimum(at, len(spans) - 1)]
        start, end = np.maximum(tokens[:, 0], near[:, 0]), np.minimum(tokens[:, 1], near[:, 1])
        hit = inside & (start < end)
        out[hit, 0], out[hit, 1] = start[hit], end[hit]
    return out


@lru_cache(maxsize=4)
def _library(path: str) -> Tokenizer:
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return library


def render(turns: Iterable[tuple[str | None, str | None]], path: str) -> Iterator[Segment]:
    """The segments of a conversation. A null role or text counts as empty."""
    library = _library(path)

    def segment() -> Segment:
        text = "".join(parts)
        encoded = library.encode(text, add_special_tokens=False)
        spans = np.array(encoded.offsets, np.int64).reshape(-1, 2)
        return Segment(text, encoded.ids, spans, intersect(spans, np.array(loss, np.int64).reshape(-1, 2)))

    parts, loss, length = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape_role(role or '')}\n", escape(text or "")
        if parts and length + len(body) > SEGMENT_CHARS:
            yield segment()
            parts, loss, length = [], [], 0
        if role == LOSS_ROLE and body:
            loss.append((length + len(head), length + len(head) + len(body)))
        parts += [head, body, CLOSE]
        length += len(head) + len(body) + len(CLOSE)
    if parts:
        yield segment()


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator]]:
    """Conversations of sorted rows, each with an iterator of its turns: none is held whole."""
    rows = (
        row
        for batch in batches
        for row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")])
    )
    ahead = next(rows, None)

    def turns(conv):
        nonlocal ahead
        while ahead is not None and ahead[0] == conv:
            yield ahead[1], ahead[2]
            ahead = next(rows, None)

    while ahead is not None:
        conv = ahead[0]
        each = turns(conv)
        yield conv, each
        for _ in each:  # what the caller has not read
            pass


def _in_order(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together and by turn; equal turns by role and text, nulls first."""
    columns = conversations.select("conv_id", "turn", "role", "text")
    return columns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


FORMATTED = struct(
    conv_id=T.LongType(), segment=T.IntegerType(), formatted=T.StringType(), ids=T.ArrayType(T.IntegerType()),
    starts=T.ArrayType(T.LongType()), ends=T.ArrayType(T.LongType()), loss=T.ArrayType(T.BooleanType()),
)
DIGESTS = struct(
    conv_id=T.LongType(), n_turns=T.LongType(), turns_sha256=T.StringType(), loss_chars=T.LongType(),
    loss_sha256=T.StringType(), formatted_chars=T.LongType(),
)


def format_conversations(conversations: DataFrame, path: str) -> DataFrame:
    """FORMATTED: the segments of each conversation, with token ids, offsets and the loss mask."""

    def run(batches):
        for conv, turns in _conversations(batches):
            for i, s in enumerate(render(turns, path)):
                row = {"conv_id": conv, "segment": i, "formatted": s.text, "ids": s.ids}
                row |= {"starts": s.spans[:, 0], "ends": s.spans[:, 1], "loss": s.loss[:, 1] > s.loss[:, 0]}
                yield emit(FORMATTED, {k: [v] for k, v in row.items()})

    return _in_order(conversations).mapInArrow(run, FORMATTED)


def digests(conversations: DataFrame, path: str) -> DataFrame:
    """DIGESTS of each conversation, read back from its segments.

    A conversation is hashed in the order of its turns, so one task reads it, as a stream. Rows
    without a conv_id are one conversation. Repeated rows are turns like any other.
    """

    def run(batches):
        rows = []
        for conv, turns in _conversations(batches):
            n, turn_sha, chars, loss_sha, length = 0, hashlib.sha256(), 0, hashlib.sha256(), 0
            for s in render(turns, path):
                for role, text in s.turns():
                    n += 1
                    turn_sha.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                lost = s.loss_text()
                chars += len(lost)
                loss_sha.update(lost.encode("utf-8", "surrogatepass"))
                length += len(s.text)
            rows.append((conv, n, turn_sha.hexdigest(), chars, loss_sha.hexdigest(), length))
            if len(rows) == 1000:
                yield emit(DIGESTS, dict(zip(DIGESTS.names, zip(*rows))))
                rows = []
        if rows:
            yield emit(DIGESTS, dict(zip(DIGESTS.names, zip(*rows))))

    return _in_order(conversations).mapInArrow(run, DIGESTS)


#: Both turns of the conversation that is added hold control strings.
EXTRA = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def with_extra(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -7."""
    columns = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role"), F.col("text")
    )
    return columns.unionAll(
        conversations.sparkSession.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    )
