"""Byte-level BPE through a sentencepiece model that is written straight from a rank file.

A rank file lists byte strings in the order of their merges. Each becomes a piece: its bytes mapped
to one letter each, its score the negative rank, its id the rank. A BPE model merges the best scored
pair first, so the pieces of a pre-token are those of the ranks. Normalisation is the identity.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from fareflow.llm.common import map_rows

#: Byte b is written as the letter with this code point plus b. None of them is white space.
FIRST_LETTER = 0x100
#: Pre-tokens whose ids a task's process remembers, and the longest it remembers.
MEMO, MEMO_CHARS = 100_000, 48
IDS = np.dtype("<u4")


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank. Ranks must be 0, 1, 2, ... and hold all 256 bytes."""
    with open(path, "rb") as file:
        ranks = {int(rank): base64.b64decode(piece) for piece, rank in map(bytes.split, file)}
    vocabulary = [ranks[i] for i in range(len(ranks))]
    if len({x for x in vocabulary if len(x) == 1}) != 256:
        raise ValueError(f"{path} lacks single bytes")
    return vocabulary


_LETTERS = "".join(chr(FIRST_LETTER + b) for b in range(256))


def letters(data: bytes) -> str:
    return codecs.charmap_decode(data, "strict", _LETTERS)[0]


def model_bytes(vocabulary: list[bytes]) -> bytes:
    """The serialised sentencepiece model. The unknown piece it must have comes last and is never met."""
    model = proto.ModelProto()
    for rank, piece in enumerate(vocabulary):
        model.pieces.add(piece=letters(piece), score=-float(rank), type=proto.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    spec = model.trainer_spec
    spec.model_type = proto.TrainerSpec.BPE
    spec.vocab_size = len(vocabulary) + 1
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(vocabulary), -1, -1, -1
    norm = model.normalizer_spec
    norm.name, norm.precompiled_charsmap = "identity", b""
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes and decodes by one vocabulary and one pattern of pre-tokens."""

    def __init__(self, vocabulary: list[bytes], pattern: str):
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(vocabulary))
        # A pre-token that is a piece is that piece, whether merges reach it or not.
        self.whole = {piece: rank for rank, piece in enumerate(vocabulary)}
        self.memo: dict[str, bytes] = {}

    def _learn(self, tokens: list[str]) -> dict[str, bytes]:
        found, rest = {}, []
        for token in tokens:
            data = token.encode("utf-8")
            if (rank := self.whole.get(data)) is not None:
                found[token] = rank.to_bytes(4, "little")
            else:
                rest.append((token, letters(data)))
        encoded = self.model.encode([x for _, x in rest], num_threads=1) if rest else []
        for (token, _), ids in zip(rest, encoded):
            found[token] = np.array(ids, IDS).tobytes()
        return found

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(t) if t else [] for t in texts]
        tokens = set(chain.from_iterable(split))
        if len(self.memo) > MEMO:
            self.memo.clear()
        known = self.memo
        found = self._learn([t for t in tokens if t not in known])
        # Long pre-tokens are rare and not worth their memory.
        rare = {t: found.pop(t) for t in [t for t in found if len(t) > MEMO_CHARS]}
        known.update(found)
        if rare:
            known = {t: rare[t] if t in rare else known[t] for t in tokens}
        return [b"".join(map(known.__getitem__, x)) for x in split]

    def decode(self, ids: bytes) -> bytes:
        pieces = self.vocabulary
        return b"".join([pieces[i] for i in np.frombuffer(ids, IDS).tolist()])


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One codec for all tasks of a process."""
    return Codec(read_ranks(path), pattern)


def id_lists(each: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) // IDS.itemsize for x in each], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(each), IDS).astype(np.int32))


def encode_documents(docs: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows with their ids (array of int) in a column that replaces ``ids``, if there is one.

    A null or empty text has no ids. ``path`` must be readable by every executor.
    """

    def make():
        engine = codec(path, pattern)

        def compute(batch: pa.RecordBatch):
            return {ids: id_lists(engine.encode(batch.column("text").to_pylist()))}

        return compute

    return map_rows(docs, make, f"`{ids}` array<int>")


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """The rows with the bytes of their ids. A null list of ids decodes to nothing."""

    def make():
        pieces = read_ranks(path)

        def compute(batch: pa.RecordBatch):
            return {column: [b"".join([pieces[i] for i in x or ()]) for x in batch.column(ids).to_pylist()]}

        return compute

    return map_rows(encoded.withColumn("_size", F.lit("")), make, f"`{column}` binary", ("_size",), "_size")


def digests(
    docs: DataFrame, path: str, pattern: str, drop: tuple[str, ...] = (), ids: str | None = None
) -> DataFrame:
    """Number and SHA-256 of the ids and SHA-256 of the bytes they decode to, for every row.

    A null or empty text has no ids. ``ids`` names a column that is to hold the ids themselves.
    """
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (f", `{ids}` array<int>" if ids else "")

    def make():
        engine = codec(path, pattern)

        def compute(batch: pa.RecordBatch):
            each = engine.encode(batch.column("text").to_pylist())
            out = {
                "n_tokens": [len(x) // IDS.itemsize for x in each],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in each],
                "decoded_sha256": [hashlib.sha256(engine.decode(x)).hexdigest() for x in each],
            }
            return out | ({ids: id_lists(each)} if ids else {})

        return compute

    return map_rows(docs, make, added, drop)
