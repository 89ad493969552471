"""Tokens of two tokenizers aligned, with the number of documents that link each pair of ids.

A text is encoded whole by both. Where a token that begins with a space starts in both at the same
byte, both have just ended: such anchors cut a document into windows of a few ids. What a window aligns
to depends on its ids alone, so it is worked out once for each different pair of id tuples and
remembered. Groups end wherever both tokenizers end a token; two tokens are linked if they share bytes.

How many documents link a pair is known only after the whole corpus has been read. So tasks work on
blocks of texts: a block numbers its own different pairs, a document keeps those numbers and how often
each occurs, and only the block's pairs go through the count and come back with it, to the block.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from fareflow.llm.common import emit, slices, struct, written

#: Windows whose alignment a task's process remembers, and the most ids of one that is remembered.
MEMO, MEMO_IDS = 250_000, 32
SPACE_PIECE = "▁"


@dataclass
class Side:
    """What a tokenizer's ids stand for."""

    pieces: list[bytes]

    def __post_init__(self):
        self.sizes = [len(x) for x in self.pieces]
        self.size = np.array(self.sizes, np.int64)
        self.marked = np.array([x.startswith(b" ") for x in self.pieces], bool)


def _byte_letters() -> dict[str, int]:
    """The letter of each byte in a byte-level vocabulary: printable Latin-1 stands for itself, the
    other bytes have the letters from U+0100 on, in order."""
    plain = {b for b in range(256) if chr(b).isprintable() and b != 0x20}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Ids of a byte-level BPE file, special strings as plain text.

    The file's merges are in the order of the ids they make, so the ids are ranks and the rank encoder
    gives what the file's own library gives, in a fourth of its time. Where it gives up (its pattern
    steps back too far on a very long run of white space), the file's library encodes the text.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in piece): i for piece, i in model["vocab"].items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        made = [model["vocab"][a + b] for a, b in pairs]
        if made != sorted(set(made)) or len(ranks) != len(model["vocab"]):
            raise ValueError(f"{path} does not list its merges in the order of the ids")
        self.path = path
        self.side = Side([x for x, _ in sorted(ranks.items(), key=lambda x: x[1])])
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.library = None

    def encode(self, text: str) -> list[int]:
        try:
            return self.ranks.encode_ordinary(text)
        except Exception:  # the encoder has no error class of its own for this
            if self.library is None:
                self.library = Tokenizer.from_file(self.path)
                self.library.encode_special_tokens = True
                self.library.no_truncation()
                self.library.no_padding()
            return self.library.encode(text, add_special_tokens=False).ids


class Pieces:
    """Ids of a sentencepiece model; a piece's bytes have a space for its space mark."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.library.vocab_size())
        self.side = Side([self._bytes(i) for i in ids])

    def _bytes(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        if self.library.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace(SPACE_PIECE, " ").encode("utf-8", "surrogatepass")

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, num_threads=1)


def starts_of(ids: np.ndarray, side: Side) -> np.ndarray:
    """The byte at which each token starts."""
    size = side.size[ids]
    return np.cumsum(size) - size


def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The values in both of two sorted arrays, each without repeats."""
    at = np.searchsorted(y, x).clip(max=max(len(y) - 1, 0))
    return x[y[at] == x] if len(y) else x[:0]


def either(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The values in one of two sorted arrays, each without repeats: merged, as both are runs already."""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    return both[np.append(both[1:] != both[:-1], True)] if len(both) else both


def spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each of several runs."""
    return np.arange(many.sum()) + np.repeat(first - np.cumsum(many) + many, many)


class Aligner:
    """Encodes and aligns texts; remembers windows by their ids."""

    def __init__(self, path_a: str, pattern: str, path_b: str):
        self.a, self.b = ByteLevel(path_a, pattern), Pieces(path_b)
        # Ids of both sides in one width, with a value beyond them all to stand between the sides.
        most = max(len(self.a.side.pieces), len(self.b.side.pieces))
        self.kind = np.dtype("u2" if most < 2**16 else "u4")
        self.between = np.iinfo(self.kind).max
        self.memo: dict[bytes, int] = {}
        self.known: list[tuple[str, bytes, int]] = []
        # The text of an id with what follows it: inside a group's side, at the end of the first, of the second.
        a, b = range(len(self.a.side.pieces)), range(len(self.b.side.pieces))
        self.names = [f"{i}{mark}" for ids, marks in ((a, ",|"), (b, ",;")) for mark in marks for i in ids]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of both; none if one of them does not give back the text with a space before it."""
        if text:
            whole = (" " + text).encode("utf-8")
            b = self.b.encode(text)
            if b"".join(map(self.b.side.pieces.__getitem__, b)) == whole:
                a = self.a.encode(" " + text)
                if b"".join(map(self.a.side.pieces.__getitem__, a)) == whole:
                    return np.array(a, self.kind), np.array(b, self.kind)
        return np.empty(0, self.kind), np.empty(0, self.kind)

    def windows(self, each: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """The windows of some documents in order, by their numbers in ``known``, and how many each has."""
        a, b = (np.concatenate([x[side] for x in each]) for side in (0, 1))
        if not len(a):
            return np.empty(0, np.int64), np.zeros(len(each), np.int64)
        # Both sides of a document have the same bytes, so places in the documents' joined bytes agree.
        at_a, at_b = starts_of(a, self.a.side), starts_of(b, self.b.side)
        first = at_a[np.cumsum([0] + [len(x) for x, _ in each if len(x)])[:-1]]
        anchors = common(at_a[self.a.side.marked[a]], at_b[self.b.side.marked[b]])
        # The first byte of a document is a start of both, marked or not.
        anchors = either(anchors, first)
        cut_a, cut_b = np.searchsorted(at_a, anchors), np.searchsorted(at_b, anchors)
        # All windows in a row: the ids of one side, the mark, the ids of the other.
        window = np.arange(len(anchors))
        many_a, many_b = np.diff(cut_a, append=len(a)), np.diff(cut_b, append=len(b))
        row = np.full(len(a) + len(b) + len(anchors), self.between, self.kind)
        row[np.arange(len(a)) + np.repeat(cut_b + window, many_a)] = a
        row[np.arange(len(b)) + np.repeat(cut_a + many_a + window + 1, many_b)] = b
        data = row.tobytes()
        cuts = ((cut_a + cut_b + window) * self.kind.itemsize).tolist()
        keys = [data[i:j] for i, j in zip(cuts, [*cuts[1:], len(data)])]
        numbers = list(map(self.memo.get, keys))
        new = {key: i for i, key in enumerate(keys) if numbers[i] is None}
        if new:
            which = np.array(list(new.values()))
            of_a, of_b = spread(cut_a[which], many_a[which]), spread(cut_b[which], many_b[which])
            learnt = self._align(a[of_a], b[of_b], many_a[which], many_b[which])
            number = dict(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.known += learnt
            numbers = [number[key] if x is None else x for x, key in zip(numbers, keys)]
            longest = (MEMO_IDS + 1) * self.kind.itemsize
            self.memo.update((key, x) for key, x in number.items() if len(key) <= longest)
        held = np.zeros(len(each), np.int64)
        held[[len(x) > 0 for x, _ in each]] = np.diff(np.searchsorted(anchors, first), append=len(anchors))
        return np.array(numbers, np.int64), held

    def _align(
        self, a: np.ndarray, b: np.ndarray, many_a: np.ndarray, many_b: np.ndarray
    ) -> list[tuple[str, bytes, int]]:
        """The groups as text, the links (a << 32 | b) in order and the number of groups of some windows.

        The windows' ids stand one after another. Between one end of a token, of either side, and the next
        lies a piece of exactly one token of each side: a link.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        end_a, end_b = np.cumsum(self.a.side.size[a]), np.cumsum(self.b.side.size[b])
        ends, shared = either(end_a, end_b), common(end_a, end_b)
        links = a[np.searchsorted(end_a, ends)] << 32 | b[np.searchsorted(end_b, ends)]
        last = end_a[np.cumsum(many_a) - 1]
        link_cuts = np.searchsorted(ends, last, "right").tolist()
        groups = np.diff(np.searchsorted(shared, last, "right"), prepend=0).tolist()
        # A group's ids of one side, then of the other: where each stands, and how its text ends.
        of_a, of_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        before = np.searchsorted(end_b, np.concatenate([[-1], shared]), "right")
        upto = np.searchsorted(end_a, shared, "right")
        n_a, n_b = len(self.a.side.pieces), len(self.b.side.pieces)
        row = np.empty(len(a) + len(b), np.int64)
        row[np.arange(len(a)) + before[of_a]] = a + n_a * (shared[of_a] == end_a)
        row[np.arange(len(b)) + upto[of_b]] = b + 2 * n_a + n_b * (shared[of_b] == end_b)
        text = list(map(self.names.__getitem__, row.tolist()))
        text_cuts = np.cumsum(many_a + many_b).tolist()
        texts = ["".join(text[i:j])[:-1] for i, j in zip([0, *text_cuts], text_cuts)]
        data = links.tobytes()
        # Strings and bytes only: the garbage collector passes over them.
        each = [data[8 * i : 8 * j] for i, j in zip([0, *link_cuts], link_cuts)]
        return list(zip(texts, each, groups))

    def forget(self) -> None:
        """To be called between blocks: numbers given before are then void."""
        if len(self.known) > MEMO:
            self.memo, self.known = {}, []


@lru_cache(maxsize=2)
def aligner(path_a: str, pattern: str, path_b: str) -> Aligner:
    """One aligner for all tasks of a process."""
    return Aligner(path_a, pattern, path_b)


def place_type(n_pairs: int) -> np.dtype:
    return np.dtype("<u2" if n_pairs <= 2**16 else "<u4")


def pack(place: np.ndarray, times: np.ndarray, n_pairs: int) -> bytes:
    """Numbers of pairs and how often each occurs, in three bytes each (five in a block of many pairs)."""
    more = np.repeat(place, -(-times // 255))
    last = np.cumsum(-(-times // 255)) - 1
    often = np.full(len(more), 255)
    often[last] = times - 255 * (-(-times // 255) - 1)
    return more.astype(place_type(n_pairs)).tobytes() + often.astype("u1").tobytes()


def unpack(data: bytes, n_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    kind = place_type(n_pairs)
    n = len(data) // (kind.itemsize + 1)
    return np.frombuffer(data, kind, n), np.frombuffer(data, "u1", n, n * kind.itemsize)


class Block:
    """The texts of one block: a row of figures for each, and the block's different pairs."""

    def __init__(self, engine: Aligner, texts: list[str | None], groups: bool):
        encoded = [engine.encode(t) for t in texts]
        self.n_a, self.n_b = [len(a) for a, _ in encoded], [len(b) for _, b in encoded]
        windows, many = engine.windows(encoded)
        each = [engine.known[w][0] for w in windows.tolist()]
        ends = np.cumsum(many).tolist()
        joined = [";".join(each[i:j]) for i, j in zip([0, *ends], ends)]
        self.sha = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in joined]
        self.groups = joined if groups else None
        # The windows of the block by number of their own, with their links.
        used, own = np.unique(windows, return_inverse=True)
        known = [engine.known[w] for w in used.tolist()]
        doc = np.repeat(np.arange(len(texts)), many)
        n_links = np.array([len(x) // 8 for _, x, _ in known], np.int64)
        self.n_groups = np.bincount(doc, np.array([n for _, _, n in known], np.int64)[own], len(texts)).astype(np.int64)
        self.n_links = np.bincount(doc, n_links[own], len(texts)).astype(np.int64)
        links = np.frombuffer(b"".join([x for _, x, _ in known]), np.int64)
        self.pairs, place = np.unique(links, return_inverse=True)
        # Each document's different windows with how often they occur, then its different pairs.
        window, often = np.unique(doc * max(len(used), 1) + own, return_counts=True)
        doc, own = np.divmod(window, max(len(used), 1))
        many = n_links[own]
        from_link = np.cumsum(n_links) - n_links
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(from_link[own], many)
        key = np.repeat(doc, many) * max(len(self.pairs), 1) + place[at]
        held, inverse = np.unique(key, return_inverse=True)
        times = np.bincount(inverse, np.repeat(often, many), len(held)).astype(np.int64)
        doc, place = np.divmod(held, max(len(self.pairs), 1))
        self.held = np.bincount(place, minlength=len(self.pairs))
        ends = np.searchsorted(doc, np.arange(len(texts) + 1))
        parts = [slice(i, j) for i, j in zip(ends, ends[1:])]
        self.entries = [pack(place[x], times[x], len(self.pairs)) for x in parts]


FIGURES = {
    "n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(),
    "groups_sha256": T.StringType(),
}
#: Rows of documents have entries, rows of blocks have pairs and how many of its documents hold each.
ROWS = struct(
    block=T.LongType(), doc_id=T.LongType(), **FIGURES, groups=T.StringType(), entries=T.BinaryType(),
    pairs=T.BinaryType(), held=T.BinaryType(),
)


def blocks(docs: DataFrame, path_a: str, pattern: str, path_b: str, groups: bool = False) -> DataFrame:
    """The documents encoded and aligned, in blocks of bounded text, and a row for each block's pairs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = aligner(path_a, pattern, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text"):
                engine.forget()
                block = Block(engine, part.column("text").to_pylist(), groups)
                n = part.num_rows
                rows = {
                    "block": [number] * n, "doc_id": part.column("doc_id"), "n_a": block.n_a, "n_b": block.n_b,
                    "n_groups": block.n_groups, "n_links": block.n_links, "groups_sha256": block.sha,
                    "groups": block.groups or [None] * n, "entries": block.entries,
                }
                yield emit(ROWS, rows | dict.fromkeys(("pairs", "held"), [None] * n))
                if len(block.pairs):
                    own = {"block": [number], "pairs": [block.pairs.tobytes()], "held": [block.held.astype("<i4").tobytes()]}
                    yield emit(ROWS, {f.name: own.get(f.name, [None]) for f in ROWS})
                number += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ROWS)


def block_pairs(aligned: DataFrame) -> DataFrame:
    """block, place, pair, held: the different pairs of every block."""
    found = struct(block=T.LongType(), place=T.IntegerType(), pair=T.LongType(), held=T.IntegerType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, held in zip(*(batch.column(i).to_pylist() for i in range(3))):
                pair = np.frombuffer(pairs, np.int64)
                n = len(pair)
                yield emit(found, {
                    "block": np.full(n, block), "place": np.arange(n, dtype=np.int32), "pair": pair,
                    "held": np.frombuffer(held, "<i4"),
                })

    return aligned.filter(F.col("pairs").isNotNull()).select("block", "pairs", "held").mapInArrow(run, found)


def count_pairs(held: DataFrame) -> DataFrame:
    """pair, n (documents that hold it), best (no other pair of its A id has more), over all blocks.

    Blocks are summed in each task before the shuffle. The largest count of each A id is one row per id
    of that vocabulary, so it is bounded by the vocabulary and may be sent to the tasks.
    """
    counts = written(held.groupBy("pair").agg(F.sum("held").alias("n")), "pair-counts")
    a = F.shiftright("pair", 32).alias("a")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    judged = counts.withColumn("a", a).join(F.broadcast(most), "a")
    return judged.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def pair_counts(docs: DataFrame, path_a: str, pattern: str, path_b: str) -> DataFrame:
    """a, b, n_docs, best of every pair of ids that some document links: the corpus's dictionary of ids."""
    counted = count_pairs(block_pairs(written(blocks(docs, path_a, pattern, path_b), "aligned")))
    b = F.col("pair").bitwiseAND(2**32 - 1)
    return counted.select(F.shiftright("pair", 32).alias("a"), b.alias("b"), F.col("n").alias("n_docs"), "best")


def alignments(docs: DataFrame, path_a: str, pattern: str, path_b: str, groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``.

    ``docs`` has doc_id and text; other columns do not matter. Every row is a document of its own, also
    a repeated one. A text that is null, empty or not given back by both tokenizers has zeros and an
    empty digest. n_best counts the links whose pair is linked in most documents, of the pairs of its A
    id, ties included; count_sum sums those documents over the links. ``groups`` adds the groups
    themselves, as the text that the digest is of. A text is one row of a block however long it is.
    """
    aligned = written(blocks(docs, path_a, pattern, path_b, groups), "aligned")
    requests = written(block_pairs(aligned), "block-pairs")
    counted = written(count_pairs(requests), "counted-pairs")
    # Both sides are written tables, so that a pair of every block can be split among tasks.
    answers = requests.join(counted, "pair").select("block", "place", "n", "best")
    names = ["doc_id", *FIGURES, *(["groups"] if groups else [])]
    found = T.StructType([ROWS[x] for x in names] + list(struct(n_best=T.LongType(), count_sum=T.LongType())))

    def finish(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        pairs = pairs.take(pc.sort_indices(pairs.column("place")))
        n, best = pairs.column("n").to_numpy(), pairs.column("best").to_numpy().astype(np.int64)
        out: dict[str, list] = {"n_best": [], "count_sum": []}
        for data in docs.column("entries").to_pylist():
            place, times = unpack(data, len(n))
            times = times.astype(np.int64)
            out["n_best"].append(int((best[place] * times).sum()))
            out["count_sum"].append(int((n[place] * times).sum()))
        rows = {x: docs.column(x).combine_chunks() for x in names}
        return pa.Table.from_batches([emit(found, rows | out)])

    own = aligned.filter(F.col("entries").isNotNull()).select("block", "entries", *names)
    whole = own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, found)
    order = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return whole.select(*order, *(["groups"] if groups else []))
