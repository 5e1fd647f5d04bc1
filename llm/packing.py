r"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Lengths fall into reciprocal-capacity classes: class j takes pieces that fit j
to a sequence, at most ``capacity // j`` tokens each, and a sequence of class j
is filled with exactly j pieces. A document is cut into full sequences and a
rest; a rest that would waste more than ``slack`` of its place is cut once more
at the largest class size it reaches, so a full sequence of any class is padded
by little more than ``slack`` of the capacity. Every task packs its own part of
the input and numbers its sequences from its own range, so packing needs no
shuffle. What a task has left in unfilled classes at its end (under one
sequence per class) is packed largest first into the sequences it still fits.

Tokens come from the public byte-level BPE ranks (the same vocabulary as the
JSON tokenizer file). A single space between two non-space characters always
starts a new pre-token there, so texts are encoded word by word through a
bounded cache; texts with other white-space runs are encoded whole.

Defined results: NULL and empty texts are one end token; every id lies in
exactly one piece; repeated rows are packed again, each on its own; NULL ids
stay NULL; an empty table gives no pieces. Sequence ids are unique, not dense:
the task's number in the upper bits, its own count below. Only the id and text
columns are read.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens of a sequence, the end-of-document id, and the waste a piece may have.
CAPACITY, END_ID, SLACK = 2048, 1, 1 / 32
#: Words a task keeps encoded; beyond it the cache starts afresh.
CACHE_WORDS = 600_000
#: Sequence ids of one task.
TASK_BITS = 36

_GAPS = re.compile(r"\s\s")
_PUNCTUATION = ".,;:!?*&$%#|"


def default_ranks() -> str:
    """Place of the public byte-level BPE ranks."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class WordEncoder(dict):
    """Words to the little-endian uint32 ids of " word"; a missing word is encoded and kept.

    Letters followed by punctuation are two pre-tokens, so such a word is the
    letters' ids and the punctuation's.
    """

    def __init__(self, ranks_file: str, limit: int = CACHE_WORDS):
        import public_tokenizers
        import tiktoken
        super().__init__()
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode, self.piece = encoding.encode_ordinary, encoding._core_bpe.encode_single_piece
        self.tails: dict[str, bytes] = {}
        self.limit = limit

    def __missing__(self, word: str) -> bytes:
        letters = word.rstrip(_PUNCTUATION)
        if not letters.isalpha():
            found = self.whole(" " + word)
        elif len(letters) < len(word):
            found = self[letters] + self.tail(word[len(letters):])
        else:
            found = array("I", self.piece((" " + word).encode())).tobytes()
        if len(self) >= self.limit:
            self.clear()
        self[word] = found
        return found

    def tail(self, marks: str) -> bytes:
        """Ids of punctuation after letters."""
        found = self.tails.get(marks)
        if found is None:
            found = self.whole(marks)
            if len(self.tails) < 10_000:
                self.tails[marks] = found
        return found

    def whole(self, text: str) -> bytes:
        """Ids of a text encoded without the cache."""
        return array("I", self.encode(text)).tobytes()

    def ids(self, text: str) -> bytes:
        """Ids of a text."""
        if not text or _GAPS.search(text) or text[0].isspace() or text[-1].isspace():
            return self.whole(text) if text else b""
        head, *rest = text.split(" ")
        return self.whole(head) + b"".join(map(self.__getitem__, rest))


_encoders: dict[str, WordEncoder] = {}


def encoder_of(ranks_file: str) -> WordEncoder:
    """The encoder of this Python worker; its cache serves all tasks the worker runs."""
    if ranks_file not in _encoders:
        _encoders[ranks_file] = WordEncoder(ranks_file)
    return _encoders[ranks_file]


def class_size(j: int, capacity: int) -> int:
    """Longest piece of class j."""
    return capacity // j


def cut(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """(piece length, class) pieces of a document of ``length`` tokens, in order."""
    pieces = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        j = capacity // rest
        size = class_size(j, capacity)
        if size - rest <= slack * size:
            pieces.append((rest, j))
            break
        size = class_size(j + 1, capacity)
        pieces.append((size, j + 1))
        rest -= size
    return pieces


class Bins:
    """Open sequences of one task: a list of pieces for each class."""

    def __init__(self, first_id: int, capacity: int):
        self.open: dict[int, list[tuple]] = {}
        self.next_id, self.capacity = first_id, capacity

    def add(self, j: int, piece: tuple) -> list[tuple]:
        """Takes a piece (length last); returns the rows of a sequence that it fills."""
        held = self.open.setdefault(j, [])
        held.append(piece)
        return self.close(self.open.pop(j)) if len(held) == j else []

    def close(self, pieces: list[tuple]) -> list[tuple]:
        """Rows of one sequence: pieces with sequence id and offset."""
        rows, offset = [], 0
        for p in pieces:
            rows.append((*p, self.next_id, offset))
            offset += p[-1]
        self.next_id += 1
        return rows

    def rest(self) -> Iterator[list[tuple]]:
        """Sequences of what is left in unfilled classes: largest first, first fit."""
        left = sorted((p for held in self.open.values() for p in held), key=lambda p: -p[-1])
        room: list[int] = []
        bins: list[list[tuple]] = []
        first = 0
        for p in left:
            while first < len(room) and room[first] < 1:
                first += 1
            k = next((i for i in range(first, len(room)) if room[i] >= p[-1]), None)
            if k is None:
                bins.append([])
                room.append(self.capacity)
                k = len(bins) - 1
            bins[k].append(p)
            room[k] -= p[-1]
        self.open = {}
        for b in bins:
            yield self.close(b)


def packer(ranks_file: str, capacity: int, slack: float, end_id: int, with_ids: bool, id_type: pa.DataType) -> Callable:
    """The task function: documents in, packed pieces out."""
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
                       + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(ranks_file)
        bins = Bins(TaskContext.get().partitionId() << TASK_BITS, capacity)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows))
            # a row: id, start, crc, doc_tokens, [ids], length, sequence_id, offset
            order = [0, 1, -3, 2, 3, -2, -1] + [4] * with_ids
            out = pa.RecordBatch.from_arrays([pa.array(cols[i], f.type) for i, f in zip(order, schema)], schema=schema)
            rows.clear()
            return out

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encoder.ids(text.as_py() or "") + end
                total, start = len(ids) // 4, 0
                for length, j in cut(total, capacity, slack):
                    part = ids[4 * start:4 * (start + length)]
                    rows += bins.add(j, (key, start, zlib.crc32(part), total, *((part,) if with_ids else ()), length))
                    start += length
                if len(rows) >= 20_000:
                    yield batch()
        for sequence in bins.rest():
            rows += sequence
        if rows:
            yield batch()

    return run


def sequencer(ranks_file: str, capacity: int, slack: float, end_id: int) -> Callable:
    """The task function that gathers each packed sequence into one row: place, count, ids and document ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me = TaskContext.get().partitionId()
        encoder = encoder_of(ranks_file)
        end = np.array([end_id], "<u4").tobytes()
        bins = Bins(0, capacity)
        done: list[tuple] = []

        def batch() -> pa.RecordBatch:
            ids = [np.frombuffer(b"".join(p[1] for p in s), "<u4") for s in done]
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(done), me, np.int32)), pa.array([s[0][-2] for s in done], pa.int64()), pa.array([len(x) for x in ids], pa.int32()),
                 pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()), pa.array([list(dict.fromkeys(p[0] for p in s if p[0] is not None)) for s in done], pa.list_(pa.int64())),
                 pa.array([x.astype("<u2").tobytes().ljust(2 * capacity, b"\0") for x in ids], pa.binary())],
                ["part", "number", "n_tokens", "ids_crc32", "doc_ids", "ids"])
            done.clear()
            return out

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids, start = encoder.ids(text.as_py() or "") + end, 0
                for length, j in cut(len(ids) // 4, capacity, slack):
                    full = bins.add(j, (key, ids[4 * start:4 * (start + length)], length))
                    done += [full] if full else []
                    start += length
                if len(done) >= 2_000:
                    yield batch()
        done += list(bins.rest())
        if done:
            yield batch()

    return run


def sequences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_file: str | None = None, capacity: int = CAPACITY,
              slack: float = SLACK, end_id: int = END_ID) -> DataFrame:
    """One row per packed sequence: part and number (its place in its task), n_tokens, ids_crc32, doc_ids, ids.

    ``ids`` are little-endian uint16, padded with zeros to ``capacity``; document
    ids are integers, each listed once, NULLs left out.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    fn = sequencer(ranks_file or default_ranks(), capacity, slack, end_id)
    return rows.mapInArrow(fn, "part int, number long, n_tokens int, ids_crc32 long, doc_ids array<long>, ids binary")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_file: str | None = None, capacity: int = CAPACITY,
         slack: float = SLACK, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``with_ids`` adds the piece's ids (little-endian uint32). The partitions of
    ``df`` are the workers; ``ranks_file`` is a path that every executor has.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    out = f"id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    fn = packer(ranks_file or default_ranks(), capacity, slack, end_id, with_ids, to_arrow_type(kind))
    return rows.mapInArrow(fn, out + ", ids binary" * with_ids).withColumnRenamed("id", id_col)
