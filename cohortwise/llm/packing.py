"""Sum-of-squares packing of tokenised documents into windows of fixed length.

Every task packs the rows it reads, online. A document longer than a window gives full windows
and a rest; each rest goes to the fill level whose choice makes the sum of squares of the level
array smallest. The array counts the partially filled windows per level. What is left open at
the end of a task is laid end to end and cut at the window length, so a task pads one window at
most. Nothing crosses tasks: no shuffle, and a task that runs again packs the same way.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 1024
#: Windows of one task are numbered from its number times this.
TASK_WINDOWS = 2**36
#: Fixed value: how byte-level BPE splits a text before it merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
UNUSUAL = re.compile("[^\x00-\u024f]")
SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
])


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as the tokenizers library gives them for a byte-level BPE file.

    The library takes over twice the time the budget allows, so texts whose characters every
    Unicode version classes alike go through the merges of the same file in tiktoken, which
    gives the same ids. All others, and texts with the file's special tokens, go through the
    library itself.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as lines:
            file = json.load(lines)
        self.path = path
        self.special = sorted(t["content"] for t in file["added_tokens"])
        byte = byte_characters()
        ranks = {
            bytes(byte[c] for c in word): number for word, number in file["model"]["vocab"].items()
            if word not in self.special
        }
        self.quick = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.library: Tokenizer | None = None

    def plain(self, text: str) -> bool:
        return (text.isascii() or not UNUSUAL.search(text)) and not any(
            s in text for s in self.special
        )

    def whole(self, text: str) -> list[int]:
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        ids = self.quick.encode_ordinary(text) if self.plain(text) else self.whole(text)
        return array("I", ids).tobytes()


class SumOfSquares:
    """Online packing with a level array: ``levels[h]`` windows are filled to ``h``."""

    def __init__(self, window: int = WINDOW) -> None:
        self.window = window
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: list[deque[int]] = [deque() for _ in range(window + 1)]
        self.made = 0

    def new(self) -> int:
        self.made += 1
        return self.made - 1

    def place(self, size: int) -> tuple[int, int]:
        """Number and offset of the window for an item; least growth of the sum of squares.

        Moving a window from level h to h + size changes the sum by 2 (n[h+size] - n[h]) + 2,
        filling one up by 1 - 2 n[h], and opening one by 2 n[size] + 1. Ties go to the fuller
        window.
        """
        if size == self.window:
            return self.new(), 0
        n, full = self.levels, self.window - size
        growth = 2 * (n[size:self.window] - n[:full]) + 2
        growth = np.append(growth, 1 - 2 * n[full])
        growth[0] = 2 * n[size] + 1
        growth[1:][n[1:full + 1] == 0] = np.iinfo(np.int64).max
        level = full - int(np.argmin(growth[::-1]))
        number = self.open[level].popleft() if level else self.new()
        n[level] -= level > 0
        if level + size < self.window:
            n[level + size] += 1
            self.open[level + size].append(number)
        return number, level


def pack_rows(
    encoded: Iterable[tuple[int | None, bytes]], window: int, first: int,
) -> Iterator[tuple]:
    """Pieces of (doc_id, little-endian ids) in packed order; see the module's text."""
    packer = SumOfSquares(window)
    waiting: dict[int, list[tuple]] = {}
    for doc, data in encoded:
        total = len(data) // 4
        for start in range(0, total, window):
            piece = data[4 * start:4 * (start + window)]
            size = len(piece) // 4
            if size == window:
                yield (doc, start, size, zlib.crc32(piece), total, first + packer.new(), 0)
                continue
            number, level = packer.place(size)
            rows = waiting.setdefault(number, [])
            rows.append((doc, start, piece, total))
            if level + size == window:
                yield from laid_out(waiting.pop(number), first + number)
    yield from rest(list(waiting.values()), window, lambda: first + packer.new())


def laid_out(rows: list[tuple], sequence: int) -> Iterator[tuple]:
    offset = 0
    for doc, start, piece, total in rows:
        size = len(piece) // 4
        yield doc, start, size, zlib.crc32(piece), total, sequence, offset
        offset += size


def rest(groups: list[list[tuple]], window: int, number: Callable[[], int]) -> Iterator[tuple]:
    """Lay open windows end to end and cut where a window is full."""
    rows: list[tuple] = []
    filled = 0
    for doc, start, piece, total in (row for group in groups for row in group):
        while piece:
            part = piece[:4 * (window - filled)]
            rows.append((doc, start, part, total))
            filled += len(part) // 4
            start, piece = start + len(part) // 4, piece[len(part):]
            if filled == window:
                yield from laid_out(rows, number())
                rows, filled = [], 0
    if rows:
        yield from laid_out(rows, number())


def pack(
    docs: DataFrame, path: str, window: int = WINDOW, end: int = 0,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path`` names the tokenizer's file, ``end`` is the id after each document. Null and empty
    texts hold that id alone. Rows with a null or repeated id are packed like all others. An
    empty table gives no rows. Sequence numbers are unique, not gapless. A task holds its
    partially filled windows - in practice a few thousand ids for each - and one batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encoder = Encoder(path)
        tail = array("I", [end]).tobytes()

        def encoded() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                for doc, value in zip(batch.column(0), batch.column(1)):
                    yield doc.as_py(), encoder.encode(value.as_py() or "") + tail

        rows: list[tuple] = []
        first = TaskContext.get().partitionId() * TASK_WINDOWS
        for row in pack_rows(encoded(), window, first):
            rows.append(row)
            if len(rows) == 20_000:
                yield as_batch(rows)
                rows = []
        if rows:
            yield as_batch(rows)

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long"
    )


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), pa.int64()) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays(columns, schema=SCHEMA)
