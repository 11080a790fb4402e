"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Longer texts are cut at safe boundaries before they reach the library.
LONG_CHARS = 100_000
#: Places that every match of the split pattern respects: white space after anything else, and
#: a change of class after an ASCII letter or digit.
SAFE = re.compile(r"(?<=[!-~])(?=[ \n])|(?<=[A-Za-z])(?=[0-9 -/:-@\n])|(?<=[0-9])(?=[A-Za-z -/:-@\n])")


def rank_file(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        path, pat_str=pattern, mergeable_ranks=rank_file(path), special_tokens={}
    )


def pieces(text: str, limit: int = LONG_CHARS) -> Iterator[str]:
    """Cut at the first safe boundary after each ``limit`` characters; texts without one stay whole."""
    start = 0
    while len(text) - start > limit:
        cut = SAFE.search(text, start + limit)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode(encoding: tiktoken.Encoding, text: str, limit: int = LONG_CHARS) -> list[int]:
    if len(text) <= limit:
        return encoding.encode_ordinary(text)
    return [i for part in pieces(text, limit) for i in encoding.encode_ordinary(part)]


def encode_texts(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: doc_id, ids (array of int) and the decoded bytes. Null text is the empty text.

    A pure map: no shuffle, one Arrow batch in memory at a time. Repeated rows and null ids
    are kept as they are; other columns are dropped.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(path, pattern)
        for batch in batches:
            texts = batch.column(1)
            step = 256
            for at in range(0, batch.num_rows, step):
                ids = [encode(encoding, t or "") for t in texts.slice(at, step).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, step), pa.array(ids, schema.field(1).type),
                    pa.array([encoding.decode_bytes(x) for x in ids], pa.binary()),
                ], schema=schema)

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digest_texts(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Digests are taken where the ids are made, so ids of a whole corpus never travel. The
    treatment of rows is that of :func:`encode_texts`.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(path, pattern)
        decimal = [str(i) for i in range(encoding.n_vocab)]
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            counts, first, second = [], [], []
            for value in batch.column(1):
                ids = encode(encoding, value.as_py() or "")
                counts.append(len(ids))
                first.append(sha(",".join([decimal[i] for i in ids]).encode()))
                second.append(sha(encoding.decode_bytes(ids)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()),
                pa.array(second, pa.string()),
            ], schema=schema)

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
