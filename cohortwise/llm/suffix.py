"""Substring dedup by distributed prefix doubling, on sampled suffixes.

Ranks of the prefixes of length 18, 34 and 50 are settled one after the other. A rank is the
name of a pair of shorter ranks, the second one at a growing offset; Spark sorts the names,
positions whose name is unique drop out, and at the threshold equal names are repeats. Sorting
every byte position would shuffle many times the input, so a level sorts only the smallest
rank among the prefixes that lie in a 50-byte window (``repeats``): equal windows have equal
smallest ranks, hence none is lost, and at length 50 each open window stands for itself.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from cohortwise.llm import repeats
from cohortwise.llm.common import kept

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Prefix lengths; the last is the length of a repeat.
LENGTHS = (18, 34, 50)
REPORT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, tie long"
)


#: A name for each byte.
BYTE_NAMES = np.random.default_rng(50).integers(0, 2**64, 256, dtype=np.uint64)


def units(data: bytes) -> np.ndarray:
    return BYTE_NAMES[np.frombuffer(data, dtype=np.uint8)]


def longer_prefixes(texts: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """Rows of ``repeats.find`` for the windows still open, and the covers found so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled: list[tuple[int, int, np.ndarray]] = []

        def items():
            for batch in batches:
                for tie, doc, _, data, covers, opens in zip(*batch.columns):
                    tie, doc = tie.as_py(), doc.as_py()
                    if len(done := repeats.pairs(covers.as_py())):
                        settled.append((tie, doc, done))
                    ranges = repeats.pairs(opens.as_py())
                    if len(ranges):
                        windows = np.concatenate([np.arange(a, b) for a, b in ranges])
                        yield units(data.as_py()), tie, doc, windows

        def passed() -> Iterator[pa.RecordBatch]:
            if settled:
                sizes = [len(r) for _, _, r in settled]
                tie = np.repeat([t for t, _, _ in settled], sizes)
                doc = np.repeat([d for _, d, _ in settled], sizes)
                ranges = np.concatenate([r for _, _, r in settled])
                settled.clear()
                rows = repeats.covers(tie, doc, ranges[:, 0], ranges[:, 1])
                yield repeats.as_batch(rows, repeats.ROWS)

        for found in repeats.find(repeats.chunked(items()), k):
            yield found
            yield from passed()
        yield from passed()

    return texts.join(places.hint("shuffle_hash"), ["tie", "doc"]).select(
        "tie", "doc", "doc_id", "data", "covers", "opens"
    ).mapInArrow(run, repeats.ROWS)


def remainders(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Cut the covers out of every text and describe what is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tie, _, doc_id, data, covers in zip(*batch.columns):
                data, at, left, gone = data.as_py(), 0, hashlib.sha256(), 0
                ranges = repeats.pairs(covers.as_py() or b"").tolist()
                for a, b in ranges:
                    left.update(data[at:a])
                    gone, at = gone + b - a, b
                left.update(data[at:])
                rows.append((
                    doc_id.as_py(), len(data), gone, len(ranges), left.hexdigest(), tie.as_py()
                ))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows
                else [pa.array([], k) for k in kinds],
                [f.split()[0] for f in REPORT.split(", ")],
            )

    return texts.join(places.hint("shuffle_hash"), ["tie", "doc"], "left").select(
        "tie", "doc", "doc_id", "data", "covers"
    ).mapInArrow(run, REPORT)


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and tie.

    A byte goes if a 50-byte string over it also starts in a document with a smaller id,
    judged on the input. Null text is the empty text; texts under 50 bytes stay whole. Rows
    with equal ids are documents of their own and remove nothing from each other, though both
    lose to a smaller id; a null id counts as larger than any other. An empty table gives no
    rows; other columns are dropped.

    Names are 64-bit hashes of pairs of names, two of them for each run of windows.
    """
    texts = repeats.numbered(docs, doc_id, text)
    places = repeats.settled(repeats.first_pass(texts, units, LENGTHS[0]))
    for k in LENGTHS[1:]:
        # A level's shuffle files go before the next one writes its own.
        places = repeats.settled(longer_prefixes(texts, kept(places), k), last=k == LENGTHS[-1])
    return remainders(texts, places)
