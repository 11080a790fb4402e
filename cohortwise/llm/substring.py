"""Substring dedup of word sequences with an FM-index for each shard.

Runs of windows that no other document shares are sorted out first (``repeats``). The word
sequences of the runs that stay open are sent to shards by the name of their anchor, so equal
windows meet. A shard holds names up to a bounded number of words; its distinct sequences are
indexed once, and all of them are streamed through a backward search that reports the windows
whose matching statistic reaches the threshold. The smallest document in the interval of a
window tells whether it also starts in an earlier one.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from cohortwise.llm import repeats
from cohortwise.llm.common import kept, tasks
from cohortwise.llm.fm_index import FMIndex, repeated

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words that name an anchor.
ANCHOR = 12
#: Words of a shard's index, before the last name is added.
SHARD_WORDS = 250_000
#: A name with more sequences in one map task, or in its shard, is dealt out window by window.
HOT, GROUP = 200, 3_000
MARK, SEQUENCE, WINDOW, COVER = range(4)
ROWS = "name long, kind int, doc long, tie long, first long, last long, words binary"
REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string, tie long"
Row = tuple[int, int, int, int, int, int, bytes]


def word_names(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def units(data: bytes) -> np.ndarray:
    return word_names(data.split())


def as_batch(rows: list[Row]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        [f.split()[0] for f in ROWS.split(", ")],
    )


def single_windows(rows: list[Row]) -> Iterator[Row]:
    """Every window of the sequences as a row of its own, named by all its words.

    Of equal windows only the smallest document's stays; the others are repeats.
    """
    smallest: dict[bytes, int] = {}
    found: list[tuple[bytes, int, int, int]] = []
    for _, _, doc, tie, first, _, words in rows:
        parts = words.split()
        for i in range(len(parts) - repeats.SPAN + 1):
            window = b" ".join(parts[i:i + repeats.SPAN])
            smallest[window] = min(doc, smallest.get(window, doc))
            found.append((window, doc, tie, first + i))
    for window, doc, tie, first in found:
        name = signed(xxhash.xxh3_64_intdigest(window))
        if doc > smallest[window]:
            yield name, COVER, doc, tie, first, first + repeats.SPAN, b""
        else:
            yield name, WINDOW, doc, tie, first, first + repeats.SPAN, window


def signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def sequences(texts: DataFrame, places: DataFrame) -> DataFrame:
    """The words of the open runs, by the name of their anchor, and the covers found so far."""
    def deal(rows: list[Row]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for row in rows:
            counts[row[0]] = counts.get(row[0], 0) + (row[1] == SEQUENCE)
        hot = {name for name, n in counts.items() if n > HOT}
        out = [r for r in rows if r[1] != SEQUENCE or r[0] not in hot]
        out += [(name, MARK, 0, 0, 0, 0, b"") for name in hot]
        out += single_windows([r for r in rows if r[1] == SEQUENCE and r[0] in hot])
        for at in range(0, len(out), 10_000):
            yield as_batch(out[at:at + 10_000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[Row] = []
        words: dict[int, list[bytes]] = {}
        settled: list[Row] = []
        seen: set[int] = set()

        def items():
            for batch in batches:
                for tie, doc, _, data, covers, opens in zip(*batch.columns):
                    tie, doc = tie.as_py(), doc.as_py()
                    settled.extend(
                        (signed(tie * 0x9E3779B97F4A7C15 % 2**64), COVER, doc, tie, a, b, b"")
                        for a, b in repeats.pairs(covers.as_py()).tolist()
                    )
                    ranges = repeats.pairs(opens.as_py())
                    if len(ranges):
                        words[tie] = data.as_py().split()
                        yield (word_names(words[tie]), tie, doc,
                               np.concatenate([np.arange(a, b) for a, b in ranges]))

        for chunk in repeats.chunked(items()):
            found = repeats.runs(chunk, ANCHOR)
            for name, doc, tie, at in zip(*(found[c].tolist() for c in ("name", "doc", "tie", "at"))):
                first, last = at >> 8, (at >> 8) + (at & 255) + repeats.SPAN
                rows.append((name, SEQUENCE, doc, tie, first, last, b" ".join(words[tie][first:last])))
            # A document in parts is in the next chunk too; those before it are done.
            for tie in seen - set(chunk.ties.tolist()):
                del words[tie]
            seen = set(chunk.ties.tolist())
            if len(rows) > 10_000:
                yield from deal(rows + settled)
                rows, settled[:] = [], []
        if rows or settled:
            yield from deal(rows + settled)

    return texts.join(places.hint("shuffle_hash"), ["tie", "doc"]).select(
        "tie", "doc", "doc_id", "data", "covers", "opens"
    ).mapInArrow(run, ROWS)


def search_shard(rows: list[Row]) -> Iterator[Row]:
    """Covers of the sequences of one shard; ``rows`` are sorted by document within a name."""
    numbers: dict[bytes, int] = {}
    owners: list[int] = []
    for row in rows:
        if row[6] in numbers:
            owners[numbers[row[6]]] = min(owners[numbers[row[6]]], row[2])
        else:
            numbers[row[6]] = len(owners)
            owners.append(row[2])
    vocabulary: dict[bytes, int] = {}
    split = [words.split() for words in numbers]
    for parts in split:
        for word in parts:
            vocabulary.setdefault(word, len(vocabulary) + len(split))
    # Each sequence ends in a separator of its own, so no match crosses it.
    text = np.array([x for i, parts in enumerate(split)
                     for x in (*[vocabulary[w] for w in parts], i)], dtype=np.int64)
    sizes = np.array([len(parts) + 1 for parts in split])
    starts = np.cumsum(sizes) - sizes
    windows = sizes - repeats.SPAN
    ends = np.repeat(starts - np.cumsum(windows) + windows, windows)
    ends += np.arange(len(ends)) + repeats.SPAN
    index = FMIndex(text)
    pattern, first, last = repeated(index, text, ends, repeats.SPAN)
    earliest = np.repeat(np.array(owners, dtype=np.int64), windows)
    if len(pattern):
        owner = np.repeat(np.array(owners), sizes)[index.places]
        # Intervals of patterns of one length are equal or disjoint.
        left, which = np.unique(first, return_inverse=True)
        right = np.zeros(len(left), dtype=np.int64)
        right[which] = last
        cuts = np.ravel(np.stack((left, right), axis=1))
        owner = np.append(owner, repeats.NO_ID)
        earliest[pattern] = np.minimum.reduceat(owner, cuts)[::2][which]
    offsets = np.cumsum(windows) - windows
    for row in rows:
        number = numbers[row[6]]
        mine = earliest[offsets[number]:offsets[number] + windows[number]] < row[2]
        at = np.flatnonzero(mine)
        if len(at):
            new = np.flatnonzero(np.diff(at, prepend=-2 * repeats.SPAN) > repeats.SPAN)
            stop = at[np.append(new[1:], len(at)) - 1] + repeats.SPAN
            for a, b in zip(at[new].tolist(), stop.tolist()):
                yield row[0], COVER, row[2], row[3], row[4] + a, row[4] + b, b""


def search(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Search shard by shard; rows are sorted by name, kind and document.

    In the first round sequences of hot names leave as single windows; covers pass through.
    """
    block: list[Row] = []
    group: list[Row] = []
    size = 0
    name: int | None = None
    hot = False
    previous: tuple[bytes, int] | None = None

    def close() -> Iterator[pa.RecordBatch]:
        found = list(search_shard(block)) if block else []
        block.clear()
        if found:
            yield as_batch(found)

    for batch in batches:
        passed: list[Row] = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != name:
                block += group
                group, name, hot, previous = [], row[0], False, None
                if size > SHARD_WORDS:
                    yield from close()
                    size = 0
            if row[1] == MARK:
                hot = True
            elif row[1] == COVER or row[1] == WINDOW and not last:
                passed.append(row)
            elif hot and not last:
                passed += single_windows([row])
            elif last and previous is not None and row[6] == previous[0]:
                # Equal to the window before it: that document is the smallest.
                if row[2] > previous[1]:
                    passed.append((row[0], COVER, row[2], row[3], row[4], row[5], b""))
            else:
                previous = (row[6], row[2])
                group.append(row)
                size += row[5] - row[4]
                if not last and len(group) > GROUP:
                    hot = True
                    size -= sum(r[5] - r[4] for r in group)
                    passed += single_windows(group)
                    group = []
        if passed:
            yield as_batch(passed)
    block += group
    yield from close()


def remainders(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Take the covered words out of every text and describe what is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tie, _, doc_id, data, covers in zip(*batch.columns):
                words, left, at = data.as_py().split(), [], 0
                for a, b in repeats.pairs(covers.as_py() or b"").tolist():
                    left += words[at:a]
                    at = b
                left += words[at:]
                rows.append((
                    doc_id.as_py(), len(words), len(words) - len(left),
                    hashlib.sha256(b" ".join(left)).hexdigest(), tie.as_py(),
                ))
            kinds = [*[pa.int64()] * 3, pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows
                else [pa.array([], k) for k in kinds],
                [f.split()[0] for f in REPORT.split(", ")],
            )

    return texts.join(places.hint("shuffle_hash"), ["tie", "doc"], "left").select(
        "tie", "doc", "doc_id", "data", "covers"
    ).mapInArrow(run, REPORT)


def word_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, and tie.

    Words are runs without ASCII white space. A word goes if a window of 50 words over it also
    starts in a document with a smaller id, judged on the input. Null text has no words; texts
    under 50 words stay whole. Rows with equal ids are documents of their own and remove
    nothing from each other; a null id counts as larger than any other. An empty table gives
    no rows; other columns are dropped.
    """
    n = tasks(docs.sparkSession)
    texts = repeats.numbered(docs, doc_id, text)
    places = kept(repeats.settled(repeats.first_pass(texts, units, ANCHOR)))
    rows = sequences(texts, places)
    for final in (False, True):
        rows = rows.repartition(n, "name").sortWithinPartitions("name", "kind", "doc").mapInArrow(
            lambda batches, final=final: search(batches, final), ROWS
        )
    covers = rows.selectExpr("tie", "doc", f"{repeats.COVER} AS kind", "first", "last")
    done = covers.repartition(n, "tie").sortWithinPartitions("tie").mapInArrow(
        repeats.gather, "tie long, doc long, covers binary, opens binary"
    )
    return remainders(texts, done.select("tie", "doc", "covers"))
