"""Finding where documents repeat each other, without comparing every position.

A document is a sequence of units, bytes or words. Of the ``SPAN - k + 1`` names of length k
inside a window of SPAN units the smallest is its anchor, which depends on the window's content
alone. Windows in a row with one anchor form a run. Equal windows have anchors of equal name,
so runs whose anchor's name no other run shares are done; of runs that are equal as a whole,
all but those of the smallest document are repeats. What stays open goes to the operator, which
decides window by window.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from cohortwise.llm.common import addressed, place, tasks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPAN = 50
#: Units hashed at a time, and runs compared within a task before anything is shuffled.
CHUNK, LOCAL_RUNS = 250_000, 800_000
#: A name with more runs in one task than this is hot: its runs skip the name's group.
HOT = 200
#: Rows of one name held by a task; a longer group is decided window by window.
HELD = 500_000
#: Order of the rows of one name.
MARK, RUN, COVER, OPEN = range(4)
#: Verdict on a hot name of a document at the last length: its windows of that name are repeats.
GONE = 4
#: ``at`` of a run that stands for all windows of a hot name in a document, at the last length.
ALL = -1
#: Stands for a missing id: larger than any other.
NO_ID = 2**63 - 1
ROWS = "name long, kind int, whole long, doc long, tie long, at long"
PLACES = "tie long, doc long, kind int, first long, last long"
C1, C2, C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit name for each pair of names."""
    x = a * C1
    x += (b ^ (b >> np.uint64(31))) * C2
    x ^= x >> np.uint64(29)
    x *= C3
    x ^= x >> np.uint64(32)
    return x


def names(units: np.ndarray, k: int, second: bool = False) -> np.ndarray:
    """Name of the k units from each position, by doubling; ``second`` gives another 64 bits."""
    out, length = mix(units, ~units) if second else units, 1
    while length < k:
        step = min(length, k - length)
        out = mix(out[:len(out) - step], out[step:])
        length += step
    return out


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    out, length = values, 1
    while length < width:
        step = min(length, width - length)
        out = np.minimum(out[:len(out) - step], out[step:])
        length += step
    return out


class Chunk(NamedTuple):
    """Documents laid end to end: units, ends, row numbers, ids, windows to look at (or all).

    ``windows`` are places in the chunk in ascending order, ``number`` their documents. A part
    of a long document starts ``shift`` units after the document.
    """

    units: np.ndarray
    ends: np.ndarray
    ties: np.ndarray
    docs: np.ndarray
    windows: np.ndarray | None = None
    number: np.ndarray | None = None
    shift: int = 0


Columns = dict[str, np.ndarray]


def columns(**values: np.ndarray | int) -> Columns:
    """Equal-length columns; single numbers are repeated."""
    size = max((len(v) for v in values.values() if isinstance(v, np.ndarray)), default=0)
    return {
        k: v.view(np.int64) if isinstance(v, np.ndarray) else np.full(size, v, dtype=np.int64)
        for k, v in values.items()
    }


def joined(parts: list[Columns]) -> Columns:
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def taken(rows: Columns, which: np.ndarray) -> Columns:
    return {k: v[which] for k, v in rows.items()}


def narrowed(units: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units that some ascending windows cover, and where the windows start among them."""
    new = np.flatnonzero(np.diff(windows, prepend=-SPAN) >= SPAN)
    start, end = windows[new], windows[np.append(new[1:], len(windows)) - 1] + SPAN
    edge = np.zeros(len(units) + 1, dtype=np.int8)
    edge[start] = 1
    edge[end] -= 1
    size = end - start
    before = np.repeat(np.cumsum(size) - size - start, np.diff(np.append(new, len(windows))))
    return units[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)], windows + before


def runs(chunk: Chunk, k: int) -> Columns:
    """Runs of a chunk of fewer than 2**24 units: doc, tie, at, name, whole.

    ``at`` is the first window, within its document, times 256 plus the number of further ones.
    At length ``SPAN`` a run is one window, and ``whole`` its second name: 128 bits decide.
    """
    starts = np.concatenate(([0], chunk.ends[:-1]))
    at, number = chunk.windows, chunk.number
    if at is None:
        count = np.maximum(chunk.ends - starts - SPAN + 1, 0)
        number = np.repeat(np.arange(len(count)), count)
        at = np.arange(count.sum()) + np.repeat(starts - np.cumsum(count) + count, count)
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return columns(doc=none, tie=none, at=none, name=none, whole=none)
    units, place = (chunk.units, at) if chunk.windows is None else narrowed(chunk.units, at)
    short = names(units, k)
    key = (short & ~np.uint64(2**24 - 1)) | np.arange(len(short), dtype=np.uint64)
    anchor = (sliding_minimum(key, SPAN - k + 1) & np.uint64(2**24 - 1)).astype(np.int64)[place]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (number[1:] != number[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at))) - 1
    number, anchor, at, first = number[first], anchor[first], at[first], place[first]

    def long(place: np.ndarray) -> np.ndarray:
        out = short[place]
        for step in [*range(k, SPAN - k, k), SPAN - k]:
            out = mix(short[place + step], out)
        return out

    if k == SPAN:
        whole = names(units, k, second=True)[first]
    else:
        # The first and the last window of a run overlap, so they and their distance name all of it.
        whole = mix(mix(long(first), long(first + size)), size.astype(np.uint64))
    return columns(
        doc=chunk.docs[number], tie=chunk.ties[number],
        at=(at - starts[number] + chunk.shift) * 256 + size, name=short[anchor], whole=whole,
    )


def changes(*values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values[0]), dtype=bool)
    out[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
    return out


def alone(values: np.ndarray) -> np.ndarray:
    """Which of the sorted values differ from both neighbours."""
    new = np.append(changes(values), True) if len(values) else np.ones(1, dtype=bool)
    return new[:-1] & new[1:]


def merged(tie: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Maximal ranges [first, last) per row: columns tie, first, last."""
    if not len(tie):
        return np.zeros((3, 0), dtype=np.int64)
    order = np.lexsort((first, tie))
    tie, first, last = tie[order], first[order], last[order]
    group = np.cumsum(changes(tie)) - 1
    wide = np.int64(last.max() + 2)
    far = np.maximum.accumulate(last + group * wide)
    new = np.ones(len(tie), dtype=bool)
    new[1:] = (first + group * wide)[1:] > far[:-1]
    at = np.flatnonzero(new)
    end = far[np.append(at[1:], len(tie)) - 1] - group[at] * wide
    return np.stack((tie[at], first[at], end))


def spread_by(tie: np.ndarray) -> np.ndarray:
    """A name that deals rows out by document."""
    return mix(tie.view(np.uint64), np.zeros(len(tie), dtype=np.uint64))


def of_both(rows: Columns) -> np.ndarray:
    """One name for both names of a window, to tell apart the windows of one document."""
    return mix(rows["name"].view(np.uint64), rows["whole"].view(np.uint64)).view(np.int64)


def kept_rows(kind: int, rows: Columns, last: bool = False) -> Columns:
    """Runs that travel by document, with :func:`of_both` in ``whole`` at the last length."""
    return columns(
        name=spread_by(rows["tie"]), kind=kind, whole=of_both(rows) if last else np.zeros(len(rows["tie"]), dtype=np.int64),
        doc=rows["doc"], tie=rows["tie"], at=rows["at"],
    )


def covers(tie: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> Columns:
    """Cover rows of merged ranges; ``whole`` is where a range starts and ``at`` where it ends."""
    ranges = merged(tie, first, last)
    known, place = np.unique(tie, return_index=True)
    owner = doc[place[np.searchsorted(known, ranges[0])]] if len(known) else ranges[0]
    return columns(
        name=spread_by(ranges[0]), kind=COVER, whole=ranges[1], doc=owner, tie=ranges[0], at=ranges[2]
    )


def within_task(rows: Columns, last: bool = False) -> Columns:
    """What a task can settle on its own: the smallest document of each run stays.

    At the last length no later one decides on a hot name, so one row for each of its windows'
    contents and a document asks for the verdict, and the windows wait with the document.
    """
    # A name of one run in the task says nothing yet; those rows stay in the order of the text.
    order = np.argsort(rows["name"])
    once = np.empty(len(order), dtype=bool)
    once[order] = alone(rows["name"][order])
    single = {**taken(rows, once), "kind": np.full(np.count_nonzero(once), RUN)}
    rows = taken(rows, order[~once[order]])
    rows = taken(rows, np.lexsort((rows["doc"], rows["whole"], rows["name"])))
    name, whole, doc = rows["name"], rows["whole"], rows["doc"]
    new = changes(name, whole)
    start = np.flatnonzero(new)
    smallest = doc[start][np.cumsum(new) - 1]
    later = doc > smallest
    first = rows["at"] >> 8
    gone = taken(rows, later)
    done = covers(
        gone["tie"], gone["doc"], first[later], (first + (rows["at"] & 255) + SPAN)[later]
    )
    rows = taken(rows, ~later)
    fresh = changes(rows["name"]) if len(rows["name"]) else np.zeros(0, dtype=bool)
    group = np.cumsum(fresh) - 1
    hot = np.bincount(group)[group] > HOT if len(group) else fresh
    run = taken(rows, ~hot)
    if last:
        rows = taken(rows, hot)
        rows = taken(rows, np.lexsort((rows["tie"], rows["whole"], rows["name"])))
        ask = taken(rows, changes(rows["name"], rows["whole"], rows["tie"]))
        return joined([
            done, kept_rows(OPEN, rows, last), columns(**{**ask, "kind": RUN, "at": ALL}),
            columns(**{**run, "kind": RUN}), single,
        ])
    mark = taken(rows, np.flatnonzero(fresh & hot))
    none = np.zeros(len(mark["name"]), dtype=np.int64)
    return joined([
        done, kept_rows(OPEN, taken(rows, hot)),
        columns(name=mark["name"], kind=MARK, whole=none, doc=none, tie=none, at=none),
        columns(**{**run, "kind": RUN}), single,
    ])


def as_batch(rows: Columns, order: str) -> pa.RecordBatch:
    fields = [f.split() for f in order.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[n].astype(kinds[t].to_pandas_dtype()), kinds[t]) for n, t in fields],
        [n for n, _ in fields],
    )


def find(chunks: Iterator[Chunk], k: int) -> Iterator[pa.RecordBatch]:
    """Rows for :func:`rank` from the chunks of a task."""
    held: list[Columns] = []
    size = 0
    for chunk in chunks:
        held.append(runs(chunk, k))
        size += len(held[-1]["name"])
        if size >= LOCAL_RUNS:
            yield as_batch(within_task(joined(held), k == SPAN), ROWS)
            held, size = [], 0
    if size:
        yield as_batch(within_task(joined(held), k == SPAN), ROWS)


def arranged(rows: Columns, hot: bool = False) -> Columns:
    """Rows sorted by name in the order that :func:`settle` takes.

    A run whose name no other row has is done and left out, unless its name is ``hot``.
    """
    run = rows["kind"] < COVER
    shared = taken(rows, run if hot else run & ~alone(rows["name"]))
    shared = taken(shared, np.lexsort((shared["doc"], shared["whole"], shared["kind"], shared["name"])))
    return joined([shared, taken(rows, ~run)])


def settle(
    rows: Columns, hot: bool = False, last: bool = False, least: tuple[int, int] | None = None,
) -> Columns:
    """Repeats and open runs among all rows of some names, sorted by name, kind, whole, doc.

    Covers and open rows pass through, wherever they stand. At the last length nothing stays open but the windows of hot names, which wait for the
    verdict: an OPEN row has its :func:`of_both` in place of the end, a GONE row in place of the
    start. Where these rows are a later part of a name, ``least`` is the ``whole`` that the part
    before ended with, and its smallest document.
    """
    kind, at = rows["kind"], rows["at"]
    by_name = changes(rows["name"])
    group = np.cumsum(by_name) - 1
    run = kind == RUN
    new = changes(rows["name"], kind, rows["whole"]) & run
    start = np.flatnonzero(new)
    smallest = np.zeros(len(kind), dtype=np.int64)
    if len(start):
        smallest = rows["doc"][start][np.maximum(np.cumsum(new) - 1, 0)]
    if least is not None:
        smallest[run & (rows["whole"] == least[0])] = least[1]
    later = run & (rows["doc"] > smallest)
    passed = kind == COVER
    first = at >> 8
    waiting = kind == OPEN
    asked = later & (at == ALL) if last else np.zeros(len(kind), dtype=bool)
    later &= ~asked
    parts = [
        columns(tie=rows["tie"][w], doc=rows["doc"][w], kind=COVER, first=a[w], last=b[w])
        for w, a, b in (
            (later, first, first + (at & 255) + SPAN), (passed, rows["whole"], at),
        )
    ]
    if last:
        parts += [
            columns(tie=rows["tie"][w], doc=rows["doc"][w], kind=k, first=a[w], last=b[w])
            for k, w, a, b in (
                (OPEN, waiting, first, rows["whole"]), (GONE, asked, of_both(rows), at),
            )
        ]
        return joined(parts)
    several = np.bincount(group, new) > 1
    several |= np.bincount(group, kind == MARK) > 0
    still = run & ~later & (several[group] | hot) | waiting
    parts.append(columns(
        tie=rows["tie"][still], doc=rows["doc"][still], kind=OPEN, first=first[still],
        last=(first + (at & 255) + 1)[still],
    ))
    return joined(parts)


def rank(batches: Iterator[pa.RecordBatch], last: bool = False) -> Iterator[pa.RecordBatch]:
    """Settle rows sorted by name, at the last length by name, kind, whole, doc.

    A name over ``HELD`` rows comes in parts. The parts are left open, or at the last length a
    part tells the next one the smallest document of the content that it ends with.
    """
    def outcome(rows: Columns, hot: bool = False, least: tuple[int, int] | None = None) -> pa.RecordBatch:
        return as_batch(settle(rows if last else arranged(rows, hot), hot, last, least), PLACES)

    held: Columns | None = None
    hot: int | None = None
    least: tuple[int, int] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {n: np.asarray(c).astype(np.int64) for n, c in zip(batch.schema.names, batch.columns)}
        rows = rows if held is None else joined([held, rows])
        cut = int(np.searchsorted(rows["name"], rows["name"][-1]))
        more = taken(rows, slice(0, cut))
        held = taken(rows, slice(cut, None))
        if hot is not None and cut:
            size = int(np.searchsorted(more["name"], hot, side="right"))
            yield outcome(taken(more, slice(0, size)), True, least)
            more, hot, least = taken(more, slice(size, None)), None, None
        if len(more["name"]):
            yield outcome(more)
        if len(held["name"]) > HELD:
            if hot is not None and held["name"][0] != hot:
                least = None
            hot = int(held["name"][0])
            yield outcome(held, True, least)
            runs_held = np.flatnonzero(held["kind"] == RUN)
            if last and len(runs_held):
                whole = held["whole"][runs_held]
                if least is None or whole[-1] != least[0]:
                    least = int(whole[-1]), int(held["doc"][runs_held[whole == whole[-1]][0]])
            held = None
    if held is not None and len(held["name"]):
        same = held["name"][0] == hot
        yield outcome(held, same, least if same else None)


def judged(rows: Columns) -> Columns:
    """Covers of the last length: open windows whose content has a verdict in their document join them."""
    gone, waiting = (taken(rows, rows["kind"] == k) for k in (GONE, OPEN))
    asked = np.rec.fromarrays([gone["tie"], gone["first"]], names="tie,name")
    windows = np.rec.fromarrays([waiting["tie"], waiting["last"]], names="tie,name")
    repeated = taken(waiting, np.isin(windows, asked))
    return joined([
        taken(rows, rows["kind"] == COVER),
        {**repeated, "kind": np.full(len(repeated["tie"]), COVER), "last": repeated["first"] + SPAN},
    ])


def gather(batches: Iterator[pa.RecordBatch], last: bool = False) -> Iterator[pa.RecordBatch]:
    """One row per document from rows sorted by tie: merged covers and open windows, as binary."""
    def rows_of(rows: Columns) -> pa.RecordBatch:
        if last:
            rows = judged(rows)
            rows = taken(rows, np.argsort(rows["tie"], kind="stable"))
        if not len(rows["tie"]):
            return pa.RecordBatch.from_arrays(
                [pa.array([], k) for k in (pa.int64(), pa.int64(), pa.binary(), pa.binary())],
                ["tie", "doc", "covers", "opens"],
            )
        start = np.flatnonzero(changes(rows["tie"]))
        ties, docs = rows["tie"][start], rows["doc"][start]
        blobs = []
        for kind in (COVER, OPEN):
            mine = taken(rows, rows["kind"] == kind)
            ranges = merged(mine["tie"], mine["first"], mine["last"])
            cuts = np.searchsorted(ranges[0], ties, side="left").tolist() + [ranges.shape[1]]
            pairs = np.ascontiguousarray(ranges[1:].T)
            blobs.append([pairs[a:b].tobytes() for a, b in zip(cuts, cuts[1:])])
        return pa.RecordBatch.from_arrays([
            pa.array(ties), pa.array(docs), pa.array(blobs[0], pa.binary()),
            pa.array(blobs[1], pa.binary()),
        ], ["tie", "doc", "covers", "opens"])

    held: Columns | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {n: np.asarray(c).astype(np.int64) for n, c in zip(batch.schema.names, batch.columns)}
        rows = rows if held is None else joined([held, rows])
        cut = int(np.searchsorted(rows["tie"], rows["tie"][-1]))
        if cut:
            yield rows_of(taken(rows, slice(0, cut)))
        held = taken(rows, slice(cut, None))
    if held is not None:
        yield rows_of(held)


def pairs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.int64).reshape(-1, 2)


def settled(found: DataFrame, last: bool = False) -> DataFrame:
    """tie, doc, covers, opens of each document with any, from rows of :func:`find`.

    Spark sorts the names; a name's rows are settled where they meet and the outcome goes to
    the document's task. ``last`` is for rows of length ``SPAN``, after which none is open.
    Spark's radix sort takes one column. Only the last length needs all of them in order, as
    a name over ``HELD`` rows is decided there.
    """
    n = tasks(found.sparkSession)
    order = ["name", "kind", "whole", "doc"] if last else ["name"]
    ranked = found.repartition(n, "name").sortWithinPartitions(*order).mapInArrow(partial(rank, last=last), PLACES)
    return ranked.repartition(n, "tie").sortWithinPartitions("tie").mapInArrow(
        partial(gather, last=last), "tie long, doc long, covers binary, opens binary"
    )


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """tie (place of the row), doc (its rank: the id, null last), doc_id and data, the bytes."""
    docs = addressed(docs)
    return docs.select(
        place(docs).alias("tie"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"),
    )


def chunked(items: Iterable[tuple[np.ndarray, int, int, np.ndarray | None]]) -> Iterator[Chunk]:
    """Chunks of (units, tie, doc, windows); windows of None are all.

    A document over ``CHUNK`` units is cut: every window lies in the part in which it starts.
    """
    parts: list[tuple[np.ndarray, int, int, np.ndarray | None]] = []
    size = 0

    def chunk() -> Chunk:
        units, ties, docs, windows = zip(*parts)
        ends = np.cumsum([len(u) for u in units])
        at = number = None
        if windows[0] is not None:
            at = np.concatenate([w + e - len(u) for w, e, u in zip(windows, ends, units)])
            number = np.repeat(np.arange(len(parts)), [len(w) for w in windows])
        return Chunk(np.concatenate(units), ends, np.array(ties), np.array(docs), at, number)

    for units, tie, doc, windows in items:
        if len(units) < SPAN:
            continue
        if parts and size + len(units) > CHUNK:
            yield chunk()
            parts, size = [], 0
        if len(units) <= CHUNK:
            parts.append((units, tie, doc, windows))
            size += len(units)
            continue
        every = np.arange(len(units) - SPAN + 1) if windows is None else windows
        for start in range(0, len(units), CHUNK):
            mine = every[(every >= start) & (every < start + CHUNK)]
            if len(mine):
                part = units[start:start + CHUNK + SPAN - 1]
                yield Chunk(
                    part, np.array([len(part)]), np.array([tie]), np.array([doc]), mine - start,
                    np.zeros(len(mine), dtype=np.int64), start,
                )
    if parts:
        yield chunk()


def first_pass(docs: DataFrame, units_of: Callable[[bytes], np.ndarray], k: int) -> DataFrame:
    """Rows of :func:`find` for whole documents; ``docs`` as from :func:`numbered`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from find(chunked(
            (units_of(data.as_py()), tie.as_py(), doc.as_py(), None)
            for batch in batches for tie, doc, data in zip(*batch.columns)
        ), k)

    return docs.select("tie", "doc", "data").mapInArrow(run, ROWS)
