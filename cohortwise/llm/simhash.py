"""SimHash near-dedup with covering locality-sensitive hashing.

Every bit position gets a nonzero vector of ``radius + 1`` bits, and every nonzero vector v of
that length a table whose mask holds the positions with odd inner product with v. The vectors
of at most ``radius`` differing positions leave some v orthogonal to all of them, so two
fingerprints within the radius agree under that table's mask: no pair is missed. Inside a
bucket, distances are compared and a spanning forest of the links is kept, never all pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.llm.common import addressed, kept, place, tasks
from cohortwise.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
#: Larger buckets are dealt out again by parts of the bits that their mask leaves open.
BUCKET = 4096
LINK = -1
ROWS = "kind int, a long, b long"


def masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask a table; ``2 ** (radius + 1) - 1`` tables of about half the bits."""
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(bits)]
    return [
        sum(1 << i for i, p in enumerate(vectors) if (p & v).bit_count() % 2)
        for v in range(1, 2 ** (radius + 1))
    ]


def narrower(outer: list[int], radius: int, bits: int = BITS) -> list[int]:
    """Each mask with one of ``radius + 1`` parts of its open bits added.

    At most ``radius`` differing bits leave one part without any of them.
    """
    out = []
    for mask in outer:
        free = [i for i in range(bits) if not mask >> i & 1]
        for k in range(radius + 1):
            out.append(mask | sum(1 << i for i in free[k::radius + 1]))
    return out


def signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def fingerprint(text: str, shingle: int, seed: int) -> int:
    """A bit is set if more than half of the shingles' hashes have it; zero without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(0, len(words) - shingle)
    hashed = [
        xxhash.xxh64_intdigest(joined[a:b], seed)
        for a, b in zip(starts[:last + 1].tolist(), ends[-last - 1:].tolist())
    ]
    bits = np.unpackbits(np.array(hashed, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashed)
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int, seed: int) -> DataFrame:
    """doc_id, tie (place of the row) and fp, a signed 64-bit number."""
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py() or "", shingle, seed) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())], schema=schema
            )

    docs = addressed(docs)
    chosen = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        place(docs).alias("tie"), F.col(text).alias("text"),
    )
    return chosen.mapInArrow(run, "doc_id long, tie long, fp long")


def forest(points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links from the first member of every connected part of a bucket to its other members."""
    out: list[tuple[int, int]] = []
    rest = points
    while len(rest) > 1:
        root, front, rest = rest[0], rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), dtype=bool)
            for at in range(0, len(front), 64):
                far = np.bitwise_count(front[at:at + 64, None] ^ rest[None, ~near]) > radius
                near[~near] = ~far.all(axis=0)
            front, rest = rest[near], rest[~near]
            out += [(int(root), int(x)) for x in front]
    return out


def bucket_links(
    batches: Iterator[pa.RecordBatch], radius: int, limit: int | None, parts: list[int] | None,
) -> Iterator[pa.RecordBatch]:
    """Read rows (kind, a = key, b = fingerprint) sorted by bucket; write links.

    Buckets over ``limit`` are written again under the ``radius + 1`` masks in ``parts``.
    """
    def emit(kind: np.ndarray | list, a: np.ndarray | list, b: np.ndarray | list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
            ["kind", "a", "b"],
        )

    def again(table: int, points: np.ndarray) -> Iterator[pa.RecordBatch]:
        for part in range(table * (radius + 1), (table + 1) * (radius + 1)):
            keys = points.view(np.int64) & np.int64(signed(parts[part]))
            yield emit(np.full(len(points), part), keys, points.view(np.int64))

    held = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    overflow: tuple[int, int] | None = None

    def groups(kind, key, fp) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(
            np.concatenate(([True], (kind[1:] != kind[:-1]) | (key[1:] != key[:-1])))
        )
        ends = np.append(starts[1:], len(kind))
        two = starts[ends - starts == 2]
        a, b = fp[two], fp[two + 1]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= radius
        links = list(zip(a[near].tolist(), b[near].tolist()))
        for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            if limit is not None and e - s > limit:
                yield from again(int(kind[s]), fp[s:e].view(np.uint64))
            else:
                found = forest(fp[s:e].view(np.uint64), radius)
                links += [(x - 2**64 if x >= 2**63 else x, y - 2**64 if y >= 2**63 else y)
                          for x, y in found]
        if links:
            yield emit([LINK] * len(links), *map(list, zip(*links)))

    for batch in batches:
        columns = [np.concatenate((h, np.asarray(c))) for h, c in zip(held, batch.columns)]
        kind, key, fp = columns
        if not len(kind):
            continue
        if overflow is not None:
            same = (kind == overflow[0]) & (key == overflow[1])
            if same.any():
                yield from again(overflow[0], fp[same].view(np.uint64))
                kind, key, fp = kind[~same], key[~same], fp[~same]
            if len(kind):
                overflow = None
        if not len(kind):
            held = [kind, key, fp]
            continue
        open_from = int(np.flatnonzero((kind == kind[-1]) & (key == key[-1]))[0])
        if open_from:
            yield from groups(kind[:open_from], key[:open_from], fp[:open_from])
        held = [c[open_from:] for c in (kind, key, fp)]
        if limit is not None and len(held[0]) > limit:
            overflow = (int(held[0][0]), int(held[1][0]))
            yield from again(overflow[0], held[2].view(np.uint64))
            held = [c[:0] for c in held]
    if len(held[0]):
        yield from groups(*held)


def bucketed(points: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect what is connected within the radius; ``points`` has distinct fp."""
    outer = masks(radius)
    inner = narrower(outer, radius)

    def keyed(i: int, mask: int) -> Column:
        key = F.col("fp").bitwiseAND(F.lit(signed(mask)).cast("long"))
        return F.struct(F.lit(i).alias("kind"), key.alias("a"))

    rows = points.select("fp", F.explode(F.array(*[keyed(i, m) for i, m in enumerate(outer)])).alias("t"))
    rows = rows.select("t.kind", "t.a", F.col("fp").alias("b"))
    deal = lambda df: df.repartition(tasks(df.sparkSession), "kind", "a").sortWithinPartitions("kind", "a")
    first = kept(deal(rows).mapInArrow(
        lambda batches: bucket_links(batches, radius, bucket, inner), ROWS
    ))
    second = deal(first.where(F.col("kind") != LINK)).mapInArrow(
        lambda batches: bucket_links(batches, radius, None, None), ROWS
    )
    return first.where(F.col("kind") == LINK).union(second).select("a", "b").distinct()


def near_dedup(
    docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42,
    doc_id: str = "doc_id", text: str = "text", bucket: int = BUCKET,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id, kept, and tie.

    Words are runs without ASCII white space, A-Z in lower case; shorter texts are one shingle,
    texts without words (null ones too) have fingerprint zero and are linked like any other.
    ``component_id`` is the smallest id among documents whose fingerprints are connected by
    steps of at most ``radius`` bits; ``kept`` marks one row of each component, the one with
    that id and, among repeated rows, the smallest ``tie``. A component of null ids has a null id and
    still keeps one row. An empty table gives no rows; other columns are dropped.
    """
    base = kept(fingerprints(docs, doc_id, text, shingle, seed))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("first")
    points = kept(base.groupBy("fp").agg(first))
    labels = components(bucketed(points.select("fp"), radius, bucket))
    named = points.join(labels.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), "first"
    )
    smallest = named.groupBy("label").agg(F.min("first").alias("first"))
    classes = named.select("fp", "label").join(smallest, "label").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.tie").alias("chosen")
    )
    return base.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        (F.col("tie") == F.col("chosen")).alias("kept"), "tie",
    )
