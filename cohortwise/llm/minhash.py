"""MinHash near-dedup with sequential Bayesian verification.

Documents that share a band of their signature meet in a bucket. Signatures are compared batch
by batch: after h hashes with k matches the similarity has a Beta(k + 1, h - k + 1) posterior
(uniform prior), and a pair is given up as soon as the posterior probability of reaching the
similarity falls below the miss probability. What survives all batches is verified exactly, on
whole sets. Documents with equal sets are one node. A bucket first compares its members with
its first one. Where several components are left, members of the smaller
ones are compared with all others, in blocks of bounded size: first for the best partner of
each, which joins nearly all of a family, at last for every partner in another component.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from cohortwise.llm.common import addressed, bit_map, in_map, kept, place, quoted, tasks
from cohortwise.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: 32 bands of 5: a pair at 0.8 shares none with probability 3e-6, at 0.85 with 2e-8.
BANDS, ROWS_A_BAND = 32, 5
HASHES = BANDS * ROWS_A_BAND
BATCH = 32
#: Posterior probability below which a candidate is given up.
MISS = 1e-6
#: Members of a block when the components of a bucket are compared; verified sets a part.
BLOCK, PART = 256, 2048
#: Rounds between components: bands that take part, and partners told for each member (or all).
ROUNDS = ((4, 1), (BANDS, None))
#: Bits of the map of shingle parities: two maps differ in no more bits than their sets do.
PARITY = 1024
#: A sketch is 32-bit words: signature (16 bits a hash), map, and size of the set.
SIGNATURE = HASHES // 2
SKETCH = SIGNATURE + PARITY // 32 + 1
#: Bits of the map of documents whose sets are needed; half a megabyte.
MAP_BITS = 22
#: Shingles hashed at a time.
SHINGLES = 4096


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(13)
    return (rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2**63, HASHES, dtype=np.uint64))


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; none without words."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    grams = {b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))}
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, grams), dtype=np.uint64, count=len(grams))
    hashed.sort()
    return hashed


def signature(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest value of each hash over the set, in 16 bits; chance matches only keep a pair."""
    out = np.full(HASHES, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(grams), SHINGLES):
        np.minimum(out, (grams[at:at + SHINGLES, None] * a + b).min(axis=0), out=out)
    return (out >> np.uint64(48)).astype(np.uint16)


def sketch(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    odd = np.bincount((grams >> np.uint64(40)).astype(np.int64) % PARITY, minlength=PARITY) & 1
    map_ = np.packbits(odd.astype(np.uint8)).tobytes()
    return signature(grams, a, b).tobytes() + map_ + np.uint32(len(grams)).tobytes()


def least_matches(similarity: float, miss: float) -> list[tuple[int, int]]:
    """After each batch: hashes compared, and the matches below which a pair is given up.

    P(similarity or more | k of h) is the tail of Beta(k + 1, h - k + 1), that is the chance of
    at most k successes in h + 1 trials.
    """
    out = []
    for h in range(BATCH, HASHES + 1, BATCH):
        tail, k = 0.0, 0
        while True:
            tail += math.comb(h + 1, k) * similarity ** k * (1 - similarity) ** (h + 1 - k)
            if tail >= miss:
                break
            k += 1
        out.append((h, k))
    return out


def matched(x: np.ndarray, y: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Matching hashes of pairs of signature rows; -1 for pairs that a batch gives up."""
    alive = np.arange(len(x))
    matches = np.zeros(len(x), dtype=np.int64)
    for h, least in steps:
        part = slice(h - BATCH, h)
        matches[alive] += (x[alive, part] == y[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    out = np.full(len(x), -1, dtype=np.int64)
    out[alive] = matches[alive]
    return out


def signatures(sketches: np.ndarray) -> np.ndarray:
    return sketches[:, :SIGNATURE].view(np.uint16)


def compared(x: np.ndarray, y: np.ndarray, steps: list[tuple[int, int]], similarity: float) -> np.ndarray:
    """:func:`matched` of sketches, and -1 also where sizes or parity maps rule the pair out.

    Sets of sizes n and m at the similarity differ in at most (n + m)(1 - s) / (1 + s) shingles,
    so these two tests give up no link.
    """
    n, m = x[:, -1].astype(np.int64), y[:, -1].astype(np.int64)
    out = np.full(len(x), -1, dtype=np.int64)
    fits = np.flatnonzero(np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9)
    out[fits] = matched(signatures(x[fits]), signatures(y[fits]), steps)
    left = np.flatnonzero(out >= 0)
    apart = np.bitwise_count(x[left, SIGNATURE:-1] ^ y[left, SIGNATURE:-1]).sum(axis=1, dtype=np.int64)
    far = apart > (n + m)[left] * (1 - similarity) / (1 + similarity) + 1e-6
    out[left[far]] = -1
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A 64-bit name for each band of each row."""
    rows = signatures(sketches).reshape(len(sketches), BANDS, ROWS_A_BAND).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for k in range(ROWS_A_BAND):
        out = (out ^ rows[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        out = out ^ (out >> np.uint64(29))
    return out


def as_rows(blobs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), dtype=np.uint32).reshape(-1, SKETCH)


def meetings(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows (key, order, id, n, band) sorted by key and order to rows (key, id, band, a).

    a names the bucket's first member, for members whose sizes allow the similarity with it.
    A member alone in its bucket meets nobody and is left out. A bucket's first member and the
    row before are all that is held.
    """
    def told(rows: list[np.ndarray]) -> pa.RecordBatch:
        key, ids, band, first, fits = rows
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(ids), pa.array(band), pa.array(first, mask=~fits)], ["key", "id", "band", "a"]
        )

    begun: tuple[int, int, int] | None = None  # key, id, n
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, _, ids, n, band = (np.asarray(c).astype(np.int64) for c in batch.columns)
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        new[0] = begun is None or key[0] != begun[0]
        start = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        first = np.where(start >= 0, ids[start], begun[1] if begun else 0)
        size = np.where(start >= 0, n[start], begun[2] if begun else 0)
        fits = ~new & (np.minimum(size, n) >= similarity * np.maximum(size, n) - 1e-9)
        begun = int(key[-1]), int(first[-1]), int(size[-1])
        rows = [key, ids, band, first, fits, new]
        if held is not None:
            rows = [np.concatenate(pair) for pair in zip(held, rows)]
        new = rows.pop()
        # The last row waits for the next one.
        shared = np.flatnonzero(~new[:-1] | ~new[1:])
        yield told([c[shared] for c in rows])
        held = [*(c[-1:] for c in rows), new[-1:]]
    if held is not None and not held.pop()[0]:
        yield told(held)


def pruned(
    batches: Iterator[pa.RecordBatch], steps: list[tuple[int, int]], similarity: float,
) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, x, y) with sketches x and y to the pairs that survive."""
    for batch in batches:
        if batch.num_rows:
            alive = compared(as_rows(batch.column(2)), as_rows(batch.column(3)), steps, similarity) >= 0
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(alive)) for c in batch.columns[:2]], ["a", "b"]
            )


def crossings(
    batches: Iterator[pa.RecordBatch], similarity: float, steps: list[tuple[int, int]], best: int | None,
) -> Iterator[pa.RecordBatch]:
    """Rows (key, block, part, minor, id, label, sketch), sorted by the first three, to pairs.

    A group is a block of a bucket and a part of the members outside its largest component;
    these are compared with the block's members of other labels. ``best`` partners of each are
    told, or all that survive. Only a group is held.
    """
    def group(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        minor = np.array([r[3] for r in rows], dtype=bool)
        ids, label = (np.array([r[i] for r in rows], dtype=np.int64) for i in (4, 5))
        sketches = np.frombuffer(b"".join(r[6] for r in rows), dtype=np.uint32).reshape(-1, SKETCH)
        others = np.flatnonzero(~minor)
        for i in np.flatnonzero(minor):
            j = others[label[others] != label[i]]
            found = compared(np.broadcast_to(sketches[i], (len(j), SKETCH)), sketches[j], steps, similarity)
            order = np.argsort(-found, kind="stable")[:best]
            j = j[order[found[order] >= 0]]
            if len(j):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j])),
                ], ["a", "b"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][:3] != row[:3]:
                yield from group(held)
                held = []
            held.append(row)
    if held:
        yield from group(held)


def between_components(
    met: DataFrame, labels: DataFrame, points: DataFrame, bands: int, similarity: float,
    steps: list[tuple[int, int]], best: int | None,
) -> DataFrame:
    """Surviving pairs (a, b) of different labels that share a bucket of the first ``bands`` bands.

    Members of a bucket's largest component travel once for each part of the others, those once
    for each block, so a bucket of one family costs its size. Blocks and parts are dealt by hash.
    """
    named = met.where(F.col("band") < bands).select("key", "id").join(labels, "id", "left").select(
        "key", "id", F.coalesce("label", "id").alias("label")
    )
    sizes = named.groupBy("key", "label").agg(F.count("*").alias("m")).groupBy("key").agg(
        F.max_by("label", F.struct("m", "label")).alias("largest"), F.sum("m").alias("size"), F.max("m").alias("most"),
    ).where("size > most").select(
        "key", "largest", F.ceil(F.col("size") / BLOCK).alias("blocks"),
        F.ceil((F.col("size") - F.col("most")) / BLOCK).alias("parts"),
    )
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    open_ = named.join(sizes, "key").join(points.select("id", "sig"), "id")
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts"))
    members = open_.select("key", block.alias("block"), F.explode(every("parts")).alias("part"), F.lit(False).alias("minor"), "id", "label", "sig")
    minors = open_.where("label <> largest").select(
        "key", F.explode(every("blocks")).alias("block"), part.alias("part"), F.lit(True).alias("minor"), "id", "label", "sig"
    )
    dealt = members.union(minors).repartition(tasks(met.sparkSession), "key", "block", "part")
    return dealt.sortWithinPartitions("key", "block", "part").mapInArrow(
        lambda batches: crossings(batches, similarity, steps, best), "a long, b long"
    ).distinct()


def verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, part, b, grams) sorted so that a's own set, with b null, comes first: links."""
    centre: tuple[int, int] | None = None
    own = np.zeros(0, dtype=np.uint64)
    for batch in batches:
        out = []
        for a, part, b, blob in zip(*(c.to_pylist() for c in batch.columns)):
            grams = np.frombuffer(blob, dtype=np.uint64)
            if b is None:
                centre, own = (a, part), grams
            elif centre == (a, part):
                common = np.intersect1d(own, grams, assume_unique=True).size
                if 100 * common >= percent * (len(own) + len(grams) - common):
                    out.append((a, b))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], pa.int64()) for i in range(2)], ["a", "b"]
        )


def near_dedup(
    docs: DataFrame, percent: int = 80, shingle: int = 2, miss: float = MISS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, and tie.

    A-Z are lower-cased, words are runs without ASCII white space; a document's set holds its
    distinct word shingles, or the whole sequence where it has fewer words. Documents are
    linked where ``100 * intersection >= percent * union``. Null texts and texts without words
    are linked with nothing. ``component_id`` is the smallest id reachable; ``kept`` marks one
    row of each component, the one with that id and, among repeated rows, the smallest
    ``tie``. A component of null ids has a null id and still keeps one row. Repeated rows are
    linked like any equal sets. An empty table gives no rows; other columns are dropped.

    Every link is verified on whole sets, by 64-bit hashes of shingles. A link is missed with
    probability 3e-6 at exactly 0.8, where no band agrees, or with ``miss`` in a comparison.
    """
    spark = docs.sparkSession
    similarity = percent / 100
    steps = least_matches(similarity, miss)
    docs = addressed(docs)
    texts = docs.select(
        F.col(quoted(doc_id)).cast("long").alias("doc_id"), place(docs).alias("tie"),
        F.col(quoted(text)).alias("text"),
    )
    a, b = multipliers()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py() or "", shingle) for t in batch.column(2)]
            names = [np.frombuffer(xxhash.xxh3_128_digest(g.tobytes()), dtype="<i8") for g in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(g) for g in sets], pa.int64()),
                pa.array([int(x[0]) for x in names], pa.int64()), pa.array([int(x[1]) for x in names], pa.int64()),
                pa.array([sketch(g, a, b) if len(g) else b"" for g in sets], pa.binary()),
            ], ["doc_id", "tie", "n", "h1", "h2", "sig"])

    base = kept(texts.mapInArrow(describe, "doc_id long, tie long, n long, h1 long, h2 long, sig binary"))
    # Equal sets are one node, named by the place of its first row.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("first")
    points = kept(base.where("n > 0").groupBy("h1", "h2").agg(
        first, F.first("n").alias("n"), F.first("sig").alias("sig")
    ).withColumn("id", F.col("first.tie")))

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(as_rows(batch.column(2))).view(np.int64)
                repeat = lambda c: pa.array(np.repeat(np.asarray(c), BANDS))
                band = pa.array(np.tile(np.arange(BANDS), batch.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), repeat(batch.column(0)), repeat(batch.column(1)), band],
                    ["key", "id", "n", "band"],
                )

    rows = points.select("id", "n", "sig").mapInArrow(banded, "key long, id long, n long, band long")
    # One order everywhere, so that a group of near copies has the same first member in its buckets.
    rows = rows.select("key", F.xxhash64("id").alias("order"), "id", "n", "band")
    met = kept(rows.repartition(tasks(spark), "key").sortWithinPartitions("key", "order", "id").mapInArrow(
        lambda batches: meetings(batches, similarity), "key long, id long, band long, a long"
    ))
    pairs = met.where("a IS NOT NULL AND a <> id").select(
        F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")
    ).distinct()
    sig = lambda end, name: points.select(F.col("id").alias(end), F.col("sig").alias(name))
    tested = kept(pairs.join(sig("a", "x"), "a").join(sig("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(
        lambda batches: pruned(batches, steps, similarity), "a long, b long"
    ))
    links = exact_links(texts, tested, shingle, percent)
    labels = components(links)
    for bands, best in ROUNDS:
        crossed = between_components(met, labels, points, bands, similarity, steps, best)
        crossed = kept(crossed.join(tested, ["a", "b"], "left_anti"))
        if crossed.isEmpty():
            continue
        tested, links = tested.union(crossed), links.union(exact_links(texts, crossed, shingle, percent))
        labels = components(links)
    classes = points.join(labels, "id", "left").select(
        "h1", "h2", F.coalesce("label", "id").alias("label"), "first"
    )
    smallest = classes.groupBy("label").agg(F.min("first").alias("low"))
    classes = classes.join(smallest, "label").select(
        "h1", "h2", F.col("low.doc_id").alias("component_id"), F.col("low.tie").alias("chosen")
    )
    filled = base.where("n > 0").drop("sig").join(classes, ["h1", "h2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("tie") == F.col("chosen")).alias("kept"), "tie"
    )
    return filled.union(base.where("n = 0").select("doc_id", "n", "doc_id", F.lit(True), "tie"))


def exact_links(texts: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of places that are linked, verified on whole sets.

    Sets are computed for documents of pairs alone. A centre's set goes once to each part of
    its pairs, and a part has about ``PART`` of them, so no document is a task of its own.
    """
    spark = texts.sparkSession
    ends = pairs.select(F.explode(F.array("a", "b")).alias("tie")).distinct()
    needed = bit_map(ends, "tie", MAP_BITS)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = batch.filter(pa.array(in_map(np.asarray(batch.column(0)).view(np.uint64), needed)))
            for at in range(0, maybe.num_rows, 500):
                part = maybe.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(
                    [shingle_set(t.as_py() or "", shingle).tobytes() for t in part.column(1)], pa.binary()
                )], ["tie", "grams"])

    sets = kept(texts.select("tie", "text").mapInArrow(whole, "tie long, grams binary"))
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).alias("parts"))
    dealt = pairs.join(parts, "a").select(
        F.col("b").alias("tie"), "a", F.pmod(F.xxhash64("b"), "parts").alias("part")
    )
    members = dealt.join(sets, "tie").select("a", "part", F.col("tie").alias("b"), "grams")
    centres = parts.join(sets.withColumnRenamed("tie", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.lit(None).cast("long").alias("b"), "grams",
    )
    return kept(members.union(centres).repartition(tasks(spark), "a", "part").sortWithinPartitions(
        "a", "part", F.asc_nulls_first("b")
    ).mapInArrow(lambda batches: verified(batches, percent), "a long, b long"))
