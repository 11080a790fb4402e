"""Quality classifier: random Fourier features of document statistics, ridge, isotonic scores.

One pass over the texts reduces every document to two dozen statistics. Labelled documents of
the training folds give their means and deviations; random cosine features of the standardised
statistics approximate a Gaussian kernel. Every partition sums its part of the normal
equations, Spark adds the parts cell by cell, and the driver solves one system of fixed size.
Scores of a fold kept aside for it are calibrated by isotonic regression over fixed bins.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from cohortwise.llm.common import fold, kept

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = 256
RIDGE = 1e-3
SEED = 7
#: Raw scores are calibrated in bins of equal width over this range.
BINS, LOW, HIGH = 1024, -0.5, 1.5
#: One training row in this many, by hash of the id, is kept for calibration only.
CALIBRATION = 5
SYMBOLS = np.frombuffer(b"*$%&#@^~<>{}[]\\|_=+", dtype=np.uint8)
MARKS = np.frombuffer(b".,;:!?'\"()-", dtype=np.uint8)
WORD_END = re.compile(rb"[^\x30-\x39A-Za-z\x80-\xff]{2,}(?=\s|\Z)")
STATISTICS = 25


def statistics(text: str) -> np.ndarray:
    """Shares and logarithms that describe the form of a whole text, not its subject."""
    data = text.encode()
    out = np.zeros(STATISTICS)
    if not data:
        return out
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n, words, lines = len(data), data.split(), data.split(b"\n")
    share = counts / n
    upper, lower, digits = share[65:91].sum(), share[97:123].sum(), share[48:58].sum()
    seen = share[share > 0]
    out[:12] = (
        np.log1p(n), upper, digits, share[128:].sum(), share[32], share[SYMBOLS].sum(),
        share[MARKS].sum(), share[33], share[124], upper / (upper + lower + 1e-9),
        -(seen * np.log2(seen)).sum(), share[10],
    )
    if not words:
        return out
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
    keys = np.fromiter(map(hash, words), dtype=np.int64, count=len(words))
    _, times = np.unique(keys, return_counts=True)
    pairs = keys[1:] * 31 + keys[:-1]
    m = len(words)
    out[12:24] = (
        np.log1p(m), lengths.mean(), lengths.std(), len(times) / m, np.log(len(times)) / np.log(m + 1),
        times.max() / m, (keys[1:] == keys[:-1]).mean() if m > 1 else 0.0,
        len(np.unique(pairs)) / max(1, m - 1), len(WORD_END.findall(data)) / m,
        len(set(lines)) / len(lines), np.log1p(n / len(lines)), (lengths <= 1).mean(),
    )
    out[24] = (lengths > 20).mean()
    return out


def described(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, fold and the statistics of every row."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("fold", pa.int64()), ("stats", pa.list_(pa.float32())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py() or "").astype(np.float32) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(found, schema.field(2).type),
            ], schema=schema)

    chosen = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), fold(doc_id).cast("long").alias("fold"),
        F.col(text).alias("text"),
    )
    return chosen.mapInArrow(run, "doc_id long, fold long, stats array<float>")


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), STATISTICS)


@dataclass
class Model:
    """Everything a score needs; a few hundred kilobytes whatever the data."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Cosine features and a constant."""
        rng = np.random.default_rng(SEED)
        directions = rng.standard_normal((STATISTICS, FEATURES)) / np.sqrt(STATISTICS)
        shifts = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((stats - self.mean) / self.deviation, -8, 8)
        waves = np.sqrt(2 / FEATURES) * np.cos(z @ directions + shifts)
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated score; a thousandth of the raw score keeps the order inside flat parts."""
        if self.weights is None:
            return np.full(len(stats), self.values[0])
        raw = self.raw(stats)
        place = np.clip((raw - LOW) / (HIGH - LOW), 0, 1)
        return 0.999 * np.interp(raw, self.knots, self.values) + 0.001 * place


def sums(rows: DataFrame, run) -> dict[int, float]:
    """Add up (cell, value) rows that every partition makes; the cells are a fixed number."""
    added = rows.mapInArrow(run, "cell int, value double").groupBy("cell").agg(
        F.sum("value").alias("value")
    )
    return {r.cell: r.value for r in added.collect()}


def as_cells(values: np.ndarray) -> pa.RecordBatch:
    flat = np.ravel(values)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["cell", "value"]
    )


def spread(rows: DataFrame) -> tuple[float, float, Model]:
    """Number of rows, sum of labels, and a model that holds means and deviations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + 2 * STATISTICS)
        for batch in batches:
            x, y = matrix(batch.column(0)), np.asarray(batch.column(1))
            total += np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)])
        yield as_cells(total)

    found = sums(rows, run)
    total = np.array([found.get(i, 0.0) for i in range(2 + 2 * STATISTICS)])
    n = max(total[0], 1.0)
    mean = total[2:2 + STATISTICS] / n
    variance = np.maximum(total[2 + STATISTICS:] / n - mean ** 2, 0)
    return total[0], total[1], Model(mean, np.sqrt(variance) + 1e-6)


def solve(rows: DataFrame, model: Model) -> np.ndarray:
    """Ridge weights from partition-summed normal equations."""
    size = FEATURES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z, y = model.features(matrix(batch.column(0))), np.asarray(batch.column(1))
            total += z.T @ np.hstack([z, y[:, None]])
        yield as_cells(total)

    found = sums(rows, run)
    total = np.array([found.get(i, 0.0) for i in range(size * (size + 1))]).reshape(size, size + 1)
    penalty = RIDGE * max(total[-1, size - 1], 1.0) / FEATURES * np.eye(size)
    penalty[-1, -1] = 1e-9
    return np.linalg.solve(total[:, :size] + penalty, total[:, size])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; the centre and the value of every block."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x, y, weight):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    done = np.array(blocks)
    return done[:, 0] / done[:, 2], done[:, 1] / done[:, 2]


def calibrate(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, BINS))
        for batch in batches:
            raw, y = model.raw(matrix(batch.column(0))), np.asarray(batch.column(1))
            at = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)
            for k, v in enumerate((raw, y, np.ones(len(y)))):
                total[k] += np.bincount(at, v, BINS)
        yield as_cells(total)

    found = sums(rows, run)
    raw, y, n = np.array([found.get(i, 0.0) for i in range(3 * BINS)]).reshape(3, BINS)
    used = n > 0
    return isotonic(raw[used] / n[used], y[used] / n[used], n[used])


def fit(stats: DataFrame, labels: DataFrame, doc_id: str, quality: str) -> Model:
    """Model from the labelled rows whose fold is not 1. Several labels of an id are averaged."""
    target = labels.select(
        F.col(doc_id).alias("doc_id"), F.col(quality).cast("double").alias("label")
    ).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id") != 1))
    target = target.groupBy("doc_id").agg(F.avg("label").alias("label"))
    rows = kept(
        stats.where(F.col("fold") != 1).join(target, "doc_id").select(
            "stats", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) == 0).alias("later")
        )
    )
    n, positive, model = spread(rows)
    if not 0 < positive < n:
        model.values = np.array([positive / n if n else 0.5])
        return model
    model.weights = solve(rows.where(~F.col("later")), model)
    later = rows.where("later")
    model.knots, model.values = calibrate(rows if later.isEmpty() else later, model)
    return model


def score_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    quality: str = "quality",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Only labels of rows outside fold 1 (crc32 of the id as text, modulo 3) are learnt, and only
    statistics of the text are inputs of a score. Null text is the empty text and gets a score
    like any other; equal texts get equal scores. Without labels every score is 0.5, with
    labels of one kind it is that label. Rows with a null id count as fold 0 and are not learnt
    from. Labels without a document are ignored. An empty table gives no rows; other columns
    are dropped.
    """
    stats = kept(described(docs, doc_id, text))
    model = fit(stats, labels, doc_id, quality)
    return predicted(stats, model)


def accepted(
    docs: DataFrame, labels: DataFrame, least: float = 0.5, doc_id: str = "doc_id",
    text: str = "text", quality: str = "quality",
) -> DataFrame:
    """Rows of ``docs`` whose score is at least ``least``, with all their columns.

    The model is that of :func:`score_quality`. The statistics are computed once more where
    the rows are, which is cheaper than to move every text to its score.
    """
    model = fit(kept(described(docs, doc_id, text)), labels, doc_id, quality)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = [statistics(t or "") for t in texts]
        return pd.Series(model.score(np.float32(found).astype(float)) if found else [], dtype=float)

    return docs.where(score(F.coalesce(F.col(text), F.lit(""))) >= least)


def predicted(stats: DataFrame, model: Model) -> DataFrame:
    """Scores from statistics."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
        ("predicted", pa.int32()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(matrix(batch.column(2)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.asarray(batch.column(1)) == 1), pa.array(score),
                pa.array((score >= 0.5).astype(np.int32)),
            ], schema=schema)

    return stats.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
