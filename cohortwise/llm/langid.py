"""Language ID by mixture inference.

Learning counts hashed byte trigrams per language over all training texts. A document is seen
as a mixture of languages: expectation-maximisation on its trigram counts estimates the
proportions, and languages are added in the order of their proportion as long as the penalised
likelihood grows. The prediction is the largest proportion in the chosen set.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from cohortwise.llm.common import fold

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 2**15
SMOOTHING = 0.5
ROUNDS = 20
#: Neighbouring trigrams share characters; so many of them count as one observation.
OVERLAP = 3
UNKNOWN = "und"
#: ASCII bytes that are no letter read as a space.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a whole text whose middle is no space."""
    data = f" {text.lower()} ".encode().translate(LETTERS)
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    codes = (b[:-2] << 16 | b[1:-1] << 8 | b[2:])[b[1:-1] != 32]
    return (codes * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def learn(docs: DataFrame, lang: str, text: str) -> tuple[list[str], np.ndarray]:
    """Names and log probabilities: one row of fixed size for each language.

    Tasks add up their own counts first, so no more than ``BUCKETS`` rows a language and task
    are shuffled, and as many a language reach the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                mine = total.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                mine += np.bincount(trigrams(value.as_py()), minlength=BUCKETS)
        for name, mine in total.items():
            used = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)),
                pa.array(mine[used]),
            ], ["lang", "bucket", "n"])

    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")
    )
    found = counts.toArrow()
    names = sorted(set(found["lang"].to_pylist()))
    table = np.full((len(names), BUCKETS), SMOOTHING)
    place = {name: i for i, name in enumerate(names)}
    at = np.array([place[x] for x in found["lang"].to_pylist()], dtype=np.int64)
    np.add.at(table, (at, found["bucket"].to_numpy()), found["n"].to_numpy())
    return names, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def proportions(p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture weights by expectation-maximisation, and the log likelihood; p is n x languages."""
    weights = np.full(p.shape[1], 1 / p.shape[1])
    total = counts.sum()
    for _ in range(ROUNDS if p.shape[1] > 1 else 0):
        joint = p * weights
        moved = (counts / joint.sum(axis=1)) @ joint / total
        if np.abs(moved - weights).max() < 1e-4:
            weights = moved
            break
        weights = moved
    return weights, float(counts @ np.log(p @ weights))


def infer(text: str | None, names: list[str], table: np.ndarray) -> tuple[str, float]:
    """Language and its share of the document."""
    if not names or not text or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    counts = np.bincount(trigrams(text), minlength=BUCKETS)
    used = np.flatnonzero(counts)
    if not len(used):
        return UNKNOWN, 0.0
    counts = counts[used].astype(np.float64)
    logs = table[:, used].astype(np.float64)
    # A common factor in a trigram's probabilities changes no choice and avoids underflow.
    p = np.exp(logs - logs.max(axis=0)).T
    weights, _ = proportions(p, counts)
    order = np.argsort(-weights, kind="stable")
    penalty = 0.5 * np.log(counts.sum() / OVERLAP + 1) + 1
    best, chosen, share = -np.inf, order[:1], np.ones(1)
    for k in range(1, len(order) + 1):
        mine = order[:k]
        found, likelihood = proportions(p[:, mine], counts)
        value = likelihood / OVERLAP - penalty * k
        if value <= best:
            break
        best, chosen, share = value, mine, found
    top = max(range(len(chosen)), key=lambda i: (share[i], -chosen[i]))
    return names[chosen[top]], float(min(1.0, share[top]))


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Languages are learnt from rows outside fold 1 (crc32 of the id as text, modulo 3) with a
    language and a text; only the text is an input of a prediction. ``und`` with score 0 where
    the text is null or has no letter, or nothing could be learnt. Otherwise the score is the
    share of the predicted language; ties go to the name that sorts first. Equal texts get
    equal rows; a null id counts as fold 0; an empty table gives no rows.
    """
    chosen = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (fold(doc_id) == 1).alias("held_out"),
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
    )
    names, table = learn(chosen.where(~F.col("held_out")), "lang", "text")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
        ("score", pa.float64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [infer(t.as_py(), names, table) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
            ], schema=schema)

    return chosen.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )
