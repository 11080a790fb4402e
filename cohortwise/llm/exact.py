"""Exact dedup against a minimal perfect hash of the digests seen before.

The historical documents are reduced to distinct digests. Every shard of them gets a minimal
perfect hash (hash and displace): as many slots as digests, each slot holding the full digest,
the locator of the winner and the number of copies. Incoming documents, also reduced to
distinct digests first, are sent to the shard of their digest and looked up; the 32 bytes in
the slot are compared, so a digest that only shares the slot is no member. Members join the
group of the historical copy; nonmembers form groups of their own.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.llm.common import addressed, kept, place

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Digests of a shard: about 2 MB of digests and 1 MB of locators in one task.
SHARD_DIGESTS = 40_000
INDEX = "shard int, slots binary, displacements binary, ids binary, ties binary, copies binary"
GROUPS = "digest binary, win_id long, win_tie long, copies long"
#: Stands for a missing id inside the index; no winner when any other id is there.
NO_ID = -(2**63)


def words(digests: np.ndarray) -> np.ndarray:
    """The four 64-bit words of each 32-byte digest."""
    return digests.view("<u8").reshape(-1, 4)


def moved(first: np.ndarray, second: np.ndarray, tries: np.ndarray, slots: int) -> np.ndarray:
    """A slot for every number of tries, unrelated from one try to the next."""
    x = (first + tries * np.uint64(0x9E3779B97F4A7C15)) * (second | np.uint64(1))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return (x % np.uint64(slots)).astype(np.int64)


def slot_of(keys: np.ndarray, displacements: np.ndarray, slots: int) -> np.ndarray:
    """Slot of each digest. A negative displacement names the slot of a bucket with one digest."""
    w = words(keys)
    d = displacements[(w[:, 0] % np.uint64(len(displacements))).astype(np.int64)]
    chosen = moved(w[:, 1], w[:, 2], np.maximum(d, 0).astype(np.uint64), slots)
    return np.where(d < 0, -d - 1, chosen)


def displace(keys: np.ndarray) -> np.ndarray:
    """Displacements under which distinct digests fill slots 0 … n-1, one each."""
    n = len(keys)
    buckets = max(1, n // 3)
    w = words(keys)
    bucket = (w[:, 0] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    taken = np.zeros(n, dtype=bool)
    out = np.zeros(buckets, dtype=np.int64)
    tries = np.arange(256, dtype=np.uint64)
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] < 2:
            break
        own = order[starts[b]:starts[b + 1]]
        first, second = w[own, 1][:, None], w[own, 2][:, None]
        base = np.uint64(0)
        while True:
            slots = moved(first, second, tries + base, n)
            free = ~taken[slots].any(axis=0)
            ordered = np.sort(slots, axis=0)
            free &= (ordered[1:] != ordered[:-1]).all(axis=0)
            found = np.flatnonzero(free)
            if len(found):
                out[b] = int(base) + int(found[0])
                taken[slots[:, found[0]]] = True
                break
            base += np.uint64(len(tries))
    lonely = np.flatnonzero(sizes == 1)
    out[lonely] = -np.flatnonzero(~taken)[:len(lonely)] - 1
    return out


def stacked(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, 32)


def build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    keys = stacked(rows["digest"])
    displacements = displace(keys)
    order = np.argsort(slot_of(keys, displacements, len(keys)))
    pick = lambda name: rows[name].to_numpy(dtype=np.int64)[order].tobytes()
    return pd.DataFrame({
        "shard": [int(rows["shard"].iloc[0])], "slots": [keys[order].tobytes()],
        "displacements": [displacements.tobytes()], "ids": [pick("win_id")],
        "ties": [pick("win_tie")], "copies": [pick("copies")],
    })


def probe_shard(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Groups of one shard: historical ones, extended by members, and those of nonmembers."""
    names = ["win_id", "win_tie", "copies"]
    got = {c: new[c].to_numpy(dtype=np.int64) for c in names}
    if index.empty:
        return pd.DataFrame({"digest": new["digest"], **got})
    row = index.iloc[0]
    slots = np.frombuffer(row["slots"], dtype=np.uint8).reshape(-1, 32)
    old = {
        c: np.frombuffer(row[k], dtype=np.int64).copy()
        for c, k in zip(names, ("ids", "ties", "copies"))
    }
    keys = stacked(new["digest"])
    outside = np.ones(len(new), dtype=bool)
    if len(new):
        at = slot_of(keys, np.frombuffer(row["displacements"], dtype=np.int64), len(slots))
        outside = (slots[at] != keys).any(axis=1)
        member, at = np.flatnonzero(~outside), at[~outside]
        old["copies"][at] += got["copies"][member]
        later = (got["win_id"][member] > old["win_id"][at]) | (
            (got["win_id"][member] == old["win_id"][at])
            & (got["win_tie"][member] > old["win_tie"][at])
        )
        for c in names[:2]:
            old[c][at[later]] = got[c][member[later]]
    digests = [x.tobytes() for x in slots] + [x.tobytes() for x in keys[outside]]
    return pd.DataFrame({
        "digest": digests, **{c: np.concatenate((old[c], got[c][outside])) for c in names},
    })


def distinct(digests: DataFrame, shards: int) -> DataFrame:
    """One row per digest; copies collapse before the shuffle."""
    return digests.groupBy("digest").agg(
        F.max(F.struct("id", "tie")).alias("w"), F.count("*").alias("copies"),
    ).select(
        F.pmod(F.hash("digest"), F.lit(shards)).alias("shard"), "digest",
        F.col("w.id").alias("win_id"), F.col("w.tie").alias("win_tie"), "copies",
    )


def build_index(digests: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the perfect hash and its slots."""
    return distinct(digests, shards).groupBy("shard").applyInPandas(build_shard, INDEX)


def look_up(digests: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Groups of the historical and the incoming documents together."""
    return distinct(digests, shards).groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(
        probe_shard, GROUPS
    )


def exact_dedup(
    docs: DataFrame, historical: Column | None = None, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and tie.

    ``historical`` marks the rows the index is built from; without it, the lower half of the
    id range is the history and the rest the incoming batch. The groups do not depend on it.

    Null text is the empty text. Of equal texts the largest id stays; rows that also share the
    id are told apart by ``tie``, which names their place in the input, so exactly one row of
    each group is kept. A null id loses to any other; a group of null ids has a null keep_id and still
    keeps one row. An empty table gives no rows. Other columns of ``docs`` play no part.
    """
    docs = addressed(docs)
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    if historical is None:
        span = docs.agg(F.min(doc_id).alias("a"), F.max(doc_id).alias("b")).first()
        middle = (span.a + span.b) // 2 if span.a is not None else 0
        historical = F.col(doc_id) <= middle
    base = kept(docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id), F.lit(NO_ID)).alias("id"),
        place(docs).alias("tie"), digest.alias("digest"),
        F.coalesce(historical, F.lit(False)).alias("old"),
    ))
    shards = max(1, math.ceil(docs.count() / SHARD_DIGESTS))
    index = build_index(base.where("old"), shards)
    groups = look_up(base.where(~F.col("old")), index, shards)
    return base.select("doc_id", "tie", "digest").join(groups, "digest").select(
        "doc_id", F.when(F.col("win_id") != NO_ID, F.col("win_id")).alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("tie") == F.col("win_tie")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "tie",
    )
