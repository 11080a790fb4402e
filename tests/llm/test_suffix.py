"""Substring dedup against a dictionary of all windows."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from cohortwise.llm import queries, repeats, suffix

FOLDER = "/root/testdata/sf0.01"


def plain(texts, span=50):
    """``texts``: list of (doc_id, text). Rows as (doc_id, n_bytes, n_removed, n_spans, sha)."""
    rank = lambda i: repeats.NO_ID if i is None else i
    data = [(i, (t or "").encode()) for i, t in texts]
    first = {}
    for i, d in data:
        for at in range(len(d) - span + 1):
            w = d[at:at + span]
            first[w] = min(first.get(w, repeats.NO_ID), rank(i))
    out = []
    for i, d in data:
        gone = np.zeros(len(d) + 2, dtype=bool)
        for at in range(len(d) - span + 1):
            if first[d[at:at + span]] < rank(i):
                gone[at + 1:at + span + 1] = True
        left = bytes(b for b, g in zip(d, gone[1:]) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def rows(df):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_query_against_all_windows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = plain([(r.doc_id, r.text) for r in docs])
    got = rows(queries.op3_suffix_dedup(spark, FOLDER))
    assert got == sorted(want, key=repr)
    assert sum(r[2] for r in got) > 100_000


def odd_texts():
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij é"), rng.integers(2, 9)))
    passage = " ".join(word() for _ in range(40))
    texts = [(i, " ".join(word() for _ in range(30)) + passage[i:i + 49 + i]
              + " ".join(word() for _ in range(20))) for i in range(12)]
    texts += [(20, None), (21, ""), (22, "a" * 49), (23, "a" * 50), (24, "a" * 300), (25, "ab" * 90),
              (26, "xab" * 40 + "ab" * 70), (3, texts[7][1]), (3, texts[7][1]), (None, texts[2][1]),
              (None, passage), (40, passage * 3), (41, passage[:50] + passage[50:99]), (42, passage * 2)]
    return texts


def test_odd_documents(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, tie string")
    assert rows(suffix.substring_dedup(docs)) == sorted(plain(texts), key=repr)


@pytest.mark.parametrize("name, value", [("CHUNK", 120), ("HOT", 1), ("HELD", 5), ("LOCAL_RUNS", 3)])
def test_limits_change_nothing(spark, monkeypatch, name, value):
    monkeypatch.setattr(repeats, name, value)
    texts = odd_texts()
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert rows(suffix.substring_dedup(docs)) == sorted(plain(texts), key=repr)


@pytest.mark.parametrize("hot, held", [(200, 500_000), (2, 500_000), (1, 3), (200, 3)])
def test_hot_names_of_other_tasks(spark, monkeypatch, hot, held):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "HELD", held)
    texts = [(i, "a" * n) for i, n in enumerate((300, 60, 280, 700, 51, 90, 400, 55))]
    texts += [(9, "ab" * 300), (9, "ab" * 320), (8, "ab" * 40), (None, "ab" * 500), (30, "b" * 400), (31, "b" * 70)]
    texts += [(i, "ab" * 250 + "xyz " * (i - 39)) for i in range(40, 50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame(spark.sparkContext.parallelize(texts[::-1], 8), "doc_id long, text string")
        assert rows(suffix.substring_dedup(docs)) == sorted(plain(texts), key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("hot, held", [(200, 500_000), (3, 500_000), (3, 40), (10**6, 40)])
def test_colliding_names_remove_nothing(spark, monkeypatch, hot, held):
    strong = repeats.names

    def weak(units, k, second=False):
        out = strong(units, k, second)
        return out if second or k < repeats.SPAN else out & np.uint64(3 << 30)

    monkeypatch.setattr(repeats, "names", weak)
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "HELD", held)
    texts = odd_texts()
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert rows(suffix.substring_dedup(docs)) == sorted(plain(texts), key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.substring_dedup(docs).count() == 0


def batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(zip(*rows))],
        [f.split()[0] for f in repeats.ROWS.split(", ")],
    )


def mixed_rows():
    """Rows of :func:`repeats.find`, name by name, in any order within a name."""
    rng = np.random.default_rng(8)
    out = []
    for name in range(-200, 200):
        for i in range(rng.choice([1, 1, 1, 2, 5, 40])):
            kind = rng.choice([repeats.MARK, repeats.COVER, repeats.OPEN] + [repeats.RUN] * 12)
            whole, doc = (0, 0) if kind == repeats.MARK else rng.integers(0, 4, 2).tolist()
            out.append((name, int(kind), whole, doc, 1000 * doc + i, int(rng.integers(0, 9)) << 8 | 3))
    return out


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_names_settle_in_any_order_of_their_rows(size):
    rows = mixed_rows()
    several = {r[0] for r in rows if r[1] == repeats.MARK}
    wholes, smallest = {}, {}
    for name, kind, whole, doc, _, _ in rows:
        if kind == repeats.RUN:
            wholes.setdefault(name, set()).add(whole)
            smallest[name, whole] = min(doc, smallest.get((name, whole), doc))
    want = []
    for name, kind, whole, doc, tie, at in rows:
        first, after = at >> 8, (at >> 8) + (at & 255)
        if kind == repeats.COVER:
            want.append((tie, doc, repeats.COVER, whole, at))
        elif kind == repeats.RUN and doc > smallest[name, whole]:
            want.append((tie, doc, repeats.COVER, first, after + repeats.SPAN))
        elif kind == repeats.OPEN or kind == repeats.RUN and (len(wholes[name]) > 1 or name in several):
            want.append((tie, doc, repeats.OPEN, first, after + 1))
    got = repeats.rank(batch(rows[a:a + size]) for a in range(0, len(rows), size))
    assert sorted(r for b in got for r in zip(*(c.to_pylist() for c in b.columns))) == sorted(want)


def test_only_the_last_length_sorts_by_more_than_the_name(spark):
    found = spark.createDataFrame([], repeats.ROWS)
    for last in (False, True):
        plan = repeats.settled(found, last)._jdf.queryExecution().analyzed().toString()
        sorts = [line for line in plan.splitlines() if "Sort [" in line]
        assert len(sorts) == 2
        assert (sorts[1].count("ASC") == 1) != last, sorts


def test_runs_of_a_task_stay_in_the_order_of_the_text():
    rng = np.random.default_rng(3)
    rows = repeats.columns(
        name=rng.permutation(500), whole=np.zeros(500, dtype=np.int64), doc=np.arange(500), tie=np.arange(500),
        at=np.zeros(500, dtype=np.int64),
    )
    rows["name"][[7, 400]] = 1000
    out = repeats.within_task({k: v.copy() for k, v in rows.items()})
    runs = out["kind"] == repeats.RUN
    ties = out["tie"][runs]
    assert sorted(ties.tolist()) == [i for i in range(500) if i != 400]
    assert (np.diff(ties[ties != 7]) > 0).all()
    assert out["tie"][out["kind"] == repeats.COVER].tolist() == [400]


@pytest.mark.parametrize("k", suffix.LENGTHS)
def test_only_units_of_open_windows_are_hashed(monkeypatch, k):
    rng = np.random.default_rng(12)
    docs = [suffix.units(rng.bytes(n)) for n in (4000, 50, 900, 2500)]
    ranges = [[(0, 3), (3 + 50, 70), (300, 301), (3951, 3951)], [(0, 1)], [], [(1000, 1200), (1249, 1260), (2440, 2451)]]
    windows = [np.concatenate([np.arange(a, b) for a, b in r]) if r else np.zeros(0, dtype=np.int64) for r in ranges]
    items = [(d, 10 + i, 20 + i, w) for i, (d, w) in enumerate(zip(docs, windows)) if len(w)]
    hashed, names = [], repeats.names
    monkeypatch.setattr(repeats, "names", lambda units, *a, **b: hashed.append(len(units)) or names(units, *a, **b))
    got = [repeats.runs(chunk, k) for chunk in repeats.chunked(items)]
    assert len(got) == 1 and set(hashed) == {3 + 17 + 1 + 1 + 200 + 11 + 11 + 7 * 49}
    want = []
    for units, tie, doc, mine in items:
        short = names(units, k)
        low = np.array([w + np.argmin(short[w:w + 51 - k] & ~np.uint64(2**24 - 1)) for w in mine])
        for w, anchor in zip(mine, low):
            want.append((doc, tie, int(w), int(short[anchor].view(np.int64))))
    rows = zip(*(got[0][c].tolist() for c in ("doc", "tie", "at", "name")))
    assert [(d, t, (at >> 8) + i, n) for d, t, at, n in rows for i in range((at & 255) + 1)] == want
