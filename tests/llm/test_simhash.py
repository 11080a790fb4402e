"""SimHash links against all pairs of fingerprints."""

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from cohortwise.llm import queries, simhash

FOLDER = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable over links of at most four bits, by comparing all pairs."""
    ids, values = list(prints), np.array(list(prints.values()), dtype=np.uint64)
    smallest = np.array(ids)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    while True:
        lower = np.array([smallest[row].min() for row in near])
        if (lower == smallest).all():
            return dict(zip(ids, smallest.tolist()))
        smallest = lower


def test_query_against_all_pairs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = plain_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op5_simhash(spark, FOLDER).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in texts}


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 63), max_size=4))
def test_every_pair_within_the_radius_meets(bits):
    change = sum(1 << b for b in bits)
    outer = simhash.masks(4)
    assert len(outer) == 31
    hit = [i for i, m in enumerate(outer) if not change & m]
    assert hit
    inner = simhash.narrower(outer, 4)
    assert all(any(not change & m for m in inner[5 * i:5 * i + 5]) for i in hit)


@pytest.mark.parametrize("bucket", [2, 5, 4096])
def test_large_buckets_lose_no_link(spark, bucket):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 6)
    points = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(60):
            flips = rng.choice(64, rng.integers(1, 6), replace=False)
            points.add(int(s) ^ sum(1 << int(f) for f in flips if f < 63))
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    links = {(r.a, r.b) for r in simhash.bucketed(df, 4, bucket).collect()}
    assert all((a ^ b).bit_count() for a, b in links)

    def parts(edges):
        root = {p: p for p in points}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in edges:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return {p: find(p) for p in points}

    near = [(a, b) for a, b in combinations(points, 2) if (a ^ b).bit_count() <= 4]
    assert parts(links) == parts(near)


def test_nulls_ties_and_clashing_columns(spark):
    rows = [(5, "", "x"), (3, None, "y"), (3, None, "y"), (None, "a b c d e f", None),
            (None, "a b c d e f", "z"), (8, "A b C d e f", "z"), (9, "one two", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_dedup(docs).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == 3
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 3), (3, 3), (None, 8), (8, 8), (9, 9)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_dedup(docs).count() == 0
