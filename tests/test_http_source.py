"""The HTTP query source on recorded bytes; no server is asked."""

import json
import re
import sys
from datetime import date

import pytest
from pyspark import cloudpickle

from cohortwise.sources import http

# The recorded answers travel to the workers inside the function.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "user_id long, day date, likes long, ctr double, note string"
ROWS = [
    {"user_id": i, "day": f"2024-01-{i % 28 + 1:02}", "likes": i * 3, "ctr": i / 8, "note": None if i % 5 else f"é{i}\n"}
    for i in range(1000)
] + [{"user_id": None, "day": None, "likes": 7, "ctr": None, "note": "no number"}]


def recorded(url, query):
    """What the store would answer, in chunks that end anywhere."""
    assert url == "http://store.test/"
    bounds = re.search(r"user_id >= (-?\d+) AND user_id < (-?\d+)", query)
    inside = lambda r: bounds is None or (
        "IS NULL" in query if r["user_id"] is None else int(bounds[1]) <= r["user_id"] < int(bounds[2])
    )
    data = "".join(json.dumps(r) + "\n" for r in ROWS if inside(r)).encode()
    for at in range(0, len(data), 777):
        yield data[at:at + 777]


def values(df):
    return sorted((str(tuple(r)) for r in df.collect()))


WANT = sorted(str((r["user_id"], date.fromisoformat(r["day"]) if r["day"] else None, r["likes"], r["ctr"], r["note"])) for r in ROWS)


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_ranges_cover_every_row_once(spark, parts):
    df = http.read_query(spark, "http://store.test/", "SELECT * FROM t", SCHEMA, "user_id", 0, 999, parts, recorded)
    assert values(df) == WANT and df.rdd.getNumPartitions() == parts


def test_without_a_column(spark):
    assert values(http.read_query(spark, "http://store.test/", "SELECT * FROM t", SCHEMA, transport=recorded)) == WANT


def test_lines_are_cut_anywhere():
    data = b'{"a": 1}\n{"a": 2}\n{"a": 3}'
    for size in (1, 5, 9, 100):
        for step in range(1, len(data)):
            blocks = list(http.whole_lines((data[i:i + step] for i in range(0, len(data), step)), size))
            assert b"".join(blocks) == data and all(b.endswith(b"\n") for b in blocks[:-1])
    assert list(http.whole_lines([])) == [] and list(http.whole_lines([b"\n"])) == []


def test_ranges():
    assert http.ranges(0, 9, 3) == [(0, 3), (3, 6), (6, 10)] and http.ranges(5, 5, 8) == [(5, 6)] and http.ranges(3, 1, 2) == []


def test_unknown_fields_fail_and_empty_answers_are_empty(spark):
    with pytest.raises(Exception, match="unexpected field"):
        http.read_query(spark, "http://store.test/", "q", "user_id long", transport=recorded).collect()
    assert http.read_query(spark, "x", "q", SCHEMA, transport=lambda url, query: iter(())).count() == 0
