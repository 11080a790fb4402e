"""The pipeline's stages on their own input, and the registration of the queries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from cohortwise.llm import queries, secrets, simhash
from test_packing import check

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of every stage, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(docs)
    return out


def test_columns_stay(steps):
    assert all(df.columns == steps[0].columns for df in steps[:-1])


def test_quality_stage(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    left = {r.quality: r["count"] for r in steps[1].join(labels, "doc_id").groupBy("quality").count().collect()}
    all_ = {r.quality: r["count"] for r in labels.groupBy("quality").count().collect()}
    assert left.get(1, 0) >= 0.98 * all_[1] and left.get(0, 0) <= 0.05 * all_[0]


def test_exact_stage(steps):
    last = {}
    for r in steps[1].collect():
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert {r.doc_id for r in steps[2].collect()} == set(last.values())


def test_near_stage(steps):
    before = {r.doc_id: simhash.fingerprint(r.text, 4, 42) for r in steps[2].collect()}
    ids = sorted(before)
    prints = np.array([before[i] for i in ids], dtype=np.int64).view(np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 4
    label = np.arange(len(ids))
    while True:
        lower = np.array([label[row].min() for row in near])
        if (lower == label).all():
            break
        label = lower
    assert {r.doc_id for r in steps[3].collect()} == {ids[i] for i in set(label.tolist())}
    assert len(set(label.tolist())) < len(ids)


def test_secrets_stage(spark, steps):
    left = secrets.report(steps[4])
    assert left.where("spans <> ''").count() == 0
    dirty = {r.doc_id for r in secrets.report(steps[3]).where("spans <> ''").collect()}
    before, after = ({r.doc_id: r for r in df.collect()} for df in steps[3:5])
    assert set(before) == set(after) and dirty
    assert {i for i in before if before[i] != after[i]} == dirty
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_packing_stage(steps):
    used = check(steps[5].collect(), {r.doc_id: r.text for r in steps[4].collect()})
    assert sum(1024 - u for u in used) < 1024 * 8


def test_run_gives_the_same_pieces(spark, steps):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    total = lambda df: sorted((r.doc_id, r.doc_tokens) for r in df.select(*columns).where("start = 0").collect())
    assert total(corpus_pipeline.run(spark, FOLDER)) == total(steps[5])


def test_odd_rows_pass_every_stage(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", "en", None, 5), (4, "a b c", None, "s", 5),
            (4, "a b c", None, "s", 5), (5, "x " * 60_000, "en", "s", 120_000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    labels = "doc_id long, quality int, toxic int"
    for name, kept in (("odd", rows), ("empty", [])):
        spark.createDataFrame(kept, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], labels).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r.doc_id for r in out} == ({2, 4, 5} if kept else set())


def test_clashing_columns_pass_every_stage(spark, tmp_path):
    names = ["_tie", "_before", "_body", "_found", "a.b", "found", "tie", "kept", "fp", "name`s", "_metadata"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names]
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    rows = docs.collect()
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names] and len(rows) > 500
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def test_computed_tables_are_numbered_once(spark):
    docs = spark.range(0, 400, 1, 7).selectExpr(
        "id AS doc_id", "concat('text number ', id % 50, ' with a few words') AS text"
    ).repartition(5)
    left = corpus_pipeline.exact_stage(spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in left) == list(range(350, 400))


def test_every_query_is_registered():
    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(__spark_entry__.oracle_sql()) <= names
