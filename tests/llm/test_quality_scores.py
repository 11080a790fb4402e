"""Quality scores on held-out labels, and the solver against plain NumPy."""

import zlib

import numpy as np
import pytest

from cohortwise.llm import quality, queries

FOLDER = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(np.argsort(score))
    p = label == 1
    return (order[p].sum() - p.sum() * (p.sum() - 1) / 2) / (p.sum() * (~p).sum())


@pytest.fixture(scope="module")
def scored(spark):
    return queries.op2_quality(spark, FOLDER).toPandas().set_index("doc_id")


def test_held_out_labels(spark, scored):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas().set_index("doc_id")
    assert len(scored) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in scored.index]).all()
    assert scored.score.between(0, 1).all()
    assert (scored.predicted == (scored.score >= 0.5)).all()
    both = scored.join(labels, how="inner")
    both = both[both.held_out]
    assert auc(both.score.to_numpy(), both.quality.to_numpy()) > 0.98
    assert both.predicted[both.quality == 1].mean() > 0.98


def test_held_out_labels_are_not_learnt(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(3000)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.selectExpr("doc_id", "IF(crc32(string(doc_id)) % 3 = 1, 1 - quality, quality) AS quality")
    a, b = ({r.doc_id: r.score for r in quality.score_quality(docs, x).collect()} for x in (labels, turned))
    assert max(abs(a[i] - b[i]) for i in a) < 1e-9


def test_isotonic_is_monotone():
    rng = np.random.default_rng(1)
    x = np.sort(rng.uniform(size=200))
    at, value = quality.isotonic(x, x + rng.normal(0, 0.3, 200), np.ones(200))
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(1, 1, "q"), (3, 1, "q")], 1.0), ([(1, None, "q")], 0.5)])
def test_odd_rows_and_labels(spark, labels, score):
    rows = [(1, None, 0), (2, "", 0), (3, "x " * 50_000, 0), (3, "x " * 50_000, 0), (None, "a\n\nb", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    got = quality.score_quality(docs, marks).collect()
    assert len(got) == len(rows) and all(r.score == score for r in got)
    assert quality.accepted(docs, marks).columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score_quality(docs, labels).count() == 0
    assert quality.accepted(docs, labels).count() == 0


def rows_of(spark, stats, label, parts=5):
    rows = [([float(x) for x in s], float(y)) for s, y in zip(stats, label)]
    return spark.createDataFrame(rows, "stats array<float>, label double").repartition(parts)


def test_ridge_and_calibration_against_plain_numpy(spark):
    rng = np.random.default_rng(11)
    stats = rng.standard_normal((900, quality.STATISTICS)).astype(np.float32)
    label = (stats[:, 0] * stats[:, 1] + 0.3 * rng.standard_normal(900) > 0).astype(float)
    rows = rows_of(spark, stats, label)
    n, positive, model = quality.spread(rows)
    wide = stats.astype(float)
    assert (n, positive) == (900, label.sum())
    assert np.allclose(model.mean, wide.mean(axis=0)) and np.allclose(model.deviation, wide.std(axis=0) + 1e-6)
    # The normal equations of the whole table at once, by least squares on the stacked ridge rows.
    z = model.features(wide)
    size = z.shape[1]
    penalty = np.full(size, np.sqrt(quality.RIDGE * 900 / quality.FEATURES))
    penalty[-1] = np.sqrt(1e-9)
    want = np.linalg.lstsq(np.vstack([z, np.diag(penalty)]), np.concatenate([label, np.zeros(size)]), rcond=None)[0]
    model.weights = quality.solve(rows, model)
    assert np.allclose(z @ model.weights, z @ want, atol=1e-6)
    # The kernel that the features stand for: exp(-gamma d^2), up to the error of 256 of them.
    near = np.abs(z[:50, :-1] @ z[:50, :-1].T)
    assert np.allclose(np.diag(near), np.diag(near).mean(), rtol=0.25)
    knots, values = quality.calibrate(rows, model)
    raw = model.raw(wide)
    at = np.clip((raw - quality.LOW) / (quality.HIGH - quality.LOW) * quality.BINS, 0, quality.BINS - 1).astype(int)
    used = np.unique(at)
    mean = np.array([label[at == b].mean() for b in used])
    weight = np.array([(at == b).sum() for b in used])
    # Isotonic regression by its minimax formula.
    sums, sizes = np.concatenate(([0], np.cumsum(mean * weight))), np.concatenate(([0], np.cumsum(weight)))
    fit = [max(min((sums[j + 1] - sums[i]) / (sizes[j + 1] - sizes[i]) for j in range(k, len(used))) for i in range(k + 1))
           for k in range(len(used))]
    blocks = np.unique(np.round(fit, 9))
    assert np.allclose(np.unique(np.round(values, 9)), blocks, atol=1e-8) and (np.diff(values) > 0).all()
