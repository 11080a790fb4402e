import math

import numpy as np
import pytest

from cohortwise.functions import distributions as d
from cohortwise.functions.columns import poisson_one_cdf


@pytest.fixture(scope="module")
def jvm(spark):
    return spark._jvm.org.apache.commons.math3.distribution


@pytest.mark.parametrize("dof", [0.7, 1.0, 2.5, 5.5, 18.0, 75.0, 1234.5, 4e5, 2e6])
@pytest.mark.parametrize("t", [0.0, 0.01, 0.5, 1.5, 3.0, 6.0])
def test_t_tails(jvm, t, dof):
    expected = 2 * jvm.TDistribution(dof).cumulativeProbability(-t)
    assert d.t_tails(np.array([t]), np.array([dof]))[0] == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("dof", [1.5, 5.5, 25.0, 73.2, 4e5])
@pytest.mark.parametrize("q", [0.9, 0.975, 0.995])
def test_t_quantile(jvm, q, dof):
    expected = jvm.TDistribution(dof).inverseCumulativeProbability(q)
    assert d.t_quantile(np.array([q]), np.array([dof]))[0] == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("dof", [1, 2, 3, 5, 10, 29, 200])
@pytest.mark.parametrize("x", [0.0, 0.1, 1.0, 20.0, 250.0])
def test_chi2_tail(jvm, x, dof):
    expected = 1 - jvm.ChiSquaredDistribution(float(dof)).cumulativeProbability(x)
    assert d.chi2_tail([x], [dof])[0] == pytest.approx(expected, abs=1e-12)


def test_normal():
    assert d.normal_tails([1.959963984540054])[0] == pytest.approx(0.05, abs=1e-12)
    assert d.normal_quantile(0.975) == pytest.approx(1.959963984540054, abs=1e-12)


def test_undefined_becomes_null(spark):
    df = spark.createDataFrame([(2.0, 5.5), (None, 5.5), (1.0, None)], "t double, dof double")
    got = [r[0] for r in df.select(d.t_p("t", "dof")).collect()]
    assert got[0] == pytest.approx(0.09675439, abs=1e-8) and got[1:] == [None, None]


def test_poisson_probabilities():
    cdf = poisson_one_cdf()
    assert cdf[:5] == pytest.approx([0.367879441, 0.735758882, 0.919698603, 0.981011843, 0.996340153], abs=1e-9)
    assert all(a < b for a, b in zip(cdf, cdf[1:])) and cdf[-1] <= 1.0


@pytest.mark.parametrize("dof", [1e5, 1e6, 1.001e6, 1e7, 1e9])
def test_t_approaches_the_normal_without_a_jump(dof):
    t = np.array([0.1, 1.0, 1.96, 4.0])
    # Second term of the expansion of the tail in 1 / dof.
    density = np.exp(-t * t / 2) / np.sqrt(2 * np.pi)
    wanted = d.normal_tails(t) + 2 * density * (t + t**3) / (4 * dof)
    assert d.t_tails(t, np.full(4, dof)) == pytest.approx(wanted, rel=30 / dof + 1e-12)


def test_half_step_of_log_gamma():
    for a in (0.05, 0.5, 3.7, 40.0, 500.0):
        assert d.log_gamma_step(np.array([a]))[0] == pytest.approx(math.lgamma(a + 0.5) - math.lgamma(a), abs=1e-12)
