import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reptally.functions import numeric as nm
from reptally.operators import blanks as bl
from reptally.operators import crosstalk as ct
from reptally.operators import depth as dp

from sorted_rows import rows

PLACE = ", site string, bio_rep string"


# step 1


def test_vector_is_the_largest_share(long):
    positives = long(("r", "p1", "f", "t", 1), ("r", "p1", "g", "t", 3), ("r", "p2", "f", "t", 2), ("r", "p2", "h", "t", 2))
    assert rows(ct.contam_vector(positives)) == [("r", "f", 0.5), ("r", "g", 0.75), ("r", "h", 0.5)]


def test_subtraction_reaches_zero_and_below(long, spark):
    vector = spark.createDataFrame([("r", "f", 0.1), ("r", "g", 0.5), ("q", "h", 0.9)], "run string, feature string, v double")
    samples = long(("r", "a", "f", "t", 10), ("r", "a", "g", "t", 45), ("r", "a", "h", "t", 45), ("r", "b", "f", "t", 9))
    # sample a: 100 reads, so f loses 10 and g 50; sample b: 9 reads, f loses 1
    assert rows(ct.subtract_proportional(samples, vector), "sample", "feature", "reads") == [("a", "h", 45), ("b", "f", 8)]


def test_run_without_positives_is_unchanged(long):
    samples = long(("r", "a", "f", "t", 10))
    assert rows(ct.subtract_proportional(samples, ct.contam_vector(samples.filter("false")))) == rows(samples)


def test_hist_bins_are_centred_on_the_ends(spark):
    vector = spark.createDataFrame([("r", str(i), i / 29) for i in range(30)] + [("q", "x", 0.5)], "run string, feature string, v double")
    assert rows(ct.contam_hist(vector)) == [("q", 0, 1)] + [("r", i, 1) for i in range(30)]


# step 2


def test_gamma_cdf_against_closed_forms():
    x = np.array([0.01, 0.5, 1.0, 3.0, 20.0])
    assert np.allclose(nm.gamma_cdf(x, 1.0, 2.0), 1 - np.exp(-x / 2), atol=1e-14)
    assert np.allclose(nm.gamma_cdf(x, 3.0, 1.0), 1 - np.exp(-x) * (1 + x + x * x / 2), atol=1e-13)
    assert nm.gamma_cdf(np.array([0.0, np.inf]), 2.0, 1.0).tolist() == [0.0, 1.0]


def test_gamma_quantile_inverts():
    for shape, scale in ((0.3, 5.0), (1.0, 2.0), (250.0, 12.0)):
        for p in (0.01, 0.5, 0.99):
            q = nm.gamma_quantile(p, shape, scale)
            assert nm.gamma_cdf(np.array([q]), shape, scale)[0] == pytest.approx(p, abs=1e-10)


def test_digamma_and_trigamma():
    assert nm.digamma(1.0) == pytest.approx(-0.5772156649015329, abs=1e-12)
    assert nm.trigamma(1.0) == pytest.approx(math.pi**2 / 6, abs=1e-11)


def test_gamma_fit_recovers_parameters(spark):
    depths = np.random.default_rng(3).gamma(6.0, 400.0, 20000)
    df = spark.createDataFrame([(float(x),) for x in depths], "tot double")
    fit = dp.gamma_fit(df)
    assert fit.n == 20000 and fit.shape == pytest.approx(6.0, rel=0.05) and fit.scale == pytest.approx(400.0, rel=0.05)
    # the likelihood has its maximum there
    def loglik(shape, scale):
        return np.sum((shape - 1) * np.log(depths) - depths / scale) - len(depths) * (math.lgamma(shape) + shape * math.log(scale))

    best = loglik(fit.shape, fit.scale)
    for a, b in ((1.01, 1), (0.99, 1), (1, 1.01), (1, 0.99), (1.01, 0.99)):
        assert loglik(fit.shape * a, fit.scale * b) < best


def test_outliers_by_quantile_equal_those_by_probability(spark):
    depths = [int(x) for x in np.random.default_rng(5).gamma(3.0, 1000.0, 500)]
    df = spark.createDataFrame([("r", f"s{i}", x) for i, x in enumerate(depths)], "run string, sample string, tot bigint")
    fit = dp.gamma_fit(df)
    by_prob = dp.gamma_prob(df, fit).filter((F.col("prob") < 0.05) | (F.col("tot") < 500))
    assert rows(dp.depth_outliers(df, fit, 0.05, 500), "sample") == rows(by_prob, "sample")


def test_equal_depths_and_neutral_settings(spark):
    df = spark.createDataFrame([("r", "a", 7), ("r", "b", 7)], "run string, sample string, tot bigint")
    assert dp.depth_outliers(df, dp.gamma_fit(df), 0.05, 1).count() == 0
    assert dp.gamma_fit(df.filter("false")).n == 0


def test_low_sample_leaves_every_run(long, spark):
    start = long(("r", "a", "f", "t", 1), ("q", "a", "f", "t", 99), ("q", "b", "f", "t", 50))
    bad = spark.createDataFrame([("r", "a")], "run string, sample string")
    assert rows(dp.drop_samples(start, bad), "run", "sample") == [("q", "b")]
    assert rows(dp.drop_samples(start, bad, ["run", "sample"]), "run", "sample") == [("q", "a"), ("q", "b")]


# step 3


def test_mean_blank_counts_zeros(long):
    blanks = long(("r", "b1", "f", "t", 4), ("r", "b2", "g", "t", 2), ("q", "b1", "f", "t", 3))
    assert rows(bl.mean_blank(blanks)) == [("q", "f", 3.0), ("r", "f", 2.0), ("r", "g", 1.0)]


def brute_subtract(samples, blanks, runs, rank):
    out = {k: dict(v) for k, v in samples.items()}
    for _ in range(runs):
        for s, cells in out.items():
            ratios = sorted(cells[f] / blanks[f] for f in cells if f in blanks)
            if len(ratios) < rank:
                continue
            for f in [f for f in cells if f in blanks]:
                cells[f] -= math.floor(ratios[rank - 1] * blanks[f] + 0.5)
                if cells[f] <= 0:
                    del cells[f]
    return sorted((s, f, n) for s, cells in out.items() for f, n in cells.items())


@pytest.mark.parametrize("runs,rank", [(0, 1), (1, 1), (2, 1), (3, 2)])
def test_blank_subtract_against_brute_force(long, runs, rank):
    rng = np.random.default_rng(runs + 10)
    samples = {f"s{i}": {f"f{j}": int(rng.integers(1, 200)) for j in range(12) if rng.random() < 0.7} for i in range(8)}
    blank = {f"f{j}": int(rng.integers(1, 30)) for j in range(0, 12, 2)}
    df = long(*[("r", s, f, "t", n) for s, cells in samples.items() for f, n in cells.items()])
    blanks = long(*[("r", "b", f, "t", n) for f, n in blank.items()])
    got = bl.blank_subtract(df, blanks, runs, rank)
    assert rows(got, "sample", "feature", "reads") == brute_subtract(samples, blank, runs, rank)


def test_run_without_blanks_is_unchanged(long):
    samples = long(("r", "a", "f", "t", 5), ("q", "a", "f", "t", 6))
    blanks = long(("q", "b", "f", "t", 6))
    assert rows(bl.blank_subtract(samples, blanks), "run", "reads") == [("r", 5)]


def group_rows(long):
    cells = [("a1", "f", 5), ("a1", "g", 95), ("a2", "g", 99), ("a3", "g", 50), ("a3", "h", 1), ("b1", "f", 1)]
    return long(*[("r", s, f, "t", n, "S", s[0].upper()) for s, f, n in cells], extra=PLACE)


def test_zero_filter(long, spark):
    start = group_rows(long)
    known = spark.createDataFrame([("r", "f"), ("r", "g")], "run string, feature string")
    sizes = bl.group_sizes(start)
    assert rows(sizes) == [("r", "S", "A", 3), ("r", "S", "B", 1)]
    # f is absent from 2 of 3 samples of A; h is as rare but in no blank
    got = bl.group_zero_filter(start, known, sizes, 0.6)
    assert rows(got, "sample", "feature") == [("a1", "g"), ("a2", "g"), ("a3", "g"), ("a3", "h"), ("b1", "f")]
    assert bl.group_zero_filter(start, known, sizes, 0.7).count() == start.count()


def test_prop_filter(long, spark):
    start = group_rows(long)
    known = spark.createDataFrame([("r", "f")], "run string, feature string")
    got = bl.group_prop_filter(start, known, 0.05)
    assert ("a1", "f") not in rows(got, "sample", "feature") and got.count() == start.count() - 1
    assert bl.group_prop_filter(start, known, 0.01).count() == start.count()


def test_group_sizes_from_the_sheet(long, spark):
    sheet = spark.createDataFrame([("a", "S", "A"), ("b", "S", "B")], "sample string, site string, bio_rep string")
    start = long(("r", "a", "f", "t", 1), ("r", "a", "g", "t", 1), ("r", "b", "f", "t", 1))
    assert rows(bl.group_sizes(start, sheet, "single")) == [("r", "S", 2)]


def test_top_feature_and_removed(long):
    start = long(("r", "a", "f", "t", 5), ("r", "b", "g", "t", 5), ("q", "a", "h", "t", 1))
    assert rows(bl.top_feature(start), "run", "feature") == [("q", "h"), ("r", "f")]
    removed = bl.reads_removed(start, start.filter("feature <> 'f'"), ["feature"])
    assert rows(removed) == [("f", 5, 0, 5), ("g", 5, 5, 0), ("h", 1, 1, 0)]
