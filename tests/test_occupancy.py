import numpy as np
import pytest

from reptally.operators import occupancy as oc

from sorted_rows import rows

PLACE = ", site string, bio_rep string, tech_rep string"


@pytest.fixture
def start(long):
    cells = [
        ("f", "S", "A", "1"), ("f", "S", "A", "2"), ("f", "S", "B", "1"),
        ("g", "S", "A", "3"), ("g", "T", "A", "1"),
        ("h", "S", "B", "2"), ("h", "T", "B", "2"),
    ]
    return long(*[("r", f"{s}{b}{t}", f, f"x{f}", 2, s, b, t) for f, s, b, t in cells], extra=PLACE)


def test_patterns(start):
    found = oc.detections(start)
    assert rows(oc.replicate_count(found)) == [("S", 3), ("T", 2)]
    got = oc.presence_pattern(found)
    assert rows(got, "feature", "site", "pattern", "detections", "max_detections", "k") == [
        ("f", "S", "A=2.B=1", 3, 2, 3), ("g", "S", "A=1", 1, 1, 3), ("g", "T", "A=1", 1, 1, 2),
        ("h", "S", "B=1", 1, 1, 3), ("h", "T", "B=1", 1, 1, 2),
    ]
    assert oc.unique_patterns(got).count() == 5
    by_pattern = oc.unique_patterns(got, by_k=False)
    assert rows(by_pattern, "pattern", "feature", "site", "n_rows") == [
        ("A=1", "g", "S", 2), ("A=2.B=1", "f", "S", 1), ("B=1", "h", "S", 2)]


def test_single_mode(start):
    found = oc.detections(start, "single")
    got = oc.presence_pattern(found, "single")
    assert rows(got, "feature", "site", "pattern", "detections", "k") == [
        ("f", "S", "A=1.B=1", 2, 2), ("g", "S", "A=1", 1, 2), ("g", "T", "A=1", 1, 2),
        ("h", "S", "B=1", 1, 2), ("h", "T", "B=1", 1, 2)]
    unique = oc.unique_patterns(got)
    # equal K and pattern at two sites: one representative, the smallest
    assert rows(unique, "pattern", "feature", "site", "n_rows") == [
        ("A=1", "g", "S", 2), ("A=1.B=1", "f", "S", 1), ("B=1", "h", "S", 2)]
    assert rows(oc.model_rows(unique, found, "single"), "feature", "k", "n") == [("f", 2, 2), ("g", 2, 1), ("h", 2, 1)]


def test_detection_counts(start):
    assert rows(oc.detection_counts(oc.detections(start)).filter("feature = 'f'"), "bio_rep", "n_det") == [("A", 2), ("B", 1)]
    single = oc.detection_counts(oc.detections(start, "single"), "single")
    assert rows(single.filter("feature = 'f'"), "site", "n_det") == [("S", 2)]


def test_fit_counts_rows_without_detections(spark):
    model = spark.createDataFrame(
        [("f", "S", "A", 3, 2), ("f", "S", "B", 3, 0), ("f", "T", "A", 4, 1)],
        "feature string, site string, bio_rep string, k bigint, n bigint",
    )
    fit = oc.occupancy_fit(model)
    assert rows(fit, "site", "bio_rep", *oc.PARAMETERS) == [
        ("S", "A", 3, 3, 5, 6, 1, 13), ("S", "B", 3, 3, 5, 6, 1, 13), ("T", "A", 3, 2, 5, 6, 1, 13)]


@pytest.mark.parametrize(
    "k,n,pars",
    [(3, 1, (3, 2, 3, 4, 1, 10)), (6, 5, (4, 2, 12, 9, 1, 10)), (5, 0, (3, 4, 5, 9, 1, 25)), (8, 2, (40, 2, 300, 500, 1, 10))],
)
def test_probability_against_posterior_draws(spark, k, n, pars):
    fit = spark.createDataFrame(
        [("f", "S", "A", k, n, *pars)],
        "feature string, site string, bio_rep string, k bigint, n bigint, " + ", ".join(f"{p} bigint" for p in oc.PARAMETERS),
    )
    got = oc.occupancy_prob(fit).first()
    rng = np.random.default_rng(1)
    psi, p11, p10 = (rng.beta(a, b, 2_000_000) for a, b in zip(pars[::2], pars[1::2]))
    real = psi * p11**n * (1 - p11) ** (k - n)
    draws = real / (real + (1 - psi) * p10**n * (1 - p10) ** (k - n))
    assert got["mean"] == pytest.approx(draws.mean(), abs=1e-3)
    assert got["sd"] == pytest.approx(draws.std(), abs=2e-3)


FIT = "feature string, site string, bio_rep string, k bigint, n bigint, " + ", ".join(f"{p} bigint" for p in oc.PARAMETERS)


def fine_grid(k, n, pars, points=220):
    """Mean and deviation on a fine grid of log-odds."""
    sides = []
    for a, b in zip(pars[::2], pars[1::2]):
        m, s = np.log(a / b), np.sqrt(1 / a + 1 / b)
        y = np.linspace(m - 20 / a - 6 * s, m + 20 / b + 6 * s, points)
        x, rest = -np.log1p(np.exp(-y)), -np.log1p(np.exp(y))
        w = np.exp(a * x + b * rest - (a * x + b * rest).max())
        sides.append((x, rest, w / w.sum()))
    (x1, r1, w1), (x2, r2, w2), (x3, r3, w3) = sides
    e = (r1 - x1)[:, None, None] - (n * x2 + (k - n) * r2)[None, :, None] + (n * x3 + (k - n) * r3)[None, None, :]
    r = 1 / (1 + np.exp(np.clip(e, -700, 700)))
    w = w1[:, None, None] * w2[None, :, None] * w3[None, None, :]
    return (w * r).sum(), np.sqrt((w * r * r).sum() - (w * r).sum() ** 2)


def test_probability_equals_a_fine_grid(spark):
    sets = [
        (3, 1, (3, 2, 3, 4, 1, 10)), (3, 0, (2, 3, 2, 2, 1, 13)), (1, 1, (3, 2, 3, 2, 1, 10)), (10, 10, (5, 2, 40, 12, 1, 10)),
        (10, 1, (2, 12, 3, 11, 4, 30)), (30, 2, (3, 2, 4, 30, 2, 39)), (10, 0, (2, 30, 2, 2, 1, 400)),
    ]
    fit = spark.createDataFrame([(f"f{i}", "S", "A", k, n, *pars) for i, (k, n, pars) in enumerate(sets)], FIT)
    got = {r["feature"]: r for r in oc.occupancy_prob(fit).collect()}
    for i, (k, n, pars) in enumerate(sets):
        mean, sd = fine_grid(k, n, pars)
        assert got[f"f{i}"]["mean"] == pytest.approx(mean, abs=5e-7)
        assert got[f"f{i}"]["sd"] == pytest.approx(sd, abs=5e-7)


def test_many_replicates_are_integrated_on_more_points(spark, monkeypatch):
    monkeypatch.setattr(oc, "MOST_POINTS", 128)
    rare = (100, 3, (3, 2, 5, 99, 1, 10))
    fit = spark.createDataFrame([("f", "S", "A", rare[0], rare[1], *rare[2]), ("g", "S", "A", 3, 1, 3, 2, 3, 4, 1, 10)], FIT)
    got = {r["feature"]: r for r in oc.occupancy_prob(fit, change=True).collect()}
    assert got["f"]["mean"] == pytest.approx(fine_grid(*rare, points=300)[0], abs=2e-4)
    assert got["g"]["change"] < oc.SETTLED
    # without detections among many the feature is as good as absent, with all of them as good as certain
    sure = spark.createDataFrame([("none", "S", "A", 5000, 0, 2, 3, 500, 500, 1, 5010), ("all", "S", "A", 5000, 5000, 3, 2, 5002, 2, 1, 10)], FIT)
    got = {r["feature"]: r["mean"] for r in oc.occupancy_prob(sure, points=32).collect()}
    assert got["none"] == pytest.approx(0, abs=1e-6) and got["all"] == pytest.approx(1, abs=1e-6)


def test_the_plan_explodes_nothing_and_has_no_python(spark):
    fit = spark.createDataFrame([(3, 1, 3, 2, 3, 4, 1, 10)], "k bigint, n bigint, " + ", ".join(f"{p} bigint" for p in oc.PARAMETERS))
    plan = oc._integrated(fit, 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Python" not in plan and "Pandas" not in plan


def test_a_missing_taxon_is_one_of_its_own(spark, long):
    start = long(("r", "a", "f", None, 1), ("r", "a", "g", "x", 1), ("r", "a", "h", "", 1))
    names = lambda *taxa: spark.createDataFrame([(t,) for t in taxa], "taxon string")
    assert rows(oc.keep_taxa(start, names(None)), "feature") == [("f",)]
    assert rows(oc.keep_taxa(start, names("x", None)), "feature") == [("f",), ("g",)]
    assert rows(oc.keep_taxa(start, names("")), "feature") == [("h",)]


def test_plugin(spark):
    df = spark.createDataFrame([(3, 1)], "k bigint, n bigint")
    real, false = 0.6 * 0.4 * 0.36, 0.4 * 0.1 * 0.81
    assert oc.occupancy_plugin(df, 0.6, 0.4, 0.1).first()["prob"] == pytest.approx(real / (real + false))


SCORED = "k bigint, pattern string, occupancy double, detections bigint, max_detections bigint, n_rows bigint"


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(
        [(3, "1.NA", 0.4, 1, 1, 2), (3, "1.1", 0.6, 2, 1, 1), (3, "2.1", 0.8, 3, 2, 1), (3, "2.2", 0.9, 4, 2, 1)], SCORED)


def test_cutoffs_by_mode(scored):
    assert tuple(oc.occupancy_cutoffs(scored).first()) == (0.4, 0.6, 0.8)
    assert tuple(oc.occupancy_cutoffs(scored.filter("pattern <> '2.2'"), "single").first()) == (0.4, 0.6, 0.8)


def test_verdict_filter_and_taxa(spark, scored, long):
    patterns = spark.createDataFrame(
        [("f", "x", "S", 3, "1.NA"), ("g", "x", "S", 3, "2.1"), ("h", "y", "S", 3, "1.NA"), ("i", "z", "S", 9, "1.1")],
        "feature string, taxon string, site string, k bigint, pattern string",
    )
    results = oc.attach_occupancy(patterns, scored)
    assert rows(results.filter("occupancy is not null"), "feature", "occupancy") == [("f", 0.4), ("g", 0.8), ("h", 0.4)]
    cutoffs = oc.occupancy_cutoffs(scored)
    assert rows(oc.occupancy_verdict(results, cutoffs)) == [("Borderline", 3, 75.0), ("Keep", 1, 25.0)]
    kept = oc.occupancy_filter(results, cutoffs, oc.CUTOFFS[1])
    assert rows(kept, "feature") == [("g",)]
    # one taxon with two features: both stay once one of them is kept
    start = long(*[("r", "a", f, t, 1) for f, t in (("f", "x"), ("g", "x"), ("h", "y"))])
    assert rows(oc.keep_taxa(start, kept), "feature") == [("f",), ("g",)]
    assert rows(oc.keep_taxa(start, kept, ["feature"]), "feature") == [("g",)]
    assert rows(oc.occupancy_hist(results)) == [(0, 2), (29, 1)]
    with pytest.raises(ValueError):
        oc.occupancy_filter(results, cutoffs, "none")
