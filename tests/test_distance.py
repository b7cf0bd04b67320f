import numpy as np
import pytest
from pyspark.sql import functions as F

from reptally.operators import distance as ds
from reptally.operators import tables as tb

from sorted_rows import rows

PLACE = ", site string, bio_rep string, tech_rep string"
VALUES = "grp string, unit string, item string, value double"


def random_values(groups, seed=0):
    """groups: {name: (units, items)}; about a third of the cells are filled."""
    rng = np.random.default_rng(seed)
    cells = []
    for g, (n, m) in groups.items():
        for i in range(n):
            for j in range(m):
                if rng.random() < 0.35:
                    cells.append((g, f"{g}u{i}", f"i{j}", float(rng.random() + 0.01)))
    return cells


def dense_distances(cells):
    out = {}
    for g in {c[0] for c in cells}:
        units = sorted({c[1] for c in cells if c[0] == g})
        vectors = {u: {c[2]: c[3] for c in cells if c[1] == u and c[0] == g} for u in units}
        for i, a in enumerate(units):
            for b in units[i + 1 :]:
                items = set(vectors[a]) | set(vectors[b])
                x = np.array([vectors[a].get(k, 0) for k in items])
                y = np.array([vectors[b].get(k, 0) for k in items])
                out[g, a, b] = np.abs(x - y).sum() / (x + y).sum()
    return out


@pytest.mark.parametrize("block,rows_per_task", [(1024, 100_000), (4, 50), (3, 20)])
def test_distances_equal_the_dense_formula(spark, monkeypatch, block, rows_per_task):
    monkeypatch.setattr(ds, "UNITS_PER_BLOCK", block)
    monkeypatch.setattr(ds, "ROWS_PER_TASK", rows_per_task)
    cells = random_values({"big": (23, 9), "two": (2, 5), "three": (3, 4), "alone": (1, 6)}, seed=block)
    got = {(g, a, b): d for g, a, b, d in rows(ds.pair_distances(spark.createDataFrame(cells, VALUES)))}
    want = dense_distances(cells)
    for key, d in want.items():
        assert got.get(key, 1.0) == pytest.approx(d, abs=1e-12)
    assert set(got) <= set(want) and all(a < b for _, a, b in got)


@pytest.mark.parametrize("block,rows_per_task", [(1024, 100_000), (4, 50)])
def test_all_pairs_of_a_group(spark, monkeypatch, block, rows_per_task):
    monkeypatch.setattr(ds, "UNITS_PER_BLOCK", block)
    monkeypatch.setattr(ds, "ROWS_PER_TASK", rows_per_task)
    cells = random_values({"big": (19, 9), "two": (2, 5), "alone": (1, 6)}, seed=7)
    values = spark.createDataFrame(cells, VALUES)
    got = ds.pair_distances(values, every=True)
    want = dense_distances(cells)
    assert {(g, a, b): d for g, a, b, d in rows(got)} == pytest.approx(want, abs=1e-12)
    assert got.groupBy("grp").count().select(F.sum("count")).first()[0] == ds.pairs_per_group(ds.unit_totals(values)).select(F.sum("n_pairs")).first()[0]


def hist_by_hand(cells, places, width=0.05):
    """Counts per class and bin from the dense formula."""
    dense = dense_distances([("", *c[1:]) for c in cells])
    out = {}
    units = sorted(places)
    for i, a in enumerate(units):
        for b in units[i + 1 :]:
            x, y = places[a], places[b]
            kind = 0 if x == y else 1 if x[:2] == y[:2] else 2 if x[0] == y[0] else 3
            k = kind, int(np.ceil(np.round(dense.get(("", a, b), 1.0), 9) / width - 0.5))
            out[k] = out.get(k, 0) + 1
    return out


@pytest.mark.parametrize("block,rows_per_task,dense_item", [(1024, 100_000, 48), (4, 50, 3), (7, 20, 48), (1024, 10, 5)])
def test_histogram_without_pairs_equals_the_dense_formula(spark, monkeypatch, block, rows_per_task, dense_item):
    monkeypatch.setattr(ds, "UNITS_PER_BLOCK", block)
    monkeypatch.setattr(ds, "ROWS_PER_TASK", rows_per_task)
    monkeypatch.setattr(ds, "DENSE_ITEM", dense_item)
    rng = np.random.default_rng(block)
    cells = random_values({"": (140, 9)}, seed=block)
    # one item that all units have, and one without a name
    cells += [("", f"u{i}", "in all", 0.25) for i in range(140)] + [("", f"u{i}", None, 0.5) for i in range(0, 140, 7)]
    names = sorted({c[1] for c in cells}) + ["empty"]
    places = {u: (str(rng.integers(2)), None if rng.random() < 0.2 else str(rng.integers(3)), str(rng.integers(2))) for u in names}
    units = spark.createDataFrame([(u, *p) for u, p in places.items()], "unit string, run string, site string, bio_rep string")
    got = ds.pair_hist(spark.createDataFrame(cells, VALUES), units)
    assert {(r["class_order"], r["bin"]): r["n"] for r in got.collect()} == hist_by_hand(cells, places)


def test_histogram_reads_batches_of_any_size(spark, monkeypatch):
    cells = random_values({"": (30, 40)}, seed=2)
    units = spark.createDataFrame([(f"u{i}", "r", "s", str(i % 3)) for i in range(30)], "unit string, run string, site string, bio_rep string")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        monkeypatch.setattr(ds, "UNITS_PER_BLOCK", 8)
        got = ds.pair_hist(spark.createDataFrame(cells, VALUES), units).collect()
    finally:
        spark.conf.set(key, before)
    assert {(r["class_order"], r["bin"]): r["n"] for r in got} == hist_by_hand(cells, {f"u{i}": ("r", "s", str(i % 3)) for i in range(30)})


def test_no_plan_of_the_histogram_has_pairs(spark):
    units = spark.createDataFrame([("u0", "r", "s", "a")], "unit string, run string, site string, bio_rep string")
    assert ds.pair_hist(spark.createDataFrame([], VALUES), units).count() == 0
    assert ds.pair_hist(spark.createDataFrame([("", "u0", "x", 1.0)], VALUES), units).count() == 0


def test_labels_tell_names_apart(long, spark):
    odd = long(
        ("r", "s1", "f", "t", 1, "x:y", "z", "1"), ("r", "s2", "f", "t", 2, "x", "y:z", "1"), ("r", "s3", "f", "t", 3, "q", None, "1"),
        ("r", "s4", "f", "t", 4, None, "q", "1"), ("r", "s5", "f", "t", 5, "x\\", "y", "1"), ("r", "s6", "f", "t", 6, "\\N", "q", "1"), extra=PLACE,
    )
    values = ds.location_values(odd.withColumn("index", F.col("reads")))
    assert values.select("grp").distinct().count() == values.select("unit").distinct().count() == 6
    bad = values.filter("value = 1").select("unit")
    assert rows(ds.drop_replicates(odd, bad), "sample") == [("s2",), ("s3",), ("s4",), ("s5",), ("s6",)]


def test_identical_and_disjoint_units(spark):
    cells = [("g", "a", "x", 1.0), ("g", "b", "x", 1.0), ("g", "c", "y", 2.0)]
    assert rows(ds.pair_distances(spark.createDataFrame(cells, VALUES))) == [("g", "a", "b", 0.0)]


def test_item_in_every_unit(spark, monkeypatch):
    monkeypatch.setattr(ds, "UNITS_PER_BLOCK", 8)
    cells = [("g", f"u{i:03d}", "hot", 1.0) for i in range(60)] + [("g", f"u{i:03d}", f"own{i}", 1.0) for i in range(60)]
    got = ds.pair_distances(spark.createDataFrame(cells, VALUES))
    assert got.count() == 60 * 59 // 2
    assert got.filter("abs(dist - 0.5) > 1e-12").count() == 0


def test_index(long):
    start = long(("r", "a", "f", "t", 1), ("r", "a", "g", "t", 3), ("r", "b", "f", "t", 2), ("q", "b", "g", "t", 2))
    got = ds.edna_index(start)
    # sample names are shared between runs, as are their totals
    assert rows(got, "sample", "feature", "share", "index") == [
        ("a", "f", 0.25, 0.5), ("a", "g", 0.75, 1.0), ("b", "f", 0.5, 1.0), ("b", "g", 0.5, 2 / 3)]
    by_run = ds.edna_index(start, ["run", "sample"])
    assert rows(by_run.filter("sample = 'b'"), "share") == [(1.0,), (1.0,)]


@pytest.fixture
def placed(long):
    cells = [
        ("r", "s1", "f", 4, "S", "A", "1"), ("r", "s2", "f", 4, "S", "A", "2"), ("r", "s3", "f", 1, "S", "B", "1"),
        ("r", "s3", "g", 1, "S", "B", "1"), ("r", "s4", "g", 1, "T", "A", "1"), ("q", "s1", "h", 1, "S", "A", "1"),
    ]
    return long(*[(r, s, f, f, n, *p) for r, s, f, n, *p in cells], extra=PLACE)


def test_classes_and_histogram(placed):
    index = ds.edna_index(placed, ["run", "sample"])
    pairs = ds.bray_curtis(index)
    units = ds.sample_units(index)
    classed = ds.pair_class(pairs, units)
    assert rows(classed, "a", "b", "pair_class") == [
        ("r:s1", "r:s2", "PCR.replicates"), ("r:s1", "r:s3", "Biol.replicates"), ("r:s2", "r:s3", "Biol.replicates"),
        ("r:s3", "r:s4", "Same Barcode Different Site")]
    assert ds.both_orders(classed).count() == 8
    totals = {r["pair_class"]: r["n_pairs"] for r in ds.class_totals(units).collect()}
    assert totals == {"PCR.replicates": 1, "Biol.replicates": 2, "Same Barcode Different Site": 3, "Different Barcode": 4}
    hist = ds.sample_hist(index)
    assert {r["pair_class"]: r["n"] for r in hist.groupBy("pair_class").agg(F.sum("n").alias("n")).collect()} == totals
    density = hist.groupBy("pair_class").agg(F.sum(F.col("density") * 0.05).alias("x"))
    assert all(r["x"] == pytest.approx(1.0) for r in density.collect())
    # the four pairs across runs share nothing and sit in the bin of distance 1
    assert rows(hist.filter("pair_class = 'Different Barcode'"), "bin", "n") == [(20, 4)]


def test_lone_and_levels(placed):
    assert rows(ds.lone_replicates(placed)) == [("q", "S", "A"), ("r", "S", "B"), ("r", "T", "A")]
    assert rows(ds.lone_replicates(placed, "single")) == [("q", "S"), ("r", "T")]
    assert rows(ds.drop_lone(placed), "sample") == [("s1",), ("s2",)]
    assert rows(ds.replication_level(placed.filter("run = 'r'"))) == [("r", "S", "A", 2), ("r", "S", "B", 1), ("r", "T", "A", 1)]


def principal_centre_distances(dist):
    """Distances to the centroid by way of coordinates."""
    n = len(dist)
    j = np.eye(n) - 1 / n
    values, vectors = np.linalg.eigh(-0.5 * j @ (dist**2) @ j)
    points = vectors * np.sqrt(np.abs(values))
    gap = (points - points.mean(axis=0)) ** 2
    return np.sqrt(np.abs((gap * np.sign(values)).sum(axis=1)))


def test_centroid_mean_against_coordinates(spark):
    cells = random_values({"p": (7, 6), "q": (3, 3), "two": (2, 4), "one": (1, 3)}, seed=4)
    values = spark.createDataFrame(cells, VALUES)
    units = ds.unit_totals(values)
    got = {(g, u): d for g, u, d in rows(ds.centroid_distance(ds.pair_distances(values), units))}
    dense = dense_distances(cells)
    assert not any(g == "one" for g, _ in got)
    for g in ("p", "q", "two"):
        names = sorted(u for gg, u in got if gg == g)
        dist = np.zeros((len(names),) * 2)
        for i, a in enumerate(names):
            for k, b in enumerate(names[i + 1 :], i + 1):
                dist[i, k] = dist[k, i] = dense[g, a, b]
        want = principal_centre_distances(dist)
        assert np.allclose([got[g, u] for u in names], want, atol=1e-7)


def median_distances(dist):
    """Distances to the point that minimises the sum of distances, by many small steps in coordinates."""
    n = len(dist)
    j = np.eye(n) - 1 / n
    values, vectors = np.linalg.eigh(-0.5 * j @ (dist**2) @ j)
    points = vectors * np.sqrt(np.maximum(values, 0))
    centre = points.mean(axis=0)
    for _ in range(20_000):
        gap = np.maximum(np.sqrt(((points - centre) ** 2).sum(axis=1)), 1e-12)
        centre = (points / gap[:, None]).sum(axis=0) / (1 / gap).sum()
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def test_centroid_median_against_coordinates(spark):
    # distances of points in a plane, so that coordinates exist
    rng = np.random.default_rng(11)
    pairs, units, want = [], [], {}
    for g, n in (("big", 9), ("four", 4), ("three", 3), ("two", 2), ("one", 1), ("same", 3)):
        points = rng.random((n, 2)) * 0.5 if g != "same" else np.zeros((n, 2))
        dist = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
        names = [f"{g}{i}" for i in range(n)]
        units += [(g, u) for u in names]
        pairs += [(g, names[i], names[k], float(dist[i, k])) for i in range(n) for k in range(i + 1, n)]
        if n > 1:
            want |= {(g, u): x for u, x in zip(names, median_distances(dist))}
    got = ds.centroid_distance(
        spark.createDataFrame(pairs, "grp string, a string, b string, dist double"), spark.createDataFrame(units, "grp string, unit string"), "median"
    )
    got = {(g, u): d for g, u, d in rows(got)}
    assert got == pytest.approx(want, abs=5e-4)
    assert got["two", "two0"] == pytest.approx(next(d for g, _, _, d in pairs if g == "two") / 2)
    # the sum of distances is least at the median
    assert sum(got["big", f"big{i}"] for i in range(9)) <= sum(want["big", f"big{i}"] for i in range(9)) + 1e-5


def test_median_counts_pairs_that_share_nothing(spark):
    units = spark.createDataFrame([("g", u) for u in "abc"], "grp string, unit string")
    none = spark.createDataFrame([], "grp string, a string, b string, dist double")
    assert [d for *_, d in rows(ds.centroid_distance(none, units, "median"))] == pytest.approx([3**-0.5] * 3)
    with pytest.raises(ValueError):
        ds.centroid_distance(none, units, "mode")


def test_pairs_per_group(spark):
    cells = [(g, f"{g}{i}", f"own{i}", 1.0) for g, n in (("p", 5), ("q", 3)) for i in range(n)]
    values = spark.createDataFrame(cells, VALUES)
    assert rows(ds.pairs_per_group(ds.unit_totals(values))) == [("p", 10), ("q", 3)]


def test_outliers_by_quantile_equal_those_by_probability(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([("g", f"u{i}", float(x)) for i, x in enumerate(rng.normal(0.4, 0.1, 400))], "grp string, unit string, distance double")
    fit = ds.normal_fit(df)
    by_prob = ds.normal_prob(df, fit).filter("prob > 0.975")
    assert by_prob.count() > 0
    assert rows(ds.distance_outliers(df, 0.975), "unit") == rows(by_prob, "unit")
    assert ds.distance_outliers(df, 1.0).count() == 0


def test_drop_replicates(placed, spark):
    bad = spark.createDataFrame([("r:S:A:2",)], "unit string")
    assert rows(ds.drop_replicates(placed, bad), "run", "sample") == [("q", "s1"), ("r", "s1"), ("r", "s3"), ("r", "s3"), ("r", "s4")]


# tables


def test_proportions_and_scaling(long):
    start = tb.taxon_by_sample(long(("r", "a", "f", "t", 1), ("r", "a", "g", "t", 1), ("r", "a", "h", "u", 2), ("r", "z", "f", "t", 0)))
    shares = tb.to_proportion(start)
    assert rows(shares, "sample", "taxon", "share") == [("a", "t", 0.5), ("a", "u", 0.5), ("z", "t", 0.0)]
    assert rows(tb.scale_by_max(shares), "sample", "taxon", "index") == [("a", "t", 1.0), ("a", "u", 1.0), ("z", "t", 0.0)]


def test_runs_side_by_side(long):
    start = tb.taxon_by_sample(long(("r", "a", "f", "t", 1), ("r", "a", "g", "u", 3), ("q", "a", "f", "t", 2), ("q", "a", "g", "u", 2)))
    shares = tb.to_proportion(start)
    assert rows(tb.combine_runs_index(shares), "run", "taxon", "index") == [("q", "t", 1.0), ("q", "u", 2 / 3), ("r", "t", 0.5), ("r", "u", 1.0)]
    assert {r["index"] for r in tb.combine_runs_index(shares, True).collect()} == {1.0}
    assert rows(tb.sum_runs(long(("r", "a", "f", "t", 1), ("q", "a", "f", "t", 2)))) == [("t", "a", 3)]


def test_align_samples_adds_unread_samples(long, spark):
    sheet = spark.createDataFrame([("a", "Sample"), ("b", "Sample"), ("p", "Control")], "sample string, sample_control string")
    got = tb.align_samples(long(("r", "a", "f", "t", 2)), sheet)
    assert got.columns == ["taxon", "a", "b"] and rows(got) == [("t", 2, 0)]


def test_site_tables(long):
    start = long(("r", "a", "f", "t", 2, "S"), ("r", "b", "f", "t", 4, "S"), ("r", "a", "g", "u", 1, "S"), ("r", "c", "f", "t", 5, "T"), extra=", site string")
    assert rows(tb.site_reads(start)) == [("t", "S", 6), ("t", "T", 5), ("u", "S", 1)]
    assert rows(tb.site_index(start), "taxon", "site", "index") == [("t", "S", 0.75), ("t", "T", 1.0), ("u", "S", 1.0)]


def test_items_of_few_units_are_not_sent_to_every_tile(spark, monkeypatch):
    """Both histogram and distances send such an item's pairs, and values only of items that many units have."""
    monkeypatch.setattr(ds, "UNITS_PER_BLOCK", 4)
    sent, stream = [], ds._tile_stream
    monkeypatch.setattr(ds, "_tile_stream", lambda *args: sent.append(stream(*args)) or sent[-1])
    units = [f"u{i:03d}" for i in range(80)]
    cells = [("", u, f"i{k // 4}", 1.0 + k % 3) for k, u in enumerate(units)] + [("", u, None, 1.0) for u in units[:3]] + [("", u, "common", 2.0) for u in units]
    values = spark.createDataFrame(cells, VALUES)
    got = {(a, b): d for _, a, b, d in rows(ds.pair_distances(values))}
    want = {k[1:]: d for k, d in dense_distances(cells).items()}
    assert got == pytest.approx(want, abs=1e-12) and len(got) == 80 * 79 // 2
    places = {u: ("r", str(k % 2), str(k % 3)) for k, u in enumerate(units)}
    hist = ds.pair_hist(values, spark.createDataFrame([(u, *p) for u, p in places.items()], "unit string, run string, site string, bio_rep string"))
    assert {(r["class_order"], r["bin"]): r["n"] for r in hist.collect()} == hist_by_hand(cells, places)
    assert len(sent) == 2
    for parts in sent:
        kinds = {r["kind"]: r["n"] for r in parts.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
        # 20 items of four units and one of three; of 163 values only the 80 of the common one go to all blocks
        assert kinds[1] == 20 * 6 + 3 and kinds[2] == kinds[0] == 80 * 20
        assert {r["name"] for r in parts.filter("kind = 2").select("name").distinct().collect()} == {"=common"}
