import os

import pytest
from pyspark.sql import functions as F

from reptally.operators import distance as ds
from reptally.operators import steplog as sl
from reptally.operators import tables as tb
from reptally.plans.clean import Options, clean, clean_files
from reptally.sources import star

from sorted_rows import rows

FOLDER = "/root/testdata/sf0.001"
SMALL = Options(min_reads=1500, depth_prob=1e-8)


@pytest.fixture(scope="module")
def done(spark):
    return clean(star.counts(spark, FOLDER), star.sheet(spark, FOLDER), SMALL)


def test_nothing_grows(done):
    numbers = {(r["stage"], r["run"], r["stat"]): r["number"] for r in done.log.collect()}
    for run in ("F", "O"):
        for stat in sl.STATS:
            series = [numbers.get((stage, run, stat), 0) for stage in sl.STAGES]
            assert series == sorted(series, reverse=True), (run, stat, series)
    assert numbers["Step_0", "F", "nReads"] > numbers["Step_1.Jump", "F", "nReads"] > 0


def test_result_tables(done):
    assert len(done.results) == 14
    for name, df in done.results.items():
        value = df.columns[-1]
        low, high = df.agg(F.min(value), F.max(value)).first()
        assert low is None or low >= 0
        if value in ("index", "share"):
            assert high <= 1 + 1e-12, name
        if value == "index" and high is not None:
            tops = df.groupBy("taxon").agg(F.max("index").alias("m")).filter("abs(m - 1) > 1e-9")
            assert tops.count() == 0, name
        if value == "share":
            sums = df.groupBy("library").agg(F.sum("share").alias("s")).filter("abs(s - 1) > 1e-9")
            assert sums.count() == 0, name


def test_neutral_settings_change_nothing(spark):
    counts = star.counts(spark, FOLDER)
    sheet = star.sheet(spark, FOLDER).withColumn("control_type", F.lit(None).cast("string"))
    options = Options(read_type="all", min_reads=1, depth_prob=0.0, mode="skip", dist_prob=1.0)
    got = clean(counts, sheet, options)
    for step in got.steps[1:]:
        assert rows(step, *counts.columns) == rows(got.steps[0], *counts.columns)


def test_order_and_partitions_do_not_matter(spark, done):
    counts = star.counts(spark, FOLDER).repartition(13, "taxon").orderBy(F.desc("reads"))
    again = clean(counts, star.sheet(spark, FOLDER), SMALL)
    assert rows(again.log) == rows(done.log)
    assert rows(again.steps[-1]) == rows(done.steps[-1])


def test_without_broadcasts(spark, done, no_broadcast):
    again = clean(star.counts(spark, FOLDER), star.sheet(spark, FOLDER), SMALL)
    assert rows(again.log) == rows(done.log)


def test_options_are_checked():
    for bad in ({"mode": "triple"}, {"read_type": "x"}, {"cutoff": "y"}):
        with pytest.raises(ValueError):
            Options(**bad)


def wide_text(run, copies, features):
    """Wide table: 2 sites x 2 bottles x 3 repeats, one positive and one blank, by a rule."""
    names = [f"S{i}.{run}" for i in range(1, 13)] + [f"P.{run}", f"N.{run}"]
    lines = ["\t".join(["seq_number", *names, "sum.taxonomy"])]
    for kind in ("forward", "merged", "reverse", "unmerged"):
        for j in range(1, features + 1):
            cells = [(j * 37 + i * 11) % 97 * copies if (i + j) % 4 else 0 for i in range(12)]
            cells += [500 if j == features else j % 3, 40 if j == 1 else 0]
            lines.append("\t".join([f"{kind}_{run}_{j}", *map(str, cells), f"k;p;;g{j // 2}"]))
    return "\r\n".join(lines)


def sheet_text(runs):
    lines = ["Seq_number\tNew_name\tSite\tBio_rep\tTech_rep\tSample_Control\tControl_Type"]
    for run in runs:
        for i in range(1, 13):
            site, bottle, repeat = "XY"[(i - 1) // 6], "AB"[(i - 1) // 3 % 2], (i - 1) % 3 + 1
            lines.append(f"S{i}.{run}\t{site}_{bottle}_{repeat}\t{site}\t{bottle}\t{repeat}\tSample\tNA")
        lines.append(f"P.{run}\tpos\tNA\tNA\tNA\tControl\tPos")
        lines.append(f"N.{run}\tneg\tNA\tNA\tNA\tControl\tBlank")
    return "\r\n".join(lines)


@pytest.mark.parametrize("mode", ["double", "single", "skip"])
def test_from_files(spark, tmp_path, mode):
    for run, copies in (("m1", 10), ("m2", 7)):
        (tmp_path / f"{run}.txt").write_text(wide_text(run, copies, 12))
    (tmp_path / "sheet.txt").write_text(sheet_text(["m1", "m2"]))
    out = str(tmp_path / "out")
    options = Options(min_reads=10, depth_prob=1e-8, mode=mode, cutoff="som_min_threshold_1")
    got = clean_files(spark, [str(tmp_path / "m1.txt"), str(tmp_path / "m2.txt")], str(tmp_path / "sheet.txt"), out, options)
    log = {(r["stage"], r["run"], r["stat"]): r["number"] for r in got.log.collect()}
    assert log["Step_0", "m1", "nsamples"] == 12 and log["Step_0", "m2", "nHashes"] == 12
    assert log["Step_3.microDecon", "m1", "nReads"] < log["Step_0", "m1", "nReads"]
    written = sorted(os.listdir(tmp_path / "out" / "csv"))
    assert "log.csv" in written and "pre_occ_site_sum.taxonomy_reads_summed.csv" in written
    site = spark.read.csv(f"{out}/csv/pre_occ_site_sum.taxonomy_reads_summed.csv", header=True, inferSchema=True)
    assert site.columns == ["taxon", "X", "Y"]
    total = site.agg(F.sum("X") + F.sum("Y")).first()[0]
    assert total == got.steps[3].agg(F.sum("reads")).first()[0]
    joint = spark.read.csv(f"{out}/csv/pre_occupancy_results_sum.taxonomy_tech_reps_summed_read_counts.csv", header=True)
    assert len(joint.columns) == 13


def test_step_5_index_is_whole(spark, done):
    index = ds.edna_index(done.steps[4])
    tops = index.groupBy("feature").agg(F.max("index").alias("m")).filter("abs(m - 1) > 1e-12")
    assert tops.count() == 0
    assert tb.taxon_by_sample(done.steps[5]).agg(F.sum("reads")).first()[0] == done.steps[5].agg(F.sum("reads")).first()[0]


def test_an_unassigned_feature_goes_through_all_steps(spark, long):
    places = [("S", b, t) for b in "AB" for t in "123"]
    cells = [("r", f"{s}{b}{t}", f"merged_r_{f}", taxon, 40 + 3 * f + int(t), s, b, t) for s, b, t in places for f, taxon in enumerate([None, "x:y", "x", None])]
    counts = long(*[c[:5] for c in cells])
    sheet = spark.createDataFrame(
        sorted({(c[1], c[1], c[5], c[6], c[7], "Sample", None) for c in cells}),
        "raw_name string, sample string, site string, bio_rep string, tech_rep string, sample_control string, control_type string",
    )
    done = clean(counts, sheet, Options(min_reads=1, depth_prob=0.0, dist_prob=1.0, cutoff="som_min_threshold_3", mode="skip"))
    assert {r["taxon"] for r in done.steps[-1].select("taxon").distinct().collect()} == {"NA", "x:y", "x"}
    site = {r["taxon"]: r["index"] for r in done.results["post_occ_site_averaged_sum.taxonomy_e_index"].collect()}
    assert set(site) == {"NA", "x:y", "x"} and all(v is not None for v in site.values())
    assert done.hists["dissimilarity_pre_occupancy"].agg({"n": "sum"}).first()[0] == 6 * 5 // 2
