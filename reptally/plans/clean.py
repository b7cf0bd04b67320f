"""A whole cleaning run: counts and a sheet in, step tables, log and results out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reptally.functions.storage import cut, new_path
from reptally.operators import blanks as bl
from reptally.operators import crosstalk as ct
from reptally.operators import depth as dp
from reptally.operators import distance as ds
from reptally.operators import filters as fl
from reptally.operators import occupancy as oc
from reptally.operators import steplog as sl
from reptally.operators import tables as tb
from reptally.sources import output, wide

# fixed values: names of the written results
POSITIVE_LIST = "pos.contam.species"
BLANK_LIST = "blank.contam.species"
OCCUPANCY_ALL = "Occupancy_all"
OCCUPANCY_KEPT = "Occupancy_filtered"
DISCARDED = "step5.discarded_samples"
HISTS = ("dissimilarity_pre_occupancy", "dissimilarity_post_occupancy")


@dataclass(frozen=True)
class Options:
    """Settings of a run, with the documented defaults."""

    read_type: str = "merged_only"
    depth_prob: float = 0.05
    min_reads: float = 10000
    runs: int = 2
    thresh: float = 0.7
    prop_thresh: float = 5e-5
    anchor_rank: int = 1
    mode: str = "double"  # double, single or skip (no step 4)
    cutoff: str = oc.CUTOFFS[0]
    points: int = 80
    dist_prob: float = 0.975
    centre: str = "mean"  # or median
    # the index after step 5 is scaled within each run first
    post_double_scale: bool = True

    def __post_init__(self) -> None:
        if self.mode not in ("double", "single", "skip"):
            raise ValueError(self.mode)
        if self.read_type not in fl.READ_TYPES:
            raise ValueError(self.read_type)
        if self.cutoff not in oc.CUTOFFS:
            raise ValueError(self.cutoff)
        if self.centre not in ("mean", "median"):
            raise ValueError(self.centre)

    @property
    def level(self) -> str:
        return "double" if self.mode == "double" else "single"


@dataclass
class Cleaned:
    """Step tables in order, the log, side tables, and results on request."""

    steps: list[DataFrame]
    log: DataFrame
    side: dict[str, DataFrame] = field(default_factory=dict)
    plan: Callable[[], dict[str, DataFrame]] = dict
    plan_hists: Callable[[], dict[str, DataFrame]] = dict

    @cached_property
    def hists(self) -> dict[str, DataFrame]:
        """Dissimilarities of all samples per class before and after step 4, counted when first read."""
        return self.plan_hists()

    @cached_property
    def results(self) -> dict[str, DataFrame]:
        """Planned, with what that writes, when they are first asked for."""
        return self.plan()


class _Run:
    """Writes every table of one run under one folder."""

    def __init__(self, folder: str) -> None:
        self.folder = folder.rstrip("/")

    def keep(self, df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
        path = f"{self.folder}/{name}"
        return output.write_table(df, path, by) if by else cut(df, path=path)


def occupancy(found: DataFrame, options: Options, run: _Run) -> tuple[DataFrame, DataFrame]:
    """Scored features and the cut-offs."""
    patterns = run.keep(oc.presence_pattern(found, options.level), "patterns")
    unique = run.keep(oc.unique_patterns(patterns), "unique_patterns")
    fit = run.keep(oc.occupancy_fit(oc.model_rows(unique, found, options.level)), "occupancy_fit")
    probs = oc.occupancy_prob(fit, options.points)
    scored = run.keep(oc.pattern_occupancy(unique, oc.site_max_occupancy(probs)), "scored_patterns")
    results = run.keep(oc.attach_occupancy(patterns, scored), "occupancy")
    return results, oc.occupancy_cutoffs(scored, options.level)


def clean(counts: DataFrame, sheet: DataFrame, options: Options | None = None, folder: str | None = None) -> Cleaned:
    """Run steps 0 to 5 on (run, sample, feature, taxon, reads); a missing taxon is a label like any.

    Every step is written under ``folder`` (by default in the shared folder) and read
    back, since later steps read it several times; results are planned on those tables.
    """
    options = options or Options()
    run = _Run(folder or new_path(counts.sparkSession, "clean"))
    level = options.level
    sheet = run.keep(wide.sheet_dedupe(sheet), "sheet")

    # step 0: read type, source, places; the sheet is joined once for all steps
    rows = wide.name_taxa(fl.drop_zero(fl.keep_read_type(counts, options.read_type)))
    rows = fl.label_source(fl.attach_sheet(rows, sheet, (*fl.HIERARCHY, "control_type"))).drop("control_type")
    rows = run.keep(rows, "step_0", ["run", "source"])
    parts = {s: rows.filter(F.col("source") == s).drop("source") for s in (fl.SAMPLES, fl.POSITIVES, fl.BLANKS)}
    step0 = parts[fl.SAMPLES]

    # step 1
    vector = run.keep(ct.contam_vector(parts[fl.POSITIVES]), "contamination_vector")
    step1 = run.keep(ct.subtract_proportional(step0, vector), "step_1", ["run"])

    # step 2
    depth = run.keep(dp.sample_depth(step1), "depth")
    bad = dp.depth_outliers(depth, dp.gamma_fit(depth), options.depth_prob, options.min_reads)
    step2 = run.keep(dp.drop_samples(step1, bad), "step_2", ["run"])

    # step 3
    blanks = parts[fl.BLANKS]
    known = blanks.select("run", "feature").distinct()
    sizes = run.keep(bl.group_sizes(step2, mode=level), "group_sizes")
    taken = run.keep(bl.blank_subtract(step2, blanks, options.runs, options.anchor_rank), "subtracted")
    taken = run.keep(bl.group_zero_filter(taken, known, sizes, options.thresh, level), "zero_filtered")
    step3 = run.keep(bl.group_prop_filter(taken, known, options.prop_thresh, level), "step_3", ["run"])

    # step 4
    side: dict[str, DataFrame] = {}
    if options.mode == "skip":
        step4 = step3
    else:
        found = run.keep(oc.detections(step3, level), "detections")
        scored, cutoffs = occupancy(found, options, run)
        kept = oc.occupancy_filter(scored, cutoffs, options.cutoff)
        step4 = run.keep(oc.keep_taxa(step3, kept), "step_4", ["run"])
        side |= {
            OCCUPANCY_ALL: scored,
            OCCUPANCY_KEPT: kept,
            "cutoffs": cutoffs,
            "verdict": oc.occupancy_verdict(scored, cutoffs),
            "occupancy_hist": oc.occupancy_hist(scored),
        }

    # step 5
    index = run.keep(ds.edna_index(step4), "index")
    values = run.keep(ds.location_values(ds.drop_lone(index, level), level), "replicate_values")
    units = run.keep(ds.unit_totals(values), "replicates")
    pairs = run.keep(ds.pair_distances(values, units), "replicate_pairs")
    centres = run.keep(ds.centroid_distance(pairs, units, options.centre), "centre_distances")
    out = ds.distance_outliers(centres, options.dist_prob)
    step5 = run.keep(ds.drop_replicates(step4, out, level), "step_5", ["run"])

    steps = [step0, step1, step2, step3, step4, step5]
    log = run.keep(sl.stage_log(*[sl.stage_summary(s, n) for s, n in zip(steps, sl.STAGES)]), "log")
    side |= {
        POSITIVE_LIST: fl.control_features(rows, fl.POSITIVES),
        BLANK_LIST: fl.control_features(rows, fl.BLANKS),
        DISCARDED: ds.normal_prob(out, ds.normal_fit(centres)),
        "depth": depth,
        "contamination_hist": ct.contam_hist(vector),
        "replication_level": ds.replication_level(step5, level),
    }
    return Cleaned(
        steps,
        log,
        side,
        lambda: results("pre", step3, False) | results("post", step5, options.post_double_scale),
        lambda: {name: ds.sample_hist(run.keep(ds.edna_index(step), f"{name}_index")) for name, step in zip(HISTS, (step3, step4))},
    )


def results(phase: str, long: DataFrame, double_scale: bool) -> dict[str, DataFrame]:
    """Counts, shares and the index by (run, sample), by sample over runs, and by site; all long."""
    reads = tb.taxon_by_sample(long)
    shares = tb.to_proportion(reads)
    summed = tb.sum_runs(long)
    sep = f"{phase}_occupancy_results_sum.taxonomy_tech_reps_separate"
    joint = f"{phase}_occupancy_results_sum.taxonomy_tech_reps_summed"
    site = f"{phase}_occ_site"
    return {
        f"{sep}_read_counts": tb.library(reads).select("taxon", "library", "reads"),
        f"{sep}_proportions": tb.library(shares).select("taxon", "library", "share"),
        f"{sep}_eDNA_index": tb.library(tb.combine_runs_index(shares, double_scale)).select("taxon", "library", "index"),
        f"{joint}_read_counts": summed,
        f"{joint}_eDNA_index": tb.scale_by_max(tb.to_proportion(summed, ["sample"])).select("taxon", "sample", "index"),
        f"{site}_sum.taxonomy_reads_summed": tb.site_reads(long),
        f"{site}_averaged_sum.taxonomy_e_index": tb.site_index(long).select("taxon", "site", "index"),
    }


def write_results(cleaned: Cleaned, sheet: DataFrame, folder: str, form: str = "wide") -> list[str]:
    """Every result as CSV, in ``form`` wide or long, and the side tables, histograms and the log."""
    if form not in ("wide", "long"):
        raise ValueError(form)
    names = sheet.filter(F.coalesce("sample_control", F.lit("")) != fl.CONTROL_MARK).select("sample")
    written = []
    for name, long in cleaned.results.items():
        taxon, column, value = long.columns
        table = long
        if form == "wide":
            table = output.to_wide(long, [taxon], column, value, names if column == "sample" else None)
        written.append(output.write_csv(table, f"{folder}/{name}.csv", [taxon]))
    for name, table in {**cleaned.side, **cleaned.hists, "log": cleaned.log}.items():
        written.append(output.write_csv(table, f"{folder}/{name}.csv"))
    return written


def clean_files(
    spark: SparkSession, tables: Sequence[str], sheet: str, folder: str, options: Options | None = None
) -> Cleaned:
    """The same from wide text tables (one per run, any number) and a sheet file.

    ``folder`` gets the step tables (``tables/``) and the results as CSV (``csv/``).
    """
    folder = folder.rstrip("/")
    known = cut(wide.read_sheet(spark, sheet), path=f"{folder}/tables/sheet_rows")
    counts = wide.rename_samples(wide.run_label(wide.read_long(spark, tables)), known)
    counts = cut(counts, path=f"{folder}/tables/counts")
    cleaned = clean(counts, known, options, f"{folder}/tables")
    write_results(cleaned, known, f"{folder}/csv")
    return cleaned
