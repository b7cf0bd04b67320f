"""Step 3: contamination seen in the blanks.

Each round takes the blank profile off every sample, scaled by an anchor feature that is
taken to be pure contamination. The idea follows McKnight et al. (2019), Environmental
DNA; how the anchor is chosen (a rank among the ratios) is our own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.functions.storage import cut
from reptally.operators.filters import BLANKS, attach_sheet

MODES = ("double", "single")


def group_columns(mode: str) -> list[str]:
    """Columns of a replicate group: bottles of a site (single) or repeats of a bottle (double)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return ["site", "bio_rep"] if mode == "double" else ["site"]


def blank_rows(labelled: DataFrame) -> DataFrame:
    """Rows of the blanks. A run without blanks has none and passes step 3 unchanged."""
    return labelled.filter(F.col("source") == BLANKS)


def top_feature(long: DataFrame, n: int = 1, keys: Sequence[str] = ("run",)) -> DataFrame:
    """The ``n`` rows with most reads per key; every task passes on at most ``n`` rows per key."""
    order = Window.partitionBy(*keys).orderBy(F.desc("reads"), "feature", "sample")
    return long.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= n).drop("_at")


def group_sizes(long: DataFrame, sheet: DataFrame | None = None, mode: str = "double") -> DataFrame:
    """Samples per run and replicate group."""
    group = group_columns(mode)
    known = all(c in long.columns for c in group)
    samples = long.select("run", "sample", *(group if known else [])).distinct()
    if not known:
        dim = sheet.select("sample", *group).distinct()
        samples = samples.join(dim, "sample", "left").fillna("NA", group)
    return samples.groupBy("run", *group).agg(F.count_distinct("sample").alias("n_samples"))


def mean_blank(blanks: DataFrame) -> DataFrame:
    """Mean reads per feature over all blanks of the run, absences counted as 0."""
    sums = blanks.groupBy("run", "feature").agg(F.sum("reads").alias("b"))
    numbers = blanks.groupBy("run").agg(F.count_distinct("sample").alias("n_blanks"))
    return attach(sums, numbers, ["run"], "inner", by=["feature"]).select(
        "run", "feature", (F.col("b") / F.col("n_blanks")).alias("b")
    )


def _anchor(mixed: DataFrame, rank: int) -> DataFrame:
    """Per sample, the ``rank``-th smallest ratio of reads to blank reads."""
    keys = ["run", "sample"]
    ratio = F.col("reads") / F.col("b")
    if rank == 1:
        return mixed.groupBy(*keys).agg(F.min(ratio).alias("scale"))
    order = Window.partitionBy(*keys).orderBy("scale", "feature")
    return (
        mixed.select(*keys, "feature", ratio.alias("scale"))
        .withColumn("_at", F.row_number().over(order))
        .filter(F.col("_at") == rank)
        .select(*keys, "scale")
    )


def blank_subtract(
    samples: DataFrame, blanks: DataFrame, runs: int = 2, anchor_rank: int = 1
) -> DataFrame:
    """Take the scaled blank profile off each sample, ``runs`` times over.

    Features that no blank holds are never touched. A sample with fewer than
    ``anchor_rank`` features in common with the blanks is left as it is.
    """
    if runs < 1:
        return samples
    profile = mean_blank(blanks)
    rows = cut(attach(samples, profile, ["run", "feature"], by=["sample"]), "blank-profile")
    untouched = rows.filter(F.col("b").isNull())
    mixed = rows.filter(F.col("b").isNotNull())
    for i in range(runs):
        if i:
            mixed = cut(mixed, "blank-round")
        mixed = attach(mixed, _anchor(mixed, anchor_rank), ["run", "sample"], by=["feature"])
        taken = F.floor(F.col("scale") * F.col("b") + F.lit(0.5))
        mixed = (
            mixed.withColumn("reads", F.col("reads") - F.coalesce(taken, F.lit(0)))
            .filter(F.col("reads") > 0)
            .drop("scale")
        )
    return untouched.unionByName(mixed).select(*samples.columns)


def group_zero_filter(
    long: DataFrame,
    blank_features: DataFrame,
    sizes: DataFrame,
    thresh: float = 0.7,
    mode: str = "double",
) -> DataFrame:
    """Drop a blank feature from a group if at least ``thresh`` of the samples lack it.

    ``long`` carries the group columns and has one row per (run, sample, feature).
    """
    group = ["run", *group_columns(mode)]
    present = (
        attach(long, blank_features.select("run", "feature").distinct(), ["run", "feature"], "left_semi", by=["sample"])
        .groupBy(*group, "feature")
        .agg(F.count(F.lit(1)).alias("n_present"))
    )
    bad = (
        attach(present, sizes, group, "inner", by=["feature"])
        .filter(F.col("n_samples") - F.col("n_present") >= F.col("n_samples") * F.lit(thresh))
        .select(*group, "feature")
    )
    return attach(long, bad, [*group, "feature"], "left_anti", by=["sample"]).select(*long.columns)


def group_prop_filter(
    long: DataFrame, blank_features: DataFrame, prop_thresh: float = 5e-5, mode: str = "double"
) -> DataFrame:
    """Drop a blank feature from a group if it holds less than ``prop_thresh`` of the reads."""
    group = ["run", *group_columns(mode)]
    reads = long.groupBy(*group, "feature").agg(F.sum("reads").alias("reads"))
    totals = reads.groupBy(*group).agg(
        F.sum("reads").alias("group_reads"), F.count(F.lit(1)).alias("n_rows")
    )
    low = attach(reads, totals, group, "inner", by=["feature"], counted="n_rows").filter(
        F.col("reads") < F.col("group_reads") * F.lit(prop_thresh)
    )
    bad = attach(
        low.select(*group, "feature"),
        blank_features.select("run", "feature").distinct(),
        ["run", "feature"],
        "left_semi",
        by=group,
    )
    return attach(long, bad, [*group, "feature"], "left_anti", by=["sample"]).select(*long.columns)


def reads_removed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reads before and after a step and their difference, in one shuffle."""
    sides = before.select(*keys, F.col("reads").alias("x"), F.lit(0).cast("bigint").alias("y")).unionByName(
        after.select(*keys, F.lit(0).cast("bigint").alias("x"), F.col("reads").alias("y"))
    )
    return (
        sides.groupBy(*keys)
        .agg(F.sum("x").alias("reads_before"), F.sum("y").alias("reads_after"))
        .withColumn("removed", F.col("reads_before") - F.col("reads_after"))
    )


__all__ = [
    "attach_sheet",
    "blank_rows",
    "blank_subtract",
    "group_columns",
    "group_prop_filter",
    "group_sizes",
    "group_zero_filter",
    "mean_blank",
    "reads_removed",
    "top_feature",
]
