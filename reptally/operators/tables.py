"""Result tables: counts, proportions and the index, by sample, over runs and by site."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.operators.filters import CONTROL_MARK
from reptally.sources.output import to_wide


def taxon_by_sample(long: DataFrame) -> DataFrame:
    """Reads per taxon and (run, sample); absent cells are 0."""
    return long.groupBy("taxon", "run", "sample").agg(F.sum("reads").alias("reads"))


def library(long: DataFrame) -> DataFrame:
    """Adds ``library``, the run and sample in one name."""
    return long.withColumn("library", F.concat_ws("_", "run", "sample"))


def to_proportion(long: DataFrame, keys: Sequence[str] = ("run", "sample"), value: str = "reads") -> DataFrame:
    """Share of each sample's total; a sample without reads stays at 0."""
    keys = list(keys)
    totals = long.groupBy(*keys).agg(F.sum(value).alias("_total"), F.count(F.lit(1)).alias("n_rows"))
    rows = attach(long, totals, keys, by=["taxon"], counted="n_rows")
    share = F.coalesce(F.try_divide(F.col(value).cast("double"), F.col("_total")), F.lit(0.0))
    return rows.withColumn("share", share).select(*long.columns, "share")


def scale_by_max(long: DataFrame, keys: Sequence[str] = ("taxon",), value: str = "share") -> DataFrame:
    """Values divided by the taxon's largest one."""
    keys = list(keys)
    tops = long.groupBy(*keys).agg(F.max(value).alias("_top"), F.count(F.lit(1)).alias("n_rows"))
    others = [c for c in long.columns if c not in keys]
    rows = attach(long, tops, keys, by=others, counted="n_rows")
    scaled = F.coalesce(F.try_divide(F.col(value), F.col("_top")), F.lit(0.0))
    return rows.withColumn("index", scaled).select(*[c for c in long.columns if c != "index"], "index")


def combine_runs_index(shares: DataFrame, double_scale: bool = False) -> DataFrame:
    """Index over all runs side by side, from proportions or, twice scaled, from the index of each run."""
    if not double_scale:
        return scale_by_max(shares)
    return scale_by_max(scale_by_max(shares, ["run", "taxon"]), ["taxon"], "index")


def sum_runs(long: DataFrame) -> DataFrame:
    """Reads of the same sample added over runs."""
    return long.groupBy("taxon", "sample").agg(F.sum("reads").alias("reads"))


def align_samples(long: DataFrame, sheet: DataFrame, cells: bool = False) -> DataFrame:
    """Wide counts with a column for every sample that has reads or is in the sheet as no control;
    with ``cells`` a row per cell, for any number of samples."""
    names = sheet.filter(F.coalesce(F.col("sample_control"), F.lit("")) != CONTROL_MARK).select("sample")
    return to_wide(long, ["taxon"], "sample", "reads", names, cells)


def count_matrix(long: DataFrame, cells: bool = False) -> DataFrame:
    """Features by samples with the taxon of each feature; with ``cells`` a row per cell, for any
    number of samples."""
    return to_wide(long, ["feature", "taxon"], "sample", "reads", cells=cells)


def site_reads(long: DataFrame) -> DataFrame:
    """Reads per taxon and site."""
    return long.groupBy("taxon", "site").agg(F.sum("reads").alias("reads"))


def site_index(long: DataFrame) -> DataFrame:
    """Mean reads per site and taxon over the rows present, as a share, over the taxon's largest."""
    means = long.groupBy("taxon", "site").agg(F.avg("reads").alias("mean_reads"))
    return scale_by_max(to_proportion(means, ["site"], "mean_reads"))


def attach_taxon(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Replace the taxon id by its label."""
    ids = dim.select("taxon_id", "taxon")
    others = [c for c in rows.columns if c != "taxon_id"]
    return attach(rows, ids, ["taxon_id"], by=others).select("taxon", *others)
