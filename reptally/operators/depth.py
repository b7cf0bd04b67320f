"""Step 2: samples with few reads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.functions.numeric import gamma_probability, gamma_quantile, gamma_shape


@dataclass(frozen=True)
class GammaFit:
    scale: float
    shape: float
    n: int


def sample_depth(long: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Reads per (run, sample), optionally with further keys such as ``source``."""
    return long.groupBy("run", "sample", *extra).agg(F.sum("reads").alias("tot"))


def gamma_fit(depth: DataFrame) -> GammaFit:
    """Maximum-likelihood gamma distribution of all depths, runs pooled.

    Spark reduces the depths to their number, mean and mean logarithm; only these reach
    the driver.
    """
    n, mean, mean_log, gap = depth.agg(
        F.count("tot"),
        F.avg("tot"),
        F.avg(F.log(F.col("tot").cast("double"))),
        F.log(F.avg("tot")) - F.avg(F.log(F.col("tot").cast("double"))),
    ).first()
    if not n:
        return GammaFit(float("nan"), float("nan"), 0)
    shape = gamma_shape(gap)
    return GammaFit(mean / shape, shape, n)


def gamma_prob(depth: DataFrame, fit: GammaFit) -> DataFrame:
    """Lower-tail probability of every depth, for display."""
    return depth.withColumn("prob", gamma_probability(F.col("tot"), fit.shape, fit.scale))


def depth_outliers(
    depth: DataFrame, fit: GammaFit | None = None, prob: float = 0.05, min_reads: float = 10000
) -> DataFrame:
    """Samples below the ``prob`` quantile of the fit or below ``min_reads``.

    The distribution function grows with depth, so the quantile is solved once and the
    filter is a plain comparison. ``fit=None`` leaves the quantile out.
    """
    low = F.col("tot") < F.lit(min_reads)
    # a fit without spread puts every depth on the same point and marks none
    if fit is not None and fit.n and fit.shape < float("inf"):
        low = low | (F.col("tot") < F.lit(gamma_quantile(prob, fit.shape, fit.scale)))
    return depth.filter(low)


def drop_samples(long: DataFrame, bad: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Remove samples by name, from every run unless ``run`` is among the keys."""
    keys = list(keys)
    return attach(long, bad.select(*keys).distinct(), keys, "left_anti", by=["feature"])
