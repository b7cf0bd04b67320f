"""Step 1: reads that jumped between samples, judged by the positive controls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reptally.functions.bins import bin_width, centred_bin
from reptally.functions.joins import attach, key_weights


def sample_totals(long: DataFrame) -> DataFrame:
    """Reads and rows per (run, sample)."""
    return long.groupBy("run", "sample").agg(
        F.sum("reads").alias("total"), F.count(F.lit(1)).alias("n_rows")
    )


def with_totals(long: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Rows with the ``total`` of their (run, sample)."""
    keys = ["run", "sample"]
    totals = sample_totals(long) if totals is None else totals
    return attach(long, totals, keys, by=["feature"], counted="n_rows")


def contam_vector(positives: DataFrame) -> DataFrame:
    """Per run and feature, its largest share of a positive control's reads."""
    return (
        with_totals(positives)
        .groupBy("run", "feature")
        .agg(F.max(F.col("reads") / F.col("total")).alias("v"))
    )


def subtract_proportional(
    samples: DataFrame, vector: DataFrame, totals: DataFrame | None = None
) -> DataFrame:
    """Take ``ceil(v * sample total)`` off every feature in the vector; keep what is left."""
    keys = ["run", "feature"]
    # the first join keeps every row once, so keys are weighed on the rows before it
    rows = attach(with_totals(samples, totals), vector, keys, by=["sample"], weights=key_weights(samples, keys))
    jumped = F.ceil(F.col("v") * F.col("total"))
    return (
        rows.withColumn("reads", F.col("reads") - F.coalesce(jumped, F.lit(0)))
        .filter(F.col("reads") > 0)
        .select(*samples.columns)
    )


def contam_hist(vector: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of the vector per run, with equal bins centred on its smallest and largest value."""
    ends = vector.groupBy("run").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n_rows")
    )
    spans = ends.select("run", "low", bin_width(F.col("low"), F.col("high"), bins).alias("width"), "n_rows")
    placed = attach(vector, spans, ["run"], by=["feature"], counted="n_rows")
    return (
        placed.withColumn("bin", centred_bin(F.col("v"), F.col("low"), F.col("width")))
        .groupBy("run", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
