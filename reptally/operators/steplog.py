"""What each step leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: names of the stages and of the three numbers
STAGES = (
    "Step_0",
    "Step_1.Jump",
    "Step_2.Low.Read.Depth",
    "Step_3.microDecon",
    "Step_4.Occupancy",
    "Step_5.Dissimilarity",
)
STATS = ("nsamples", "nHashes", "nReads")


def stage_summary(long: DataFrame, stage: str) -> DataFrame:
    """Samples, features and reads per run, one row per number."""
    sizes = long.groupBy("run").agg(
        F.count_distinct("sample").alias(STATS[0]),
        F.count_distinct("feature").alias(STATS[1]),
        F.sum("reads").cast("bigint").alias(STATS[2]),
    )
    return sizes.unpivot("run", list(STATS), "stat", "number").withColumn("stage", F.lit(stage))


def stage_log(*summaries: DataFrame) -> DataFrame:
    out = summaries[0]
    for more in summaries[1:]:
        out = out.unionByName(more)
    return out
