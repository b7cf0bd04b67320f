"""The star-schema tables seen as a count table and a sample sheet.

Suppliers are samples, parts are features, line status is the run and quantities are
reads. Suppliers come in batches of 100; a site is a region within a batch, so that more
suppliers make more sites and not larger replicate groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reptally.functions.joins import attach

BATCH = 100


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def counts(spark: SparkSession, folder: str) -> DataFrame:
    """(run, sample, feature, taxon, reads) with all read types."""
    kind = F.when(F.col("l_returnflag").isin("A", "N"), 3).otherwise(F.col("l_linenumber") % 3)
    read_type = F.when(F.col("kind") == 0, "forward").when(F.col("kind") == 1, "reverse").when(
        F.col("kind") == 2, "unmerged"
    ).otherwise("merged")
    cells = (
        table(spark, folder, "lineitem")
        .select("l_linestatus", "l_suppkey", "l_partkey", kind.alias("kind"), "l_quantity")
        .groupBy("l_linestatus", "l_suppkey", "l_partkey", "kind")
        .agg(F.sum("l_quantity").cast("bigint").alias("reads"))
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.concat_ws(";", "p_brand", "p_type").alias("taxon")
    )
    return attach(cells, parts, ["l_partkey"], "inner", by=["l_suppkey"]).select(
        F.col("l_linestatus").alias("run"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("sample"),
        F.concat_ws("_", read_type, "l_linestatus", F.col("l_partkey").cast("string")).alias("feature"),
        "taxon",
        "reads",
    )


def sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Sample sheet: every fifth supplier is a control, in turn positive and blank."""
    key = F.col("s_suppkey")
    control = F.when(key % 10 == 0, "Pos").when(key % 10 == 5, "Blank")
    rows = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("lib."), key.cast("string"), F.lit(".S1")).alias("raw_name"),
            F.concat(F.lit("s"), key.cast("string")).alias("sample"),
            F.concat_ws("_", "r_name", F.floor(key / BATCH).cast("string")).alias("site"),
            F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (key % 3 + 1).cast("int")).alias("bio_rep"),
            control.alias("control_type"),
            F.when(control.isNull(), "Sample").otherwise("Control").alias("sample_control"),
            key.alias("_key"),
        )
    )
    nth = Window.partitionBy("site", "bio_rep", "sample_control").orderBy("_key")
    return rows.select(
        "raw_name",
        "sample",
        "site",
        "bio_rep",
        F.row_number().over(nth).cast("string").alias("tech_rep"),
        "sample_control",
        "control_type",
    )
