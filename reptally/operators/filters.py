"""Read-type filters, control labels and simple checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reptally.functions.joins import attach, total_of

# fixed values: names of the sources and of the control types in the sheet
SAMPLES = "Samples"
POSITIVES = "Positives"
BLANKS = "Blanks"
CONTROL_MARK = "Control"
POSITIVE_MARK = "Pos"
BLANK_MARK = "Blank"

# label of a missing place in the hierarchy
MISSING = "NA"
HIERARCHY = ("site", "bio_rep", "tech_rep")

# fixed values: read types, as they appear in feature ids
MERGED = "merged"
UNMERGED = "unmerged"
REVERSE = "reverse"

# fixed values: options of the read-type filter
READ_TYPES = ("merged_only", "merged_and_forward", "all")


def keep_merged(long: DataFrame) -> DataFrame:
    feature = F.col("feature")
    return long.filter(feature.contains(MERGED) & ~feature.contains(UNMERGED))


def keep_merged_forward(long: DataFrame) -> DataFrame:
    feature = F.col("feature")
    return long.filter(~feature.contains(REVERSE) & ~feature.contains(UNMERGED))


def drop_singletons(long: DataFrame, min_total: int = 1) -> DataFrame:
    """Keep features with more than ``min_total`` reads over all samples."""
    totals = long.groupBy("feature").agg(
        F.sum("reads").alias("_total"), F.count(F.lit(1)).alias("n_rows")
    )
    kept = totals.filter(F.col("_total") > min_total).drop("_total")
    return attach(long, kept, ["feature"], "left_semi", by=["sample"], counted="n_rows")


def keep_read_type(long: DataFrame, read_type: str) -> DataFrame:
    if read_type not in READ_TYPES:
        raise ValueError(f"read type must be one of {READ_TYPES}")
    if read_type == "merged_only":
        return keep_merged(long)
    if read_type == "merged_and_forward":
        return keep_merged_forward(long)
    return drop_singletons(long)


def retention_pct(before: DataFrame, after: DataFrame) -> DataFrame:
    """Share of features kept, in percent with 2 digits.

    In a full (features x samples) table the share of rows is the same number, since
    every feature has one row per sample.
    """
    kinds = F.count_distinct("run", "feature")
    sizes = before.agg(kinds.alias("features_before")).withColumn("features_after", total_of(after, kinds))
    return sizes.withColumn(
        "pct", F.round(F.try_divide(F.col("features_after") * 100.0, F.col("features_before")), 2)
    )


def control_lists(sheet: DataFrame) -> dict[str, DataFrame]:
    """Samples that are controls, positives and blanks."""
    control = F.col("control_type")
    return {
        "controls": sheet.filter(F.col("sample_control") == CONTROL_MARK).select("sample").distinct(),
        "positives": sheet.filter(control == POSITIVE_MARK).select("sample").distinct(),
        "blanks": sheet.filter(control == BLANK_MARK).select("sample").distinct(),
    }


def attach_sheet(
    long: DataFrame, sheet: DataFrame, columns: Sequence[str] = HIERARCHY
) -> DataFrame:
    """Long rows with columns of the sheet, by default the place in the replicate hierarchy.

    A missing site or replicate becomes the label ``NA``, so that such rows form groups
    of their own.
    """
    dim = sheet.select("sample", *columns).distinct()
    rows = attach(long, dim, ["sample"], by=["feature"]).select(*long.columns, *columns)
    return rows.fillna(MISSING, [c for c in columns if c in HIERARCHY])


def label_source(long: DataFrame, sheet: DataFrame | None = None) -> DataFrame:
    """Tag rows as coming from samples, positive controls or blanks.

    With ``control_type`` already on the rows no join is made.
    """
    known = "control_type" in long.columns
    rows = long if known else attach_sheet(long, sheet, ["control_type"])
    source = (
        F.when(F.col("control_type") == POSITIVE_MARK, POSITIVES)
        .when(F.col("control_type") == BLANK_MARK, BLANKS)
        .otherwise(SAMPLES)
    )
    rows = rows.withColumn("source", source)
    return rows if known else rows.drop("control_type")


def drop_zero(long: DataFrame) -> DataFrame:
    return long.filter(F.col("reads") > 0)


def control_features(labelled: DataFrame, source: str) -> DataFrame:
    """Features seen in one kind of control, with their reads over all such controls."""
    return (
        labelled.filter(F.col("source") == source)
        .groupBy("feature", "taxon")
        .agg(F.sum("reads").alias("tot"))
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Missing and present values of every column, in one pass."""
    columns = df.columns
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in columns}
    flat = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(quoted[c]).alias(f"p{i}") for i, c in enumerate(columns)],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col("rows") - F.col(f"p{i}")).alias("missing"),
            F.col(f"p{i}").alias("present"),
        )
        for i, c in enumerate(columns)
    ]
    return flat.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
