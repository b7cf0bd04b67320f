"""Wide count tables and sample sheets, read and turned long."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reptally.functions.joins import attach, total_of
from reptally.functions.storage import cut

# fixed values: column names of the input format
FEATURE_HEADER = "seq_number"
TAXON_HEADER = "sum.taxonomy"
SHEET_HEADERS = {
    "Seq_number": "raw_name",
    "New_name": "sample",
    "Site": "site",
    "Bio_rep": "bio_rep",
    "Tech_rep": "tech_rep",
    "Sample_Control": "sample_control",
    "Control_Type": "control_type",
}
MISSING = "NA"

# bytes of different headers up to which they are broadcast, rather than lines shuffled
HEADER_BYTES = 32 << 20

# run name inside a feature id: <read type>_<run>_<number>
RUN_PATTERN = "^[a-z]+_(.*)_[0-9]+$"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _numbered(name: str, nth: int) -> str:
    return name if nth == 1 else f"{name}#{nth}"


def read_header(spark: SparkSession, path: str, sep: str = "\t") -> list[str]:
    """Column names of a text table; the n-th use of a name becomes ``name#n``."""
    line = spark.read.text(path).first()
    if line is None:
        raise ValueError(f"{path} is empty")
    seen: Counter[str] = Counter()
    names = []
    for raw in line[0].split(sep):
        name = raw.strip().strip('"')
        seen[name] += 1
        names.append(_numbered(name, seen[name]))
    return names


def read_wide(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Wide count table: ``feature``, one string column per raw sample name, ``taxon``."""
    ours = {FEATURE_HEADER: "feature", TAXON_HEADER: "taxon"}
    names = [ours.get(n, n) for n in read_header(spark, path, sep)]
    if "feature" not in names or "taxon" not in names:
        raise ValueError(f"{path} needs the columns {FEATURE_HEADER} and {TAXON_HEADER}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.csv(
        path, schema=schema, sep=sep, header=True, nullValue=MISSING, maxColumns=len(names) + 1
    )


def read_sheet(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Sample sheet; the n-th row of a raw name is keyed ``name#n``, as in :func:`read_header`."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in SHEET_HEADERS])
    rows = spark.read.csv(path, schema=schema, sep=sep, header=True, nullValue=MISSING)
    rows = rows.withColumnsRenamed(SHEET_HEADERS).withColumn(
        "_at", F.struct(F.input_file_name(), F.monotonically_increasing_id())
    )
    nth = F.row_number().over(Window.partitionBy("raw_name").orderBy("_at"))
    return rows.withColumn("_nth", nth).select(
        F.when(F.col("_nth") == 1, F.col("raw_name"))
        .otherwise(F.concat_ws("#", "raw_name", F.col("_nth").cast("string")))
        .alias("raw_name"),
        *[c for c in SHEET_HEADERS.values() if c != "raw_name"],
    )


def sheet_dedupe(sheet: DataFrame) -> DataFrame:
    """One row per sample, so that joins on the sample never multiply rows."""
    return sheet.drop("raw_name").distinct()


def to_long(wide: DataFrame, ids: Sequence[str] = ("feature", "taxon")) -> DataFrame:
    """Every other column becomes a row (ids, sample, reads); missing counts are 0."""
    ids = list(ids)
    values = [c for c in wide.columns if c not in ids]
    # one array expression stays small to plan for thousands of columns, where an unpivot
    # needs one projection for each
    cells = F.expr("array(" + ", ".join(quoted(c) for c in values) + ")")
    names = F.split(F.lit("\t".join(values)), "\t")
    return wide.select(*ids, F.posexplode(cells).alias("_at", "_cell")).select(
        *ids,
        F.element_at(names, F.col("_at") + 1).alias("sample"),
        F.coalesce(F.col("_cell").try_cast("bigint"), F.lit(0)).alias("reads"),
    )


def read_long(spark: SparkSession, paths: Sequence[str], sep: str = "\t", zeros: bool = False) -> DataFrame:
    """Rows (feature, taxon, sample, reads) of any number of wide text tables, each with columns of
    its own, in one scan and one plan.

    A path may be a folder of parts that each begin with the header. Headers are found by their
    two fixed names, whatever the order of lines; a table without one is an error when it is
    read. A line is split once, and cells without a count go as they are split, unless
    ``zeros`` asks for them. Column names reach the lines by file, each different header once, so
    that no list of columns is on the driver or in the plan. Repeated names are numbered as in
    :func:`read_header`.
    """
    at_sep = "\\" + sep if sep in r".$|()[{^?*+\\" else sep
    cells = F.split("value", F.lit(at_sep), -1)
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file")).filter("trim(value) <> ''")
    bare = lambda x: F.trim(F.trim(x), F.lit('"'))
    is_header = F.col("value").contains(FEATURE_HEADER) & F.col("value").contains(TAXON_HEADER)
    named = lines.filter(is_header).select("file", F.transform(cells, bare).alias("names"))
    named = named.filter(F.array_contains("names", FEATURE_HEADER) & F.array_contains("names", TAXON_HEADER)).groupBy("file").agg(F.min("names").alias("names"))
    files = cut(
        named.select(
            "file",
            F.min(F.xxhash64("file")).over(Window.partitionBy("names")).alias("hid"),
            (F.array_position("names", FEATURE_HEADER) - 1).cast("int").alias("f_at"),
            (F.array_position("names", TAXON_HEADER) - 1).cast("int").alias("t_at"),
            "names",
        ),
        "headers",
    )
    # files with the same header share it
    columns = files.groupBy("hid").agg(F.first("names").alias("names")).select("hid", F.posexplode("names").alias("at", "name"))
    nth = F.row_number().over(Window.partitionBy("hid", "name").orderBy("at"))
    columns = columns.withColumn("_nth", nth).select("hid", "at", F.when(F.col("_nth") == 1, F.col("name")).otherwise(F.concat_ws("#", "name", F.col("_nth").cast("string"))).alias("sample"))
    headers = columns.groupBy("hid").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "sample"))), lambda x: x["sample"]).alias("names"))

    # as many rows as files; the join with every line is by broadcast where that is small
    known = attach(lines, files.drop("names"), ["file"], by=["value"])
    lack = F.raise_error(F.concat(F.col("file"), F.lit(f" needs the columns {FEATURE_HEADER} and {TAXON_HEADER}")))
    # on the key, which the last join needs and so no filter passes by
    hid = F.when(F.col("hid").isNull(), lack.cast("bigint")).otherwise(F.col("hid"))
    split = known.select(hid.alias("hid"), "f_at", "t_at", cells.alias("cells"))
    text = lambda at: F.nullif(bare(F.get("cells", F.col(at))), F.lit(MISSING))
    read = split.select("hid", "f_at", "t_at", text("f_at").alias("feature"), text("t_at").alias("taxon"), "cells")
    read = read.filter(F.coalesce(F.col("feature") != FEATURE_HEADER, F.lit(True)))
    rows = attach(read, headers, ["hid"], "inner", by=["feature"], limit=HEADER_BYTES)
    # places come with cells, so that a cell is looked at once, as it is split, and not in an array of them
    rows = rows.select("feature", "taxon", "names", "f_at", "t_at", F.posexplode("cells").alias("at", "cell"))
    # null-safe, as lines of a table without header would else go unseen
    rows = rows.filter(~F.col("at").eqNullSafe(F.col("f_at")) & ~F.col("at").eqNullSafe(F.col("t_at")) & (F.lit(True) if zeros else F.col("cell") != "0"))
    # a cell beyond the header has no name
    rows = rows.filter(F.col("at") < F.size("names"))
    reads = F.coalesce(bare("cell").try_cast("bigint"), F.lit(0))
    rows = rows.select("feature", "taxon", F.element_at("names", F.col("at") + 1).alias("sample"), reads.alias("reads"))
    return rows if zeros else rows.filter("reads <> 0")


def run_label(long: DataFrame, pattern: str = RUN_PATTERN) -> DataFrame:
    """Name of the run, taken from each feature id."""
    return long.withColumn("run", F.regexp_extract("feature", pattern, 1))


def rename_samples(long: DataFrame, sheet: DataFrame) -> DataFrame:
    """Raw sample names become sheet names; a name missing from the sheet stays."""
    names = sheet.select("raw_name", F.col("sample").alias("_new"))
    named = attach(long.withColumnRenamed("sample", "raw_name"), names, ["raw_name"], by=["feature"])
    return named.withColumn("sample", F.coalesce("_new", "raw_name")).select(*long.columns)


def union_runs(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack runs; columns missing in one are filled, counts with 0."""
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=True)
    numeric = [f.name for f in out.schema.fields if isinstance(f.dataType, T.NumericType)]
    return out.fillna(0, numeric) if numeric else out


def taxon_key(*tables: DataFrame) -> DataFrame:
    """(feature, taxon) of one or more tables."""
    out = tables[0].select("feature", "taxon")
    for table in tables[1:]:
        out = out.unionByName(table.select("feature", "taxon"))
    return out.distinct()


def name_taxa(long: DataFrame) -> DataFrame:
    """A missing taxon becomes the label that stands for it in text tables."""
    return long.withColumn("taxon", F.coalesce("taxon", F.lit(MISSING)))


def taxon_dim(key: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(taxon, taxon_id, first_feature) with ids ``taxon_1`` .. ``taxon_n``.

    Numbers follow the MD5 order of the taxa, a missing taxon first: hash prefixes cut the taxa
    into even slices that are numbered side by side, and only the slice sizes (at most 4,097
    rows) go through one window. Taxa of ``known``, the table of an earlier load, keep their ids
    and first features; new ones are numbered after the largest, in their own MD5 order.
    """
    taxa = key.groupBy("taxon").agg(F.min("feature").alias("first_feature"))
    last = F.lit(0)
    if known is not None:
        same = {"_none": F.col("taxon").isNull(), "_name": F.coalesce("taxon", F.lit(""))}
        old = known.select(*[x.alias(n) for n, x in same.items()])
        taxa = attach(taxa.withColumns(same), old, list(same), "left_anti", by=["first_feature"]).drop(*same)
        last = total_of(known, F.coalesce(F.max(F.substring_index("taxon_id", "_", -1).cast("bigint")), F.lit(0)))
    taxa = taxa.withColumn("_hash", F.coalesce(F.md5("taxon"), F.lit(""))).withColumn("_slice", F.substring("_hash", 1, 3))
    sizes = taxa.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy("_hash", "taxon"))
    new = (
        taxa.withColumn("_at", inside)
        .join(F.broadcast(starts), "_slice")
        .select(
            "taxon",
            F.concat(F.lit("taxon_"), (last + F.col("_start") + F.col("_at")).cast("string")).alias("taxon_id"),
            "first_feature",
        )
    )
    return new if known is None else known.select("taxon", "taxon_id", "first_feature").unionByName(new)
