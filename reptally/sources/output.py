"""Wide results and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.functions.storage import cut
from reptally.sources.wide import quoted

# columns whose cells one row is laid out for at a time, and cells that a task lays out
NAMES_PER_BLOCK = 4096
CELLS_PER_TASK = 1 << 21
CELLS_PER_FILE = 1 << 23


class TooWide(ValueError):
    """More columns than a wide table may have; the long table is the result."""


def wide_columns(names: DataFrame, limit: int | None = None) -> list[str]:
    """Sorted column names of a wide table: never more than ``limit`` reach the driver."""
    if limit is None:
        limit = int(names.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = names.select(names.columns[0]).dropna().distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise TooWide(f"more than {limit} columns; write the long table")
    return sorted(r[0] for r in rows)


def to_wide(
    long: DataFrame,
    index: Sequence[str],
    column: str,
    value: str,
    names: DataFrame | None = None,
    cells: bool = False,
) -> DataFrame:
    """One column per value of ``column``, summed, with 0 where nothing was counted.

    ``names`` adds columns (those of the sample sheet, say) for samples without reads. More
    columns than a pivot may have are an error. With ``cells`` the same table comes as a row
    (index, column, value) per cell and may have any number of columns.
    """
    if cells:
        return _cells(long, list(index), column, value, names)
    found = long.select(column)
    columns = wide_columns(found if names is None else found.union(names.select(names.columns[0])))
    wide = long.groupBy(*index).pivot(column, columns).agg(F.sum(value))
    kind = wide.dtypes[-1][1]
    cells = [f"coalesce({quoted(c)}, cast(0 as {kind})) as {quoted(c)}" for c in columns]
    return wide.selectExpr(*[quoted(c) for c in index], *cells)


def _placed(long: DataFrame, index: list[str], column: str, value: str, names: DataFrame | None, per_block: int | None) -> tuple[DataFrame, DataFrame, int]:
    """The counted cells of a wide table (index, ``_name``, ``_v``, ``_block`` and place ``_at`` of the
    column, from 1 on); its columns (``_block``, sorted ``_names``); and the number of columns.
    Without ``per_block`` all columns are one block."""
    listed = long.select(F.col(column).cast("string").alias("_name"))
    if names is not None:
        listed = listed.union(names.select(F.col(names.columns[0]).cast("string")))
    listed = cut(listed.dropna().distinct(), "wide-names")
    n = listed.count()
    blocks = -(-n // per_block) if per_block and n else 1
    at = F.row_number().over(Window.partitionBy("_block").orderBy("_name"))
    placed = listed.withColumn("_block", F.pmod(F.xxhash64("_name"), F.lit(blocks)).cast("int")).withColumn("_at", at)
    placed = cut(placed, "wide-columns")
    heads = placed.groupBy("_block").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_name"))), lambda x: x["_name"]).alias("_names"))
    sums = long.groupBy(*index, F.col(column).cast("string").alias("_name")).agg(F.sum(value).alias("_v"))
    # a row without any name stays a row, of zeros
    return cut(attach(sums, placed, ["_name"], by=index), "wide-cells"), heads, n


def _cells(long: DataFrame, index: list[str], column: str, value: str, names: DataFrame | None) -> DataFrame:
    """Every cell of a wide table as a row (index, column, value): those that are counted, and the
    columns between them. No column is one of the plan, and a task makes about CELLS_PER_TASK cells.
    """
    sums, heads, n = _placed(long, index, column, value, names, NAMES_PER_BLOCK)
    zero = F.lit(0).cast(sums.schema["_v"].dataType)
    counted = sums.filter("_name is not null").select(*index, F.col("_name").alias(column), F.coalesce("_v", zero).alias(value))
    own = F.collect_list(F.when(F.col("_name").isNotNull(), F.struct("_block", "_at")))
    rows = cut(sums.groupBy(*index).agg(own.alias("_own")), "wide-rows")
    dealt = rows.repartition(max(1, -(-rows.count() * n // CELLS_PER_TASK)))
    here = F.filter("_own", lambda x: x["_block"] == F.col("_block"))
    both = dealt.crossJoin(F.broadcast(heads)).select(*index, "_names", F.array_sort(F.transform(here, lambda x: x["_at"])).alias("_own"))

    def gap(at, i):
        """The columns between a counted one, or the start, and the next."""
        return F.struct((at + 1).alias("_from"), (F.coalesce(F.get("_own", i), F.size("_names") + 1) - at - 1).alias("_n"))

    gaps = F.filter(F.transform(F.concat(F.array(F.lit(0)), "_own"), gap), lambda x: x["_n"] > 0)
    empty = both.select(*index, "_names", F.explode(gaps).alias("_gap")).select(*index, "_names", "_gap._from", "_gap._n")
    # no gap is empty; outer, as the plan else makes each slice twice to see that
    empty = empty.select(*index, F.explode_outer(F.slice("_names", F.col("_from"), F.col("_n"))).alias(column))
    return counted.unionByName(empty.withColumn(value, zero))


def write_wide(long: DataFrame, index: Sequence[str], column: str, value: str, path: str, headers: Sequence[str], sep: str = "\t") -> str:
    """The wide table as a folder of compressed text files that each begin with the header.

    ``headers`` name the index columns. A line is put together from its counted cells and the runs
    of zeros between them, so that the table may have any number of columns.
    """
    index = list(index)
    sums, heads, n = _placed(long, index, column, value, None, None)
    own = F.collect_list(F.when(F.col("_name").isNotNull(), F.struct("_at", "_v")))
    rows = cut(sums.groupBy(*index).agg(F.array_sort(own).alias("_own")), "wide-rows")
    zero = F.lit(f"{sep}0")

    def piece(x, i):
        before = F.coalesce(F.get("_own", i - 1)["_at"], F.lit(0))
        return F.concat(F.repeat(zero, x["_at"] - before - 1), F.lit(sep), F.coalesce(x["_v"].cast("string"), F.lit("0")))

    last = F.coalesce(F.get("_own", F.size("_own") - 1)["_at"], F.lit(0))
    line = F.concat(F.to_csv(F.struct(*index), {"sep": sep}), F.array_join(F.transform("_own", piece), ""), F.repeat(zero, F.lit(n) - last))
    files = max(1, -(-rows.count() * n // CELLS_PER_FILE))
    lines = rows.select(F.pmod(F.xxhash64(*index), F.lit(files)).alias("_file"), line.alias("value"))
    # a table without columns has no row of names
    names = F.concat_ws(sep, *[F.lit(h) for h in headers], F.coalesce("_names", F.array()))
    spark = long.sparkSession
    head = spark.range(files).withColumnRenamed("id", "_file").join(F.broadcast(heads), F.lit(True), "left").select("_file", names.alias("value"))
    # whatever numbers meet in a file, each brings its header
    head.unionByName(lines).repartition(files, "_file").select("value").write.option("compression", "gzip").text(path)
    return path


def write_csv(df: DataFrame, path: str, order: Sequence = ()) -> str:
    """CSV with a header, sorted by ``order`` if given."""
    out = df.orderBy(*order) if order else df
    out.write.mode("errorifexists").option("header", True).csv(path)
    return path


def write_table(df: DataFrame, path: str, by: Sequence[str] = ("run",)) -> DataFrame:
    """Parquet, one folder per run, read back."""
    by = [c for c in by if c in df.columns]
    if not by:
        return cut(df, path=path)
    df.write.mode("errorifexists").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
