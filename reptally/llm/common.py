"""Steps that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reptally.functions.joins import attach
from reptally.functions.storage import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the shared folder and read back, so that no later step
    computes it again, whichever executors are lost."""
    path = new_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that :func:`stored` wrote, once all that read them are written themselves.

    Shuffle files of finished jobs go when the driver collects what named them, which is asked
    for here, since a driver with little to do may not do so for long.
    """
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
    SparkSession.active().sparkContext._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_key(text: Column) -> Column:
    """64-bit hash of a text; with the row's id it names a row. Null and empty texts differ."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def same_row(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Join condition on columns that both sides have; nulls are equal."""
    cond = F.lit(True)
    for n in names:
        cond = cond & a[n].eqNullSafe(b[n])
    return cond


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; longs); a root names a component.

    Every round hooks each node to the neighbour with the smallest salted hash, if that is
    smaller than its own, and rewrites the edges with the new names. Chains shrink by a
    constant factor a round, stars vanish in one. Rounds are written tables; the driver only
    learns whether edges are left. Hub nodes are spread over tasks by ``attach``.
    """
    edges = stored(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    result = ends.withColumn("root", F.col("node"))
    salt = 0
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(salt)).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        hooks = stored(
            both.groupBy("u").agg(F.min(order("v")).alias("least")).select("u", F.least("least", order("u"))["v"].alias("p")), "hooks"
        )
        for end in ("a", "b"):
            edges = attach(edges, hooks.withColumnsRenamed({"u": end, "p": f"new_{end}"}), [end], "inner")
        edges = stored(
            edges.filter("new_a <> new_b").select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(),
            "edges",
        )
        result = attach(result, hooks.withColumnsRenamed({"u": "root"}), ["root"], "left").select("node", F.coalesce("p", "root").alias("root"))
        result = stored(result, "roots")
        salt += 1
    return result
