"""Which transformations and granules went into a product, as JSON lines.

One line for the product and one per transformation, so a product with many members is streamed
and never gathered into one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.text import provenance_name, stable_id
from tidegrid.operators.planning import AGG_KEY, _true
from tidegrid.session import shared_dir
from tidegrid.sizing import bounded_broadcast, materialize, spread_join


def members(tx: DataFrame, granules: DataFrame) -> DataFrame:
    """Successful transformations of each (ds, grid, field, year) with their granule row nested."""
    rest = [c for c in granules.columns if c not in ("ds", "path")]
    g = granules.select("ds", F.col("path").alias("source_path"), F.struct("path", *rest).alias("granule"))
    return (
        tx.filter(_true("success")).withColumn("year", F.year("date").cast("int"))
        .join(g, ["ds", "source_path"], "left")
    )


def provenance_lines(member_rows: DataFrame, agg: DataFrame, datasets: DataFrame) -> DataFrame:
    """(key, line_no, kind, json): line 0 describes the product, the others one member each."""
    info = datasets.select("ds", F.struct(*datasets.columns).alias("dataset"))
    head = agg.join(bounded_broadcast(info), "ds", "left").select(
        *AGG_KEY, F.lit(0).alias("line_no"), F.lit("product").alias("kind"),
        F.to_json(F.struct("dataset", F.struct(*agg.columns).alias("aggregation"))).alias("json"),
    )
    body = member_rows.select(
        *AGG_KEY, F.lit(1).alias("line_no"), F.lit("transformation").alias("kind"),
        F.to_json(F.struct(*[c for c in member_rows.columns if c not in AGG_KEY])).alias("json"),
    )
    return head.unionByName(body)


def member_counts(lines: DataFrame) -> DataFrame:
    """Members per product."""
    return lines.groupBy(*AGG_KEY).agg(
        F.count_if(F.col("kind") == "product").alias("products"),
        F.count_if(F.col("kind") == "transformation").alias("transformations"))


def write_provenance(lines: DataFrame, path: str, stored: DataFrame | None = None) -> None:
    """Write the lines of products that have none yet, one folder per product; text files are gzipped, as lines repeat themselves."""
    new = lines
    if stored is not None:  # a row per product, stored for its size: lines meet it where they are
        known = materialize(stored.select(*AGG_KEY).distinct(), shared_dir(lines.sparkSession, "known-products"))
        new = spread_join(lines, known, list(AGG_KEY), salt_from=["json"], how="left_anti")
    named = new.withColumn("name", provenance_name("ds", "field", "grid", "year"))
    (
        named.hint("rebalance", "name").sortWithinPartitions("name", "line_no")
        .select(*AGG_KEY, F.col("json").alias("value"))
        .write.mode("append").partitionBy(*AGG_KEY).option("compression", "gzip").text(path)
    )


LINEAGE = "product string, grid string, field string, line_no int, kind string, json string, ds string, year int"


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    """Lines of every version of every product; empty before the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LINEAGE)
    return spark.read.schema(LINEAGE).parquet(path)


def write_lineage(lines: DataFrame, agg: DataFrame, path: str) -> None:
    """Append the lines of product versions that have none yet, in folders of one dataset and year.

    A version is known by a hash of its key, aggregation version and time, so a second run over the
    same state writes nothing, and files grow with new versions, not with the number of products.
    """
    version = stable_id(*AGG_KEY, "version", "agg_time").alias("product")
    versions = agg.select(*AGG_KEY, version)
    years = read_lineage(agg.sparkSession, path).join(bounded_broadcast(agg.select("ds", "year").distinct()), ["ds", "year"], "left_semi")
    new = versions.join(years.select("product").distinct(), "product", "left_anti")
    rows = materialize(spread_join(lines, new, list(AGG_KEY), salt_from=["json"]).select(*[c.split()[0] for c in LINEAGE.split(", ")]), shared_dir(agg.sparkSession, "lineage"))
    if not rows.isEmpty():
        rows.hint("rebalance", "ds", "year").sortWithinPartitions("ds", "year", "product", "line_no").write.mode("append").partitionBy("ds", "year").parquet(path)
