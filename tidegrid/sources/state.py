"""Readers of the five state tables and of the dataset configuration."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.schemas import DOCUMENT_FIELDS, TABLES
from tidegrid.session import shared_dir
from tidegrid.sizing import materialize, shuffle_width


def scan(df: DataFrame, where: Iterable[Column] = (), columns: Iterable[str] | None = None,
         limit: int | None = None) -> DataFrame:
    """Conjunction of predicates, optional projection, optional row limit; all reach the scan."""
    for predicate in where:
        df = df.filter(predicate)
    if columns is not None:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def numbered(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """All rows in order with their ``position`` from 1: a full ordered scan whose order can be checked.

    Rows are dealt by ranges of the order and counted per range; only the counts, one per range, meet in
    one task. Rows with equal order keys stand together in no stated order.
    """
    order = list(order)
    dealt = df.repartitionByRange(shuffle_width(df), *order).sortWithinPartitions(*order).withColumns({
        "__range": F.spark_partition_id(), "__place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    dealt = materialize(dealt, shared_dir(df.sparkSession, "ordered"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).select(
        "__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    rows = dealt.join(F.broadcast(starts), "__range")  # one row per task of the shuffle
    return rows.select((F.col("__start") + F.col("__place") + 1).alias("position"), *df.columns)


def read_state(spark: SparkSession, path: str, table: str, **kwargs) -> DataFrame:
    """A state table's current rows with its declared schema."""
    return scan(spark.read.schema(TABLES[table]).parquet(path), **kwargs)


def count(df: DataFrame, where: Iterable[Column] = ()) -> DataFrame:
    """Matching rows as a one-row frame; nothing but the counter leaves the executors."""
    return scan(df, where).agg(F.count(F.lit(1)).alias("n"))


def between_half_open(col: Column | str, low: str, high: str) -> Column:
    """``[low, high)`` on instants."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= F.lit(low).cast("timestamp")) & (c < F.lit(high).cast("timestamp"))


def with_defaults(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Project onto ``schema``: absent columns get a default, present ones are coerced tolerantly.

    Text that does not parse as a time, number or boolean becomes NULL instead of failing the job.
    """
    defaults = dict(defaults or {})
    out = []
    for f in schema.fields:
        default = F.lit(defaults.get(f.name)).cast(f.dataType)
        if f.name not in df.columns:
            out.append(default.alias(f.name))
            continue
        col = F.col(f.name).try_cast(f.dataType)
        out.append((F.coalesce(col, default) if f.name in defaults else col).alias(f.name))
    return df.select(*out)


def from_documents(docs: DataFrame, table: str) -> DataFrame:
    """Typed table from exported state documents (one row per document, ``type_s`` tells the kind)."""
    names = dict(DOCUMENT_FIELDS[table])
    if table == "dataset":
        # the variable group's document name carries a prefix that differs between installations
        names.update({"variable": c for c in docs.columns if c.endswith("_variable_s")})
    rows = docs.filter(F.col("type_s") == table)
    present = {doc: col for col, doc in names.items() if doc in docs.columns}
    picked = rows.select(*[F.col(doc).alias(col) for doc, col in present.items()])
    if table == "transformation" and "source_path" in picked.columns:
        picked = picked.withColumn("filename", F.substring_index("source_path", "/", -1))
    return with_defaults(picked, TABLES[table])


def detail(df: DataFrame, ds: str, columns: Iterable[str], order: str) -> DataFrame:
    """One dataset's rows for display, sorted; missing order keys come last."""
    return scan(df, [F.col("ds") == ds], columns).orderBy(F.col(order).asc_nulls_last())


def active_names(config: DataFrame) -> DataFrame:
    """Datasets that are not deprecated."""
    return config.filter("active").select("ds")


def field_rows(config: DataFrame) -> DataFrame:
    """One row per dataset and field."""
    return config.select("ds", F.posexplode("fields").alias("position", "f")).select(
        "ds", "position", F.col("f.name").alias("field"),
        *[F.col(f"f.{c}").alias(c) for c in (
            "long_name", "standard_name", "units", "pre_transformations", "post_transformations")],
    )
