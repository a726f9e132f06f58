"""Query registration and access to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.session import configure, shared_dir
from tidegrid.sizing import plan_bytes

# Stored bytes of a table that one task of ``Views.spread`` takes; rows in memory are about ten times as large.
SPREAD_BYTES = 16 * 1024 * 1024

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
_STORED_MAPPINGS: dict[tuple[str, str], str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Views`` under ``name``, with the SQL it must agree with."""

    def add(fn: Callable[["Views"], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Views(configure(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def all_queries():
    return dict(_QUERIES)


def all_sql():
    return dict(_SQL)


def ts_text(col) -> Column:
    """Instant as text, the form both engines agree on."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


class Views:
    """The test tables, and the cell, granule and state views derived from them.

    The views use integer arithmetic only, so that both engines derive the same rows. They stand in
    for cells, granules and state and carry no physical meaning.
    """

    # Fixed value: metres the nearest-source search reaches in the derived grid.
    MAX_SPACING_M = 560_000.0

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def spread(self, df: DataFrame, key: str) -> DataFrame:
        """Spread a single-row-group table over all cores; a stated number keeps it from being merged back.

        The number grows with the table, so that what a task sorts does not.
        """
        size = plan_bytes(df) or 0
        return df.repartition(max(self.spark.sparkContext.defaultParallelism, -(-size // SPREAD_BYTES)), key)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))

    @cached_property
    def value_events(self) -> DataFrame:
        """Events with the missing-value rule applied."""
        return self.events.withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))

    @cached_property
    def obs(self) -> DataFrame:
        """Observation cells for regridding; the record key is ``field``."""
        n = self.table("part").select(F.count(F.lit(1))).scalar()
        return self.value_events.select(
            "event_id", (F.col("event_id") % n).alias("src_id"), F.col("event_type").alias("field"), "value")

    @cached_property
    def rec(self) -> DataFrame:
        """Regridded records for temporal operators, one per (field, date, hemi, cell)."""
        e = self.value_events.select(
            F.col("event_type").alias("field"), F.col("ts").cast("date").alias("date"),
            F.when(F.col("event_id") % 2 == 0, "nh").otherwise("sh").alias("hemi"),
            F.col("user_id").alias("cell_id"), "value", "event_id")
        return e.groupBy("field", "date", "hemi", "cell_id").agg(F.max_by("value", "event_id").alias("value"))

    @cached_property
    def series(self) -> DataFrame:
        """One value per (field, date, cell): hemispheres merged."""
        from tidegrid.operators.temporal import hemi_merge, hemi_priority

        return hemi_merge(self.rec, ["field", "date"], [hemi_priority()])

    @cached_property
    def src(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.table("part").select(
            k.alias("src_id"), ((k * 37) % 360 - 180 + F.lit(0.5)).cast("double").alias("lon"),
            ((k * 17) % 160 - 80 + F.lit(0.5)).cast("double").alias("lat"))

    @cached_property
    def tgt(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.table("supplier").select(
            k.alias("cell_id"), ((k * 29) % 360 - 180).cast("double").alias("lon"),
            ((k * 13) % 160 - 80).cast("double").alias("lat"),
            (F.lit(200000) + (k % 5) * 100000).cast("double").alias("radius_m"))

    @cached_property
    def mapping(self) -> DataFrame:
        """The stored mapping as pairs."""
        return self.packs.pairs()

    @cached_property
    def packs(self):
        """The stored mapping, built by the first query that needs it and reused, as jobs do."""
        from tidegrid.operators.mapping import ensure_packs

        run = (self.spark.sparkContext.applicationId, self.dir)
        if run not in _STORED_MAPPINGS:
            _STORED_MAPPINGS[run] = shared_dir(self.spark, "mapping")
        key = ("tables", "suppliers", "", 1.0)
        return ensure_packs(self.spark, _STORED_MAPPINGS[run], key, self.tgt, self.src, self.MAX_SPACING_M)

    @cached_property
    def granule(self) -> DataFrame:
        k, d = F.col("o_orderkey"), F.col("o_orderdate")
        hemi = F.when(k % 2 == 0, "nh").otherwise("sh")
        days = lambda n: F.make_interval(days=n.cast("int"))
        name = F.concat(F.lit("G"), k.cast("string"), F.lit("_"), hemi, F.lit("_"), F.date_format(d, "yyyyMMdd"), F.lit(".nc"))
        ds = F.concat(F.lit("DS"), (k % 5).cast("string"))
        ok = F.col("o_orderstatus") != "P"
        has_path = (F.col("o_orderpriority") != "5-LOW") | (F.col("o_orderstatus") != "F")
        return self.orders.select(
            F.concat(F.lit("I"), k.cast("string")).alias("id"), ds.alias("ds"), name.alias("filename"),
            F.concat(F.lit("G"), k.cast("string"), F.lit(".nc")).alias("short"), hemi.alias("hemi"), d.alias("date"),
            (d + days(k % 40)).alias("mod_time"), (d + days(k % 35)).alias("download_time"),
            F.when(has_path, F.concat(F.lit("/data/"), ds, F.lit("/"), name)).otherwise("").alias("path"),
            (F.col("o_custkey") % 3).cast("string").alias("checksum"),
            F.floor(F.col("o_totalprice") / 1000).alias("size"), ok.alias("success"),
            F.when(ok, "").otherwise(F.concat(F.lit("download failed: "), F.col("o_orderpriority"))).alias("message"),
            "o_orderkey", "o_orderstatus",
        )

    @cached_property
    def tx(self) -> DataFrame:
        from tidegrid.operators.harvest import latest_per_key

        k = F.col("l_orderkey")
        ok = F.col("l_discount") < 0.09
        order = ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"]
        # spread by order first: the table is one row group, which a single task would sort
        items = latest_per_key(self.spread(self.lineitem, "l_orderkey"), ["l_orderkey", "l_returnflag", "l_linestatus"], order)
        rows = items.select(
            F.concat(F.lit("DS"), (k % 5).cast("string")).alias("ds"),
            F.concat(F.lit("G"), k.cast("string"), F.lit(".nc")).alias("filename"),
            F.col("l_returnflag").alias("grid"), F.col("l_linestatus").alias("field"),
            F.col("l_shipdate").alias("date"), F.col("l_shipdate").alias("started"),
            (F.col("l_shipdate") + F.make_interval(days=F.col("l_linenumber"))).alias("completed"),
            ok.alias("success"), (F.lit(1.0) + F.col("l_linenumber") % 2).alias("version"),
            (F.col("l_partkey") % 3).cast("string").alias("origin_checksum"),
            F.when(~ok, F.concat(F.lit("failed at "), (F.col("l_suppkey") % 7).cast("string")))
            .when(F.col("l_tax") > 0.07, "field missing").otherwise("").alias("message"),
        )
        return rows.withColumn("id", F.concat(F.lit("T"), "filename", "grid", "field"))

    @cached_property
    def agg(self) -> DataFrame:
        """Aggregation state: every third year of grid N has not been aggregated yet."""
        year = F.year("date").cast("int")
        rows = self.tx.groupBy("ds", "grid", "field", year.alias("year")).agg(
            F.max("date").alias("last"), (F.count_if("success") * 100 >= F.count(F.lit(1)) * 82).alias("success"))
        return rows.filter((F.col("grid") != "N") | (F.col("year") % 3 != 0)).select(
            F.concat_ws("-", "ds", "grid", "field", F.col("year").cast("string")).alias("id"), "ds", "grid", "field",
            "year", "success", (F.col("last") + F.make_interval(days=F.lit(3))).alias("agg_time"),
            F.when(F.col("year") <= 1997, "1.0").otherwise("2.0").alias("version"),
            F.when(F.col("success"), "").otherwise("too many failures").alias("message"))

    @cached_property
    def config(self) -> DataFrame:
        """Dataset settings; five of the datasets have granules."""
        k = F.col("n_nationkey")
        return self.table("nation").select(
            F.concat(F.lit("DS"), k.cast("string")).alias("ds"),
            F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("V"), F.col("n_regionkey").cast("string"))).alias("variable"),
            (k != 4).alias("active"), (F.lit(1.0) + k % 2).alias("t_version"), F.lit("2.0").alias("a_version"))
