"""Status, coverage and failure reports over the state tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.planning import _true, only
from tidegrid.sizing import bounded_broadcast

STAGES = ("Harvest", "Transform", "Aggregate")
NO_MESSAGE = "(no message)"
UNASSIGNED = "unassigned"
DASH = "—"


def has_message(message: str = "message") -> Column:
    return F.trim(F.coalesce(F.col(message), F.lit(""))) != ""


def label_or(col: Column | str, default: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def recent(df: DataFrame, time: str, cutoff: Column) -> DataFrame:
    """Rows whose attempt time is at or after the cutoff."""
    return df.filter(F.col(time) >= cutoff)


def totals(granules: DataFrame, tx: DataFrame, agg: DataFrame, datasets: DataFrame, active: DataFrame) -> DataFrame:
    """Rows per stage for active datasets; a stage without rows counts 0."""
    stages = {"granules": granules, "transformations": tx, "aggregations": agg, "datasets": datasets}
    out = None
    for name, df in stages.items():
        n = only(df, active, "ds").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        out = n if out is None else out.unionByName(n)
    return out


def coverage(granules: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """First and last usable date and number of granules per dataset."""
    rows = granules.filter(_true("success"))
    if active is not None:
        rows = only(rows, active, "ds")
    return rows.groupBy("ds").agg(
        F.min("date").alias("start"), F.max("date").alias("end"), F.count(F.lit(1)).alias("n"))


def coverage_timeline(datasets: DataFrame, covered: DataFrame) -> DataFrame:
    """All datasets with their coverage in display order: by variable, covered ones first by start.

    ``position`` numbers the rows; the table has one row per dataset.
    """
    from pyspark.sql import Window

    rows = (
        datasets.select("ds", label_or("variable", UNASSIGNED).alias("variable"))
        .join(covered, "ds", "left")
        .withColumns({"has_data": F.col("start").isNotNull(), "n": F.coalesce("n", F.lit(0))})
    )
    w = Window.partitionBy("variable").orderBy(
        F.col("has_data").desc(), F.col("start").asc_nulls_last(), F.col("ds"))
    return rows.withColumn("position", F.row_number().over(w))


def daily_outcomes(granules: DataFrame, keys: Sequence[str] = ("ds",)) -> DataFrame:
    """Granules per date and outcome."""
    return granules.groupBy(*keys, F.col("date").cast("date").alias("day"), "success").agg(
        F.count(F.lit(1)).alias("n")
    ).withColumn("status", F.when(F.col("success"), F.lit("Success")).otherwise(F.lit("Failed")))


def panel_metrics(df: DataFrame, keys: Sequence[str] = ("ds",), date: str = "date") -> DataFrame:
    """Total, successful, failed, success rate in percent and latest successful date."""
    ok = F.col("success")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.round(F.count_if(ok) * 100 / F.count(F.lit(1)), 1).alias("rate"),
        F.max(F.when(ok, F.col(date).cast("date"))).alias("latest"),
    )


def success_rates(tx: DataFrame) -> DataFrame:
    """Success rate in percent per grid and field, one decimal."""
    return tx.groupBy("grid", "field").agg(
        F.round(F.count_if(F.col("success")) * 100 / F.count(F.lit(1)), 1).alias("rate"))


def success_pivot(tx: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Success rates with one column per field; the field list comes from the configuration."""
    return success_rates(tx).groupBy("grid").pivot("field", list(fields)).agg(F.first("rate"))


def coverage_strip(agg: DataFrame) -> DataFrame:
    """Per (ds, grid, field), one row per year from the dataset's first to last: success, failed, or none.

    The last aggregation of a year decides. Years are an exploded sequence per group, at most one
    row per calendar year.
    """
    last = agg.filter(F.col("year").isNotNull()).groupBy("ds", "grid", "field", "year").agg(
        F.max_by("success", F.col("agg_time")).alias("success"))
    span = last.groupBy("ds").agg(F.min("year").alias("y0"), F.max("year").alias("y1"))
    spine = (
        last.select("ds", "grid", "field").distinct().join(bounded_broadcast(span), "ds")
        .select("ds", "grid", "field", F.explode(F.sequence("y0", "y1")).alias("year"))
    )
    state = (
        F.when(F.col("success").isNull(), F.lit("no aggregation"))
        .when(F.col("success"), F.lit("success")).otherwise(F.lit("failed"))
    )
    return spine.join(last, ["ds", "grid", "field", "year"], "left").select(
        "ds", "grid", "field", "year", state.alias("status"))


def gf_summary(agg: DataFrame) -> DataFrame:
    """Per (ds, grid, field): span and number of years, successes, failures, last run."""
    return agg.filter(F.col("year").isNotNull()).groupBy("ds", "grid", "field").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.count_distinct("year").alias("years"), F.count_if(F.col("success")).alias("successful"),
        F.count_if(~F.col("success")).alias("failed"), F.max("agg_time").alias("last_run"))


def _staged(granules: DataFrame, tx: DataFrame, agg: DataFrame) -> DataFrame:
    """The three stages in one shape."""
    pair = F.concat_ws(" / ", "grid", "field")
    day = F.coalesce(F.date_format("date", "yyyy-MM-dd"), F.lit(""))
    shape = lambda df, stage, date, detail: df.select(
        F.lit(stage).alias("stage"), "ds", date.alias("date"), detail.alias("detail"), "success", "message")
    return (
        shape(granules, "Harvest", day, F.col("filename"))
        .unionByName(shape(tx, "Transform", day, pair))
        .unionByName(shape(agg, "Aggregate", F.coalesce(F.col("year").cast("string"), F.lit("")), pair))
    )


def failures(granules: DataFrame, tx: DataFrame, agg: DataFrame) -> DataFrame:
    """Failed rows of all stages."""
    return _staged(granules, tx, agg).filter(~_true("success")).drop("success").withColumnRenamed("message", "error")


def warnings(granules: DataFrame, tx: DataFrame, agg: DataFrame) -> DataFrame:
    """Successful rows that still carry a message."""
    return _staged(granules, tx, agg).filter(_true("success") & has_message()).drop("success")


def activity_summary(granules: DataFrame, tx: DataFrame, agg: DataFrame) -> DataFrame:
    """Totals and failures of the three stages per dataset."""
    tagged = None
    for stage, df in zip(STAGES, (granules, tx, agg)):
        part = df.select("ds", F.lit(stage).alias("stage"), "success")
        tagged = part if tagged is None else tagged.unionByName(part)
    names = {"Harvest": ("granules", "harvest_failures"), "Transform": ("transformations", "transform_failures"),
             "Aggregate": ("aggregations", "agg_failures")}
    cols = []
    for stage, (total, bad) in names.items():
        here = F.col("stage") == stage
        cols += [F.count_if(here).alias(total), F.count_if(here & ~_true("success")).alias(bad)]
    return tagged.groupBy("ds").agg(*cols)


def error_rollup(failed: DataFrame) -> DataFrame:
    """Failures grouped by message: count, stages and datasets involved.

    Stages and datasets are reduced to distinct pairs before they are listed.
    """
    e = failed.withColumn("error", label_or("error", NO_MESSAGE))
    per = e.groupBy("error", "stage", "ds").agg(F.count(F.lit(1)).alias("c"))
    listing = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ", ")
    return per.groupBy("error").agg(
        F.sum("c").alias("n"), listing("stage").alias("stages"), listing("ds").alias("datasets"))


def product_report(products: DataFrame) -> DataFrame:
    """Files and first and last year per dataset, grid, field and time scale."""
    return products.groupBy("ds", "grid", "field", "time_scale").agg(
        F.count(F.lit(1)).alias("files"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def dataset_names(granules: DataFrame, tx: DataFrame, agg: DataFrame) -> DataFrame:
    """Datasets seen in any stage."""
    return granules.select("ds").union(tx.select("ds")).union(agg.select("ds")).distinct()


def dataset_strip(datasets: DataFrame) -> DataFrame:
    """Status texts and last run times of a dataset; blanks show a dash."""
    shown = lambda c: label_or(F.trim(F.col(c)), DASH).alias(c)
    when = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(DASH)).alias(c)
    return datasets.select(
        "ds", *[shown(c) for c in ("harvest_status", "transformation_status", "aggregation_status")],
        *[when(c) for c in ("last_checked", "last_transformation", "last_aggregation")])


def detail_table(df: DataFrame, names: dict[str, str], warnings_only: bool = False) -> DataFrame:
    """Failure (or warning) rows of one stage under display names."""
    keep = (_true("success") & has_message()) if warnings_only else ~_true("success")
    return df.filter(keep).select(*[F.col(c).alias(n) for c, n in names.items()])
