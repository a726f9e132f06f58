"""Sums and counts per month and cell, kept so that a changed day costs its month and not its year.

A folder per (series, year, month) holds ``total`` and ``n`` of each cell, and in every row the days of
the month on which some cell has a value (``need``) and a mark of the month's inputs (``mark``). A month
whose inputs have another mark is computed again and replaces its folder; means of all months come from
the stored rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.timebounds import month_window
from tidegrid.operators.mapping import filesystem
from tidegrid.operators.temporal import days_with_data
from tidegrid.session import shared_dir
from tidegrid.sizing import materialize, spread_join

MONTH = ["year", "month"]


def month_of(date: Column | str) -> list[Column]:
    day = (F.col(date) if isinstance(date, str) else date).cast("date")
    return [F.year(day).alias("year"), F.month(day).alias("month")]


def input_marks(inputs: DataFrame, keys: Sequence[str], facts: Sequence[str], date: str = "date") -> DataFrame:
    """(keys, year, month, mark): a mark that changes with any input of the month, whatever their order.

    ``facts`` are the columns that tell a changed input from the old one, such as its checksum or time. A
    repeated input counts as often as it occurs.
    """
    own = F.xxhash64(*facts, *[F.col(f).isNull() for f in facts])
    # sums of halves cannot overflow for any real number of inputs
    low, high = F.sum(own.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftright(own, 32))
    return inputs.groupBy(*keys, *month_of(date)).agg(F.xxhash64(low, high, F.count(F.lit(1))).alias("mark"))


def stored_partials(spark: SparkSession, path: str, keys: Sequence[T.StructField], cell: T.StructField) -> DataFrame:
    """The stored rows (keys, year, month, cell, total, n, need, mark); none before the first update.

    Each month also has one row without a cell, so that a month without records has a mark too.
    """
    field = lambda name, kind: T.StructField(name, kind)
    schema = T.StructType([
        T.StructField(cell.name, cell.dataType), field("total", T.DoubleType()), field("n", T.LongType()), field("need", T.LongType()), field("mark", T.LongType()),
        *[field(k.name, k.dataType) for k in keys], field("year", T.IntegerType()), field("month", T.IntegerType())])
    fs, folder = filesystem(spark, path)
    rows = spark.read.schema(schema).parquet(path) if fs.exists(folder) else spark.createDataFrame([], schema)
    return rows.select(*[k.name for k in keys], *MONTH, cell.name, "total", "n", "need", "mark")


def changed_months(stored: DataFrame, marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, year, month, mark) of the months whose inputs are not those stored; a month left without inputs has no mark."""
    on = [*keys, *MONTH]
    # of a month's rows the one without a cell stands for it
    old = stored.filter(F.col(stored.columns[len(on)]).isNull()).select(*on, F.col("mark").alias("old"), F.lit(True).alias("known"))
    both = marks.select(*on, "mark").join(old, on, "full_outer")
    return both.filter(F.col("known").isNull() | ~F.col("mark").eqNullSafe(F.col("old"))).select(*on, "mark")


def update_partials(series: DataFrame, path: str, keys: Sequence[str], years: DataFrame | None = None,
                    cell: str = "cell_id", value: str = "value", date: str = "date", marks: DataFrame | None = None) -> DataFrame:
    """Bring the stored months up to ``series`` and return those that were rewritten (keys, year, month, mark).

    ``series`` has at most one row per (keys, date, cell). Marks are taken of its rows, in one pass that
    folds per task, unless ``marks`` (see ``input_marks``) tell its months apart already. With ``years``
    (keys, year) all other years stay as they are; without, a month that the series no longer has is
    emptied. Keys must not be null. Months replace their folders one by one, each with its mark: an
    update that dies is finished by the next one.
    """
    spark, on = series.sparkSession, [*keys, *MONTH]
    stored = stored_partials(spark, path, [series.schema[k] for k in keys], series.schema[cell])
    marks = input_marks(series, keys, [date, cell, value], date) if marks is None else marks
    if years is not None:
        stored, marks = (spread_join(t, years.select(*keys, "year"), [*keys, "year"], salt_from=["month"], how="left_semi") for t in (stored, marks))
    changed = materialize(changed_months(stored.select(*on, cell, "mark"), marks, keys), shared_dir(spark, "changed-months"))
    if changed.isEmpty():
        return changed
    rows = series.select(*keys, F.col(date).alias("date"), *month_of(date), cell, F.col(value).cast("double").alias("v"))
    rows = spread_join(rows, changed.select(*on), on, salt_from=[cell], how="left_semi")
    partial = rows.groupBy(*on, cell).agg(F.sum("v").alias("total"), F.count("v").alias("n"))
    none = changed.select(*on, F.lit(None).cast(series.schema[cell].dataType).alias(cell), F.lit(None).cast("double").alias("total"), F.lit(0).cast("long").alias("n"))
    need = materialize(days_with_data(rows, keys, "date", "v"), shared_dir(spark, "month-days"))
    heads = changed.join(need, on, "left").select(*on, F.coalesce("need", F.lit(0)).cast("long").alias("need"), "mark")
    out = spread_join(partial.unionByName(none), heads, on, salt_from=[cell])
    (
        out.select(cell, "total", "n", "need", "mark", *on).hint("rebalance", *on).sortWithinPartitions(*on, cell)
        .write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(*on).parquet(path)
    )
    return changed


def monthly_from_partials(stored: DataFrame, keys: Sequence[str], skipna: bool = False, drop_empty: bool = True,
                          cell: str = "cell_id", value: str = "value") -> DataFrame:
    """Twelve monthly means per (keys, cell, year), as ``temporal.monthly_mean`` gives them from the whole series."""
    months = range(1, 13)
    at = lambda m, c: F.when(F.col("month") == m, F.col(c))
    flat = stored.filter(F.col(cell).isNotNull()).groupBy(*keys, cell, "year").agg(
        *[F.max(at(m, c)).alias(f"{c}{m}") for m in months for c in ("total", "n", "need")])
    long = flat.select(*keys, cell, "year", F.explode(F.array(*[
        F.struct(F.lit(m).alias("month"), *[F.col(f"{c}{m}").alias(c) for c in ("total", "n", "need")]) for m in months])).alias("p")).select(*keys, cell, "year", "p.*")
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    if not skipna:
        calendar = F.day(F.last_day(F.make_date(F.col("year"), F.col("month"), F.lit(1))))
        mean = F.when(F.col("n") == (F.col("need") if drop_empty else calendar), mean)
    return long.withColumns({value: mean, "w": month_window("year", "month")}).select(
        *keys, cell, "year", "month", value, F.col("w.start").alias("time_start"), F.col("w.center").alias("time"), F.col("w.end").alias("time_end"))
