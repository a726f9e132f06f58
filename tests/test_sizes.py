"""What a task holds and what is shuffled must not follow the size of the tables; rows are made here."""

import glob
from datetime import date

from pyspark.sql import functions as F

from tidegrid.operators import regrid, state
from tidegrid.sinks import products, provenance
from tidegrid.workload import registry


def test_nearest_is_folded_by_hash_and_takes_the_first_of_a_source(spark):
    """joined rows are not sorted; of a source's rows the first by ties counts, missing ones too."""
    obs = spark.createDataFrame(
        [("f", 1, 5.0, 2), ("f", 1, None, 1), ("f", 2, 7.0, 3), ("g", 2, 8.0, 4), ("g", 3, 9.0, 5)], "field string, src_id long, value double, no long")
    mapping = spark.createDataFrame(
        [(0, 1, 10.0, 1, "radius"), (0, 2, 10.0, 2, "radius"), (1, 3, 4.0, 1, "nearest"), (2, 2, 3.0, 1, "radius")],
        "cell_id long, src_id long, dist_m double, rank int, kind string")
    out = regrid.regrid(obs, mapping, ["field"], "nearest", ties=["no"])
    assert sorted(tuple(r) for r in out.collect()) == [("f", 0, None), ("f", 2, 7.0), ("g", 0, 8.0), ("g", 1, 9.0), ("g", 2, 8.0)]
    same = regrid.regrid(obs, mapping.drop("rank"), ["field"], "nearest", ties=["no"])
    assert sorted(tuple(r) for r in same.collect()) == sorted(tuple(r) for r in out.collect())
    plan = regrid.regrid(obs, mapping, ["field"], "nearest")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_expanding_rows_are_spread_by_what_they_become(spark):
    """a few compact rows of one folder go to several tasks; a folder without a name keeps its rows."""
    df = spark.createDataFrame([("a", i, 100) for i in range(40)] + [("b", 1, 1), (None, 2, 500)], "folder string, k long, n int")
    out = products.spread_by_rows(df, ["folder"], F.col("n"), [F.col("k")], rows_per_task=500)
    assert out.rdd.getNumPartitions() == 10 and out.columns == df.columns
    per_task = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()]
    assert sum(per_task) == 4501 and max(per_task) <= 2500
    assert out.filter("folder IS NULL").count() == 1


def test_compact_gaps_are_written_whole(spark, tmp_path):
    """present rows and the rows of gaps all come out, in several files where there are many."""
    present = spark.createDataFrame([("D", "g", "f", date(2020, 1, 1), c, float(c)) for c in range(4)], "ds string, grid string, field string, date date, cell_id long, value double")
    gaps = present.select("ds", "grid", "field", F.array(F.lit("2020-01-02").cast("date"), F.lit("2020-01-03").cast("date")).alias("gap_dates"), F.array("cell_id").alias("gap_cells"))
    unnamed = gaps.limit(1).withColumn("gap_cells", F.expr("CAST(array() AS array<bigint>)"))  # cells without a number
    packed = present.unionByName(gaps, allowMissingColumns=True).unionByName(unnamed, allowMissingColumns=True).withColumn("year", F.lit(2020))
    from tidegrid.operators.temporal import fill_gaps

    products.write_product(packed, str(tmp_path), finish=lambda rows: fill_gaps(rows, ("ds", "grid", "field")))
    back = spark.read.parquet(str(tmp_path))
    assert back.filter("cell_id IS NOT NULL").count() == 12 and back.filter("cell_id IS NULL").count() == 2 and back.filter("value IS NOT NULL").count() == 4


def test_spread_follows_the_size_of_the_table(spark, tmp_path, monkeypatch):
    """more rows give more tasks, not larger ones."""
    spark.range(20000).write.parquet(str(tmp_path / "t.parquet"))
    monkeypatch.setattr(registry, "SPREAD_BYTES", 1024)
    v = registry.Views(spark, str(tmp_path))
    spread = v.spread(v.table("t"), "id")
    assert spread.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism and spread.count() == 20000


def test_cascade_does_not_sort_dependents_by_grid(spark):
    """few changed grids are broadcast, however large the tables seem that they are found in."""
    seems_large = spark.range(1000).filter("id = 7").select("id")
    for n in range(3):
        seems_large = seems_large.crossJoin(spark.range(1000).filter("id = 1").select(F.col("id").alias(f"x{n}")))
    changed = seems_large.select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("grid"))
    rows = spark.createDataFrame([("S7",), ("S8",), (None,)], "grid string")
    out = state.cascade(rows, changed)
    assert sorted(r.grid or "" for r in out.collect()) == ["", "S8"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_provenance_is_packed_and_not_written_again(spark, tmp_path):
    """text is gzipped; known products add no file."""
    lines = spark.createDataFrame([("D", "g", "f", 2020, k, "transformation", '{"k": 1}') for k in range(5)], "ds string, grid string, field string, year int, line_no int, kind string, json string")
    path = str(tmp_path / "p")
    provenance.write_provenance(lines, path)
    files = glob.glob(f"{path}/**/part-*", recursive=True)
    assert files and all(f.endswith(".gz") for f in files)
    provenance.write_provenance(lines, path, spark.read.text(path))
    assert spark.read.text(path).count() == 5 and glob.glob(f"{path}/**/part-*", recursive=True) == files
