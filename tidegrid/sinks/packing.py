"""Flat big-endian float records in layout order.

A record is packed in blocks of a fixed number of cells, so a group never outgrows one block
whatever the grid's size. Blocks carry their byte offset in the record.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.units import BINARY_FILL
from tidegrid.sizing import materialize, shuffle_width

BLOCK_CELLS = 65_536
BYTES_PER_CELL = 4


def pack_records(values: DataFrame, keys: Sequence[str], position: Column, n_cells: int,
                 value: str = "value", block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(keys, block, offset, data): missing cells are the fill value.

    ``position`` is a cell's place in the record. A block comes out if any of its cells has a row,
    so pass values on the full grid to get every block.
    """
    keys = list(keys)
    schema = T.StructType([values.schema[k] for k in keys] + [
        T.StructField("block", T.LongType()), T.StructField("offset", T.LongType()),
        T.StructField("data", T.BinaryType()),
    ])

    def pack(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block = int(group[-1])
        start = block * block_cells
        out = np.full(min(block_cells, n_cells - start), BINARY_FILL, dtype=">f4")
        have = rows["__v"].notna().to_numpy()
        out[rows["__pos"].to_numpy()[have] - start] = rows["__v"].to_numpy()[have]
        return pd.DataFrame([[*group[:-1], block, start * BYTES_PER_CELL, out.tobytes()]],
                            columns=schema.names)

    rows = values.select(
        *keys, position.cast("bigint").alias("__pos"), F.col(value).cast("float").alias("__v")
    ).withColumn("block", F.floor(F.col("__pos") / block_cells))
    return rows.groupBy(*keys, "block").applyInPandas(pack, schema)


def pack_whole(values: DataFrame, records: DataFrame, keys: Sequence[str], value: str = "value",
               block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(keys, block, offset, data) of every block of every record, whether it has values or not.

    ``records`` has one row per record with ``n_cells``, its number of cells; ``values`` has keys,
    ``position`` and the value of the cells that have one. A record without any, such as a gap, is made
    of fill values where its blocks are written, so no row per missing cell exists.
    """
    keys = list(keys)
    block = F.floor(F.col("position") / block_cells).alias("block")
    cell = F.struct(F.pmod("position", F.lit(block_cells)).cast("int").alias("at"), F.col(value).cast("float").alias("v"))
    held = values.filter(F.col(value).isNotNull()).select(*keys, block, cell.alias("cell")).groupBy(*keys, "block").agg(F.collect_list("cell").alias("cells"))
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("n_cells") - 1) / block_cells)).cast("array<bigint>")).alias("block")
    sheets = records.filter("n_cells > 0").select(*keys, "n_cells", blocks).join(held, [*keys, "block"], "left")
    size = F.least(F.lit(block_cells), F.col("n_cells") - F.col("block") * block_cells).cast("int").alias("size")
    kinds = ", ".join(f"{k} {records.schema[k].dataType.simpleString()}" for k in keys)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, sizes, data = batch.column(len(keys) + 2), batch.column(len(keys) + 1).to_numpy(), []
            ends, flat = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(cells), 0).to_numpy())]), cells.flatten()
            at, v = flat.field("at").to_numpy(), flat.field("v").to_numpy()
            for i, n in enumerate(sizes.tolist()):
                out = np.full(n, BINARY_FILL, dtype=">f4")
                out[at[ends[i] : ends[i + 1]]] = v[ends[i] : ends[i + 1]]
                data.append(out.tobytes())
            blocks = batch.column(len(keys)).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], batch.column(len(keys)), pa.array(blocks * block_cells * BYTES_PER_CELL), pa.array(data, pa.binary())], [*keys, "block", "offset", "data"])

    return sheets.select(*keys, "block", size, "cells").mapInArrow(pack, f"{kinds}, block long, offset long, data binary")


def numbered_cells(cells: DataFrame, path: str) -> DataFrame:
    """(cell_id, position): distinct cell ids numbered from 0 in their order.

    Ids are written in ranges; the sizes of the ranges, one number each, give every range its start.
    """
    ranged = cells.select("cell_id").repartitionByRange(shuffle_width(cells), "cell_id").sortWithinPartitions("cell_id")
    local = materialize(ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)), path)
    sizes = local.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))  # a row per range
    return local.join(F.broadcast(starts), "part").select("cell_id", (F.col("start") + F.col("at")).alias("position"))


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Write blocks of annual products, in order of date and offset; only products in ``blocks`` are replaced."""
    parts = ["ds", "grid", "field", "year"]
    (
        blocks.hint("rebalance", *parts).sortWithinPartitions(*parts, "date", "offset")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    )


def unpack_blocks(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, position, value) of every cell of packed blocks; fill values stay as they are."""
    keys = list(keys)
    schema = T.StructType([blocks.schema[k] for k in keys] + [
        T.StructField("position", T.LongType()), T.StructField("value", T.DoubleType())])

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                values = np.frombuffer(row.data, dtype=">f4").astype(np.float64)
                out = {k: [getattr(row, k)] * len(values) for k in keys}
                yield pd.DataFrame({**out, "position": row.offset // BYTES_PER_CELL + np.arange(len(values)), "value": values})

    return blocks.select(*keys, "offset", "data").mapInPandas(unpack, schema)
