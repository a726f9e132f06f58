"""Facts about files and the inventory of products."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Files up to this size are one value of Spark's reader, whose own limit is 2 GB; chunks of larger ones.
WHOLE_BYTES, CHUNK_BYTES = 256 << 20, 8 << 20


def inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, size and time of every file below ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true").load(path)
    )
    return files.select(
        "path", F.substring_index("path", "/", -1).alias("filename"),
        F.col("length").alias("size"), F.col("modificationTime").alias("mtime"),
    )


def checksums(spark: SparkSession, path: str, glob: str = "*", whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """As ``inventory`` plus the md5 of the contents.

    Files up to ``whole_bytes`` are read by Spark as one value; larger ones of any size are read in
    chunks, which needs a store that the tasks' file system library reaches. Empty files are not listed.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true").load(path)
    )
    facts = [F.substring_index("path", "/", -1).alias("filename"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime")]
    small = files.filter(F.col("length") <= whole_bytes).select("path", *facts, F.md5("content").alias("checksum"))
    large = files.filter(F.col("length") > whole_bytes).select("path", *facts)
    schema = T.StructType([*large.schema.fields, T.StructField("checksum", T.StringType())])
    return small.unionByName(large.mapInPandas(_digests, schema))


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Add the md5 of each file, read chunk by chunk."""
    for batch in batches:
        sums = []
        for path in batch["path"]:
            store, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
            digest = hashlib.md5()
            with store.open_input_stream(name) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            sums.append(digest.hexdigest())
        yield batch.assign(checksum=sums)


def product_inventory(files: DataFrame, path: str = "path") -> DataFrame:
    """Dataset, grid, field, time scale and year of each annual product file."""
    # Fixed value: folder layout of the products.
    pattern = r"([^/]+)/transformed_products/([^/]+)/aggregated/([^/]+)/netCDF/[^/]*_(MONTHLY|DAILY)_[^/]*_(\d{4})\.nc$"
    part = lambda n: F.regexp_extract(F.col(path), pattern, n)
    return (
        files.filter(F.col(path).rlike(pattern))
        .select(
            "*", part(1).alias("ds"), part(2).alias("grid"), part(3).alias("field"),
            part(4).alias("time_scale"), part(5).cast("int").alias("year"),
        )
    )
