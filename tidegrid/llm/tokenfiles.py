"""Token-id files: blocks of separately compressed documents with an offset index.

A folder holds ``dictionary`` (one row: the shared Zstandard dictionary and its SHA-256) and
``blocks``. A row of ``blocks`` is up to ``BLOCK_DOCS`` documents in ascending id order: their ids, the
number of token ids of each, the end of each document's compressed bytes, the bytes, and the hash of
the dictionary they need. ``shard`` numbers the ranges of ids in ascending order, so the files put one
after another are the corpus in id order. To read one document, fetch its block by the id range,
slice its bytes by the offsets and decompress only those.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.llm.chunks import chunked, worker_encoder
from tidegrid.llm.scratch import hash_share

BLOCK_DOCS = 256
BLOCK_BYTES = 8 << 20
# The dictionary is trained on the ids of at most this many documents (lowest hash of id and text, of
# about four times as many candidates) of at most this many bytes each. It affects the size of the files only.
SAMPLE_DOCS, SAMPLE_BYTES = 1024, 8192
DICTIONARY_BYTES = 64 << 10
LEVEL = 1
DOCS_PER_SHARD = 8192
BLOCKS = ("shard int, block long, first_doc long, last_doc long, doc_ids array<long>, n_tokens array<long>, "
          "ends array<long>, dictionary string, payload binary")


def encoded(column: pa.Array, path: str, end_id: int) -> Iterator[np.ndarray]:
    """Ids of each text with the end id, as little-endian unsigned 32-bit integers."""
    encoder = worker_encoder(path, True)
    for c in chunked(column, encoder.whole):
        ids, lengths = encoder.expand(encoder.entries(c))
        at = np.concatenate([[0], np.cumsum(lengths)])[c.bounds]
        for lo, hi in zip(at[:-1], at[1:]):
            yield np.append(ids[lo:hi], np.uint32(end_id)).astype("<u4")


def train_dictionary(docs: DataFrame, path: str, end_id: int, count: int) -> bytes:
    """A dictionary for the id arrays of a bounded sample of short documents; empty if they are too few.

    ``count`` is the number of rows: hashes below a bound that follows from it are the candidates, so the
    task that picks the sample gets the same number of texts whatever the number of partitions. Equal
    rows are one.
    """
    share = 4.0 * SAMPLE_DOCS / max(count, 1)
    chosen = docs.filter(F.octet_length("text").between(1, SAMPLE_BYTES)).select(
        "text", F.xxhash64("doc_id", "text").alias("h")).filter(hash_share(F.col("h")) < share)
    chosen = chosen.groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(SAMPLE_DOCS).select("text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = [ids.tobytes() for b in batches for ids in encoded(b.column(0), path, end_id)]
        try:
            data = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 16 else b""
        except zstandard.ZstdError:  # samples without anything in common
            data = b""
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    rows = chosen.coalesce(1).mapInArrow(train, "data binary").collect()
    return bytes(rows[0].data) if rows else b""


def _compressor(dictionary: bytes):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if shared is not None:
        shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared) if shared else zstandard.ZstdCompressor(level=LEVEL)


def _decompressor(dictionary: bytes):
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = 0) -> None:
    """Encode the rows of ``docs`` (doc_id, text) and write them to ``folder`` in ascending id order.

    A null text is empty: its document is the end id alone. Null ids come first. Rows with one id
    stand together, ordered by a hash of the text. An empty table makes no blocks. The dictionary is a
    few dozen kilobytes, so it goes to the tasks as it is.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    count = docs.select(F.count(F.lit(1))).first()[0]
    dictionary = train_dictionary(docs, path, end_id, count)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dictionary, digest)], "data binary, sha256 string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, compressor, block, number = TaskContext.get().partitionId(), _compressor(shared.value), [], 0

        def flush() -> pa.RecordBatch:
            ids, lengths, parts = zip(*block)
            known = [i for i in ids if i is not None]
            values = [[shard], [number], [min(known, default=None)], [max(known, default=None)], [list(ids)], [list(lengths)],
                      [np.cumsum([len(p) for p in parts]).tolist()], [digest], [b"".join(parts)]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], [f.split()[0] for f in BLOCKS.split(", ")])

        held = 0
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), path, end_id)):
                part = compressor.compress(ids.tobytes())
                block.append((doc, len(ids), part))
                held += len(part)
                if len(block) == BLOCK_DOCS or held >= BLOCK_BYTES:
                    yield flush()
                    block, number, held = [], number + 1, 0
        if block:
            yield flush()

    shards = max(1, spark.sparkContext.defaultParallelism, -(-count // DOCS_PER_SHARD))
    ordered = docs.withColumn("h", F.xxhash64("text")).repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "h").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "h").drop("h")
    ordered.mapInArrow(write, BLOCKS).write.mode("overwrite").parquet(f"{folder}/blocks")


def _dictionary(spark: SparkSession, folder: str) -> tuple[bytes, str]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    data = bytes(row.data)
    if hashlib.sha256(data).hexdigest() != row.sha256:
        raise ValueError("the dictionary does not have its stated hash")
    return data, row.sha256


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decompressed from the files."""
    dictionary, digest = _dictionary(spark, folder)
    shared = spark.sparkContext.broadcast(dictionary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = _decompressor(shared.value)
        for batch in batches:
            for shard, block, docs, lengths, ends, needed, payload in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if needed != digest:
                    raise ValueError(f"block {shard}/{block} needs another dictionary")
                crcs, start = [], 0
                for length, end in zip(lengths, ends):
                    ids = decompressor.decompress(payload[start:end], max_output_size=4 * length)
                    if len(ids) != 4 * length:
                        raise ValueError(f"block {shard}/{block} holds a document of a wrong length")
                    crcs.append(zlib.crc32(ids))
                    start = end
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array([shard] * n, pa.int32()), pa.array([block] * n, pa.int64()),
                     pa.array(range(n), pa.int32()), pa.array(np.cumsum(lengths) - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "shard", "block", "place", "before", "n_tokens", "ids_crc32"])

    blocks = spark.read.parquet(f"{folder}/blocks")
    rows = blocks.select("shard", "block", "doc_ids", "n_tokens", "ends", "dictionary", "payload").mapInArrow(
        read, "doc_id long, shard int, block long, place int, before long, n_tokens long, ids_crc32 long")
    starts = block_starts(blocks)
    return rows.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def block_starts(blocks: DataFrame) -> DataFrame:
    """(shard, block, start): ids before each block, from sums per shard and then per block of a shard."""
    sizes = blocks.select("shard", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("start", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(shards, "shard").select(
        "shard", "block", (F.col("shard_start") + F.col("start")).alias("start"))


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with one id: only blocks whose range has it, and of those only its bytes."""
    dictionary, _ = _dictionary(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks").filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    at = F.explode(F.filter(F.sequence(F.lit(1), F.size("doc_ids")), lambda i: F.element_at("doc_ids", i) == doc_id))
    found = blocks.select("shard", "block", at.alias("i"), "ends", "payload", "n_tokens").select(
        "shard", "block", "i", F.element_at("n_tokens", F.col("i")).alias("n"),
        F.when(F.col("i") > 1, F.get("ends", F.col("i") - 2)).otherwise(0).alias("lo"), F.element_at("ends", F.col("i")).alias("hi"), "payload",
    ).selectExpr("shard", "block", "i", "n", "substring(payload, int(lo) + 1, int(hi - lo)) AS part")
    rows = found.orderBy("shard", "block", "i").collect()
    return [np.frombuffer(_decompressor(dictionary).decompress(bytes(r.part), max_output_size=4 * r.n), "<u4").tolist() for r in rows]
