"""Token counts of whole texts by a lookup in two tiers, without shuffling pre-tokens.

A first pass over all texts counts chunks of pre-tokens within each task and keeps a fixed number of
the most frequent ones per task. The most frequent of all make a compact hash table of lengths, of
``FREQUENT`` entries at most, that is broadcast. The second pass looks every chunk up there; what is
missing goes through the cache of the worker, which encodes each chunk once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.chunks import Encoder, chunked, worker_encoder

FREQUENT = 1 << 16
PER_TASK = 1 << 12
# Distinct chunks a task counts at once; beyond it the rarer half goes, which costs speed and no result.
COUNTED = 1 << 19
SLOT_BITS = 18


def frequent_chunks(docs: DataFrame, text: str, path: str) -> list[tuple[bytes, int]]:
    """The most frequent chunks of all texts, ``FREQUENT`` at most, with a lower bound of their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = worker_encoder(path, False).whole
        keys, sums, texts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)
        for batch in batches:
            for c in chunked(batch.column(0), whole):
                new, first, number = np.unique(c.hashes, return_index=True, return_counts=True)
                keep = number > 1
                short = (c.ends - c.starts)[first] <= 64
                new, first, number = new[keep & short], first[keep & short], number[keep & short]
                words = np.fromiter((c.data[c.starts[i] : c.ends[i]].tobytes() for i in first), object, len(first))
                keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, at, np.concatenate([sums, number]))
                named = np.empty(len(keys), object)
                named[at] = np.concatenate([texts, words])
                sums, texts = total, named
                if len(keys) > COUNTED:
                    top = np.argsort(-sums, kind="stable")[: COUNTED // 2]
                    top.sort()
                    keys, sums, texts = keys[top], sums[top], texts[top]
        top = np.argsort(-sums, kind="stable")[:PER_TASK]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(texts[top]), pa.binary()), pa.array(sums[top], pa.int64())], ["chunk", "n"])

    counts = docs.select(F.col(text)).mapInArrow(count, "chunk binary, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
    return [(bytes(r.chunk), r.n) for r in counts.orderBy(F.desc("n"), "chunk").limit(FREQUENT).collect()]


def length_table(chunks: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Direct-mapped arrays (hash, length); of chunks that share a slot the first stays."""
    from tidegrid.llm.textops import hash_spans

    keys, lengths = np.zeros(1 << SLOT_BITS, np.uint64), np.zeros(1 << SLOT_BITS, np.uint16)
    if chunks:
        ends = np.cumsum([len(c) for c in chunks])
        hashes = hash_spans(np.frombuffer(b"".join(chunks), np.uint8), np.concatenate([[0], ends[:-1]]), ends)
        numbers = np.array([len(x) for x in Encoder(path, False).encode([c.decode() for c in chunks])])
        slots = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        keys[slots[::-1]], lengths[slots[::-1]] = hashes[::-1], numbers[::-1]
    return keys, lengths


def count_tokens(docs: DataFrame, path: str, id_col: str | Column = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs``, with the tokenizer file at ``path``.

    The counts are those of the tokenizer's library over whole texts: no begin, end or padding tokens,
    no truncation; added tokens' strings are read as the library reads them by default. A null text is
    empty and has no bytes and tokens; ids may be null or repeat, every row gives one row; an empty
    table gives none. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    ids = F.col(id_col) if isinstance(id_col, str) else id_col
    table = spark.sparkContext.broadcast(length_table([c for c, _ in frequent_chunks(docs, text, path)], path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, False)
        keys, lengths = table.value
        for batch in batches:
            n_bytes, n_tokens = [], []
            for c in chunked(batch.column(1), encoder.whole):
                slots = (c.hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                each = lengths[slots].astype(np.int64)
                rest = np.flatnonzero(keys[slots] != c.hashes)
                if len(rest):
                    entries = encoder.entries(c, rest)
                    each[rest] = encoder.lengths[entries]
                sums = np.concatenate([[0], np.cumsum(each)])
                n_tokens.append(np.diff(sums[c.bounds]))
                ends = np.append(c.starts, len(c.data))
                n_bytes.append(np.diff(ends[c.bounds]))
            join = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), join(n_bytes), join(n_tokens)], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(ids.cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long")
