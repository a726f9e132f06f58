"""Benchmark decontamination as a prefix-filtered set join with positional verification.

A benchmark item is cut into windows of ``window`` consecutive words (a shorter item is one window). The
shingles of a window are ordered by rarity, counted over all documents. Exact containment needs all
shingles of a window, so its rarest one is a sufficient prefix: only documents with that shingle are
candidates. A candidate position fixes where the window would begin; bounds of length and position
drop what cannot fit, and the words there are compared one by one.

Items are handled in blocks of bounded size, so that what is sent to the executors is bounded too; with
more than one block the documents pass through one after another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.chunks import HashTable
from tidegrid.llm.scratch import stored
from tidegrid.llm.textops import LETTER_DIGIT, hash_windows, kept, word_pieces

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 4 << 20  # of item texts in one block


@dataclass
class Windows:
    """The windows of a block of items, one row of words each (zero beyond the length)."""

    items: list[str]
    item: np.ndarray
    length: np.ndarray
    words: np.ndarray

    def shingle_size(self) -> np.ndarray:
        return np.minimum(self.length, SHINGLE)

    def shingles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, offset, hash) of every shingle of every window."""
        out = []
        for length in np.unique(self.length):
            rows = np.flatnonzero(self.length == length)
            size = min(int(length), SHINGLE)
            for at in range(int(length) - size + 1):
                flat = np.ascontiguousarray(self.words[rows, at : at + size])
                out.append((rows, np.full(len(rows), at), hash_windows(flat.ravel(), size)[::size] if len(rows) else np.zeros(0, np.uint64)))
        if not out:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.uint64)
        return tuple(np.concatenate(x) for x in zip(*out))


def cut_windows(items: list[tuple[str, str | None]], window: int) -> Windows:
    """Cut items (id, text) into windows; items without words have none, equal windows of an item count once."""
    ids, item, length, words, seen = [], [], [], [], set()
    for p in word_pieces(pa.array([t for _, t in items], pa.string()), LETTER_DIGIT, True):
        for d in range(p.last - p.first):
            own = p.hashes[p.bounds[d] : p.bounds[d + 1]]
            size = min(window, len(own))
            for at in range(len(own) - size + 1 if size else 0):
                run = own[at : at + size]
                key = (items[p.first + d][0], run.tobytes())
                if key not in seen:
                    seen.add(key)
                    item.append(len(ids))
                    length.append(size)
                    words.append(np.pad(run, (0, window - size)))
            ids.append(items[p.first + d][0])
    return Windows(ids, np.array(item, int), np.array(length, int), np.array(words, np.uint64).reshape(-1, window))


@dataclass
class Index:
    """Prefix shingles with the windows (and offsets in them) that they stand for, grouped by shingle."""

    windows: Windows
    sizes: list[int]
    table: HashTable
    first: np.ndarray
    window: np.ndarray
    offset: np.ndarray


def prefix_index(windows: Windows, counts: dict[int, int]) -> Index:
    """Take each window's rarest shingle; ties go to the smaller hash."""
    window, offset, shingle = windows.shingles()
    rarity = np.array([counts.get(int(s), 0) for s in shingle], np.int64)
    order = np.lexsort((offset, shingle, rarity, window))
    chosen = order[np.unique(window[order], return_index=True)[1]]
    chosen = chosen[np.argsort(shingle[chosen], kind="stable")]
    keys, first = np.unique(shingle[chosen], return_index=True)
    table = HashTable()
    table.add(keys, np.arange(len(keys), dtype=np.int32))
    return Index(windows, sorted(set(windows.shingle_size().tolist())), table, np.append(first, len(chosen)), window[chosen], offset[chosen])


def shingle_counts(docs: DataFrame, shingles: np.ndarray, sizes: list[int]) -> dict[int, int]:
    """Occurrences of the given shingles over all documents, summed within tasks first."""
    table = HashTable()
    keys = np.unique(shingles)
    table.add(keys, np.arange(len(keys), dtype=np.int32))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("windows", lambda: None)
        sums = np.zeros(len(keys), np.int64)
        for batch in batches:
            for p in word_pieces(batch.column(0), LETTER_DIGIT, True):
                for size in sizes:
                    at = shared.value.find(hash_windows(p.hashes, size))
                    np.add.at(sums, at[(at >= 0) & p.inside(size)[: len(at)]], 1)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sums[some], pa.int64())], ["k", "n"])

    rows = docs.select("text").mapInArrow(count, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    return {int(keys[r.k]): r.n for r in rows}


def find_windows(words: np.ndarray, owner_end: np.ndarray, index: Index, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, window) of every occurrence of an indexed window within one document of a piece."""
    starts, found = [np.zeros(0, int)], [np.zeros(0, int)]
    owner_start = np.repeat(bounds[:-1], np.diff(bounds))
    for size in index.sizes:
        at = index.table.find(hash_windows(words, size))
        hit = np.flatnonzero(at >= 0)
        key = at[hit]
        times = index.first[key + 1] - index.first[key]
        place = np.repeat(hit, times)
        entry = np.repeat(index.first[key] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
        window, start = index.window[entry], place - index.offset[entry]
        length = index.windows.length[window]
        fits = (start >= owner_start[place]) & (start + length <= owner_end[place]) & (np.minimum(length, SHINGLE) == size)
        start, window, length = start[fits], window[fits], length[fits]
        for j in range(int(length.max(initial=0))):
            same = (j >= length) | (words[np.minimum(start + j, len(words) - 1)] == index.windows.words[window, j])
            start, window, length = start[same], window[same], length[same]
        starts.append(start)
        found.append(window)
    return np.concatenate(starts), np.concatenate(found)


RESULT = "doc_id long, n_words long, spans array<long>, items array<string>"


def _pass(index, carried: bool, keep_text: bool):
    """A pass of the documents over one block of items: adds hit spans and items to those so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("windows", lambda: None)
        own = index.value
        for batch in batches:
            n_words, spans, items = [], [], []
            for p in word_pieces(batch.column(1), LETTER_DIGIT, True):
                n = p.last - p.first
                n_words.extend(np.diff(p.bounds).tolist())
                spans.extend([[]] * n)
                items.extend([[]] * n)
                owner_end = np.repeat(p.bounds[1:], np.diff(p.bounds))
                start, window = find_windows(p.hashes, owner_end, own, p.bounds)
                doc = np.searchsorted(p.bounds, start, "right") - 1
                order = np.lexsort((start, doc))
                for part in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else ():
                    d = int(doc[part[0]])
                    spans[p.first + d] = merged(start[part] - p.bounds[d], start[part] - p.bounds[d] + own.windows.length[window[part]])
                    items[p.first + d] = sorted({own.windows.items[i] for i in own.windows.item[window[part]]})
            if carried:
                for i, (s, more) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                    if s:
                        both = np.array(s + spans[i]).reshape(-1, 2)
                        both = both[np.argsort(both[:, 0], kind="stable")]
                        spans[i], items[i] = merged(both[:, 0], both[:, 1]), sorted({*items[i], *more})
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
            names = ["doc_id", "n_words", "spans", "items"]
            if keep_text:
                columns, names = [batch.column(0), batch.column(1), *columns[2:]], ["doc_id", "text", "spans", "items"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def merged(starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """Union of spans sorted by start, as start, end, start, end ..."""
    reach = np.maximum.accumulate(ends)
    new = np.append(True, starts[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return np.column_stack([starts[first], np.append(reach[first[1:] - 1], reach[-1])]).ravel().tolist()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row of ``docs`` (doc_id, text) against ``benchmark`` (item_id, text).

    ``spans`` lists start and end of the merged word ranges that occurrences of windows cover; ``items``
    the ids, as sorted strings, of items with such windows. Null texts have no words; a null item id is
    the string "null"; items without words match nothing; an item listed twice counts once; repeated
    documents give a row each. Without items every document is clean. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    blocks = max(1, -(-(items.select(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for b in range(blocks):
        rows = items.filter(part == b) if blocks > 1 else items
        windows = cut_windows([(r.item, r.text) for r in rows.collect()], window)
        shingles = windows.shingles()[2]
        sizes = sorted(set(windows.shingle_size().tolist()))
        index = prefix_index(windows, shingle_counts(docs, shingles, sizes) if len(shingles) else {})
        shared = docs.sparkSession.sparkContext.broadcast(index)
        last = b == blocks - 1
        docs = docs.mapInArrow(_pass(shared, b > 0, not last), RESULT if last else "doc_id long, text string, spans array<long>, items array<string>")
        if not last:
            docs = stored(docs, "decontaminate")
    return docs
