"""Exact ranked lexical search with posting lists in geometric blocks.

Documents become short vectors over the queries' terms. A task takes its documents in shards of bounded
size and indexes each: documents are ordered by a sketch of their vectors, so similar ones stand
together, and every term's posting list is cut into blocks along that order. A block's summary is the
coordinatewise maximum of its documents' vectors; its product with a query is never below the score of
a document in the block. Terms are taken from the greatest possible contribution down; a query leaves
the walk when all its remaining terms together cannot reach its 50th best score, and a block is skipped
only if its bound cannot. What is left is scored exactly, so the result is that of scoring everything.

The score to beat is known before the full pass: the same search over one document in ``SEED_PART``
gives it. It decides only what is skipped, never what is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.scratch import stored
from tidegrid.llm.textops import LETTER_DIGIT, release, word_pieces

# Terms of the items that one pass takes, each item's counted; more items make more passes.
BLOCK_TERMS = 1 << 19
SHARD_DOCS, SHARD_ENTRIES = 1 << 14, 1 << 22
BLOCK_POSTINGS = 64
SUMMARY_CELLS = 1 << 21
SKETCH_BITS = 32
SEED_PART = 16


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) of the distinct terms of each item as 64-bit hashes; an item's rows count together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in word_pieces(batch.column(1), LETTER_DIGIT, True):
                owner = pa.array(w.owner() + w.first)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), pa.array(w.hashes.view(np.int64))], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return stored(items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term long").distinct(), "search-items")


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(row, doc_id, n, terms, times) of every document with a term: its length, and its terms of the sorted ``vocabulary`` by number."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for w in word_pieces(batch.column(1), LETTER_DIGIT, True):
                number = np.minimum(np.searchsorted(known, w.hashes), len(known) - 1)
                hit = known[number] == w.hashes
                keys, times = np.unique(w.owner()[hit] * len(known) + number[hit], return_counts=True)
                sizes = np.diff(w.bounds)
                some = np.flatnonzero(sizes)
                ends = np.searchsorted(keys, np.arange(len(sizes) + 1) * len(known))
                lists = pa.array(np.append(ends[some], ends[-1]), pa.int32())  # documents without a term hold none of these
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(some + w.first)), pa.array(sizes[some]),
                     pa.ListArray.from_arrays(lists, pa.array((keys % len(known)).astype(np.int32))),
                     pa.ListArray.from_arrays(lists, pa.array(times.astype(np.int32)))], ["doc_id", "n", "terms", "times"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "search-vectors")


@dataclass
class Queries:
    """Items of one pass: the terms of item i are ``terms[bounds[i]:bounds[i + 1]]``; by term, the items that hold it."""

    bounds: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    documents: int
    words: int

    def __post_init__(self):
        order = np.argsort(self.terms, kind="stable")
        self.holders = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))[order]
        self.held = np.searchsorted(self.terms[order], np.arange(len(self.weights) + 1))

    def of(self, i: int) -> np.ndarray:
        return self.terms[self.bounds[i] : self.bounds[i + 1]]


def _ragged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions of all ranges, one after another."""
    sizes = ends - starts
    last = np.cumsum(sizes)
    return np.repeat(starts - last + sizes, sizes) + np.arange(int(last[-1]) if len(last) else 0)


class Shard:
    """Posting lists of some documents, ordered by similarity and cut into blocks."""

    def __init__(self, rows, ids, bounds, terms, times, lengths, queries: Queries):
        self.queries = queries
        scale = 50 + (50 * lengths * queries.documents) // queries.words
        owner = np.repeat(np.arange(len(rows)), np.diff(bounds))
        times = times.astype(np.int64)
        value = (1_000_000_000 * times) // (1000 * times + 20 * scale[owner])
        order = np.argsort(self._sketch(owner, terms, value, len(rows)), kind="stable")
        entries = _ragged(bounds[:-1][order], bounds[1:][order])
        self.rows, self.ids = rows[order], [ids[i] for i in order.tolist()]
        self.bounds = np.concatenate([[0], np.cumsum(np.diff(bounds)[order])])
        self.terms, self.value = terms[entries].astype(np.int64), value[entries].astype(np.float64)  # whole numbers below 2^53
        by_term = np.argsort(self.terms, kind="stable")
        self.posting = np.repeat(np.arange(len(rows)), np.diff(self.bounds))[by_term]
        self.lists = np.searchsorted(self.terms[by_term], np.arange(len(queries.weights) + 1))
        here = np.flatnonzero(np.diff(self.lists))
        self.most = np.zeros(len(queries.weights))
        if len(here):
            self.most[here] = np.maximum.reduceat(self.value[by_term], self.lists[here])

    def _sketch(self, owner, terms, value, n) -> np.ndarray:
        """Signs of fixed random projections of the weighted vectors, as one number per document."""
        weighted = self.queries.weights[terms] * value
        bits, code = np.random.default_rng(7).integers(0, 1 << SKETCH_BITS, len(self.queries.weights)), np.zeros(n, np.int64)
        for b in range(SKETCH_BITS):
            sign = np.where(bits[terms] >> b & 1, 1.0, -1.0)
            code = code * 2 + (np.bincount(owner, weighted * sign, n) > 0)
        return code

    def summary(self, term: int, columns: np.ndarray) -> np.ndarray:
        """Greatest value of each of ``columns`` in each block of the term's posting list."""
        docs = self.posting[self.lists[term] : self.lists[term + 1]]
        at = np.full(len(self.queries.weights), -1)
        at[columns] = np.arange(len(columns))
        block = np.repeat(np.arange(len(docs)) // BLOCK_POSTINGS, np.diff(self.bounds)[docs])
        entries = _ragged(self.bounds[docs], self.bounds[docs + 1])
        column = at[self.terms[entries]]
        keep = column >= 0
        out = np.zeros((-(-len(docs) // BLOCK_POSTINGS), len(columns)))
        np.maximum.at(out, (block[keep], column[keep]), self.value[entries][keep])
        return out

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of documents; ``weights`` is the query over all terms."""
        entries = _ragged(self.bounds[docs], self.bounds[docs + 1])
        owner = np.repeat(np.arange(len(docs)), np.diff(self.bounds)[docs])
        return np.bincount(owner, weights[self.terms[entries]] * self.value[entries], len(docs))

    def search(self, top: Top) -> int:
        """Offer every document that may be among the best of an item; the number of scored ones."""
        q, scored = self.queries, 0
        reach = q.weights * self.most
        left = np.add.reduceat(np.append(reach[q.terms], 0), q.bounds[:-1]) if len(q.bounds) > 1 else np.zeros(0)
        left[np.diff(q.bounds) == 0] = 0
        for term in np.argsort(-reach, kind="stable").tolist():
            if reach[term] <= 0:
                break
            items = q.holders[q.held[term] : q.held[term + 1]]
            # sums are in floating point, but of whole numbers below 2^53: exact
            active = items[left[items] >= np.maximum(top.least[items], 1)]
            docs = self.posting[self.lists[term] : self.lists[term + 1]]
            blocks = -(-len(docs) // BLOCK_POSTINGS)
            at = 0
            while at < len(active):
                widths = np.cumsum([len(q.of(i)) for i in active[at : at + 4096]])
                n = max(1, int(np.searchsorted(widths * blocks, SUMMARY_CELLS, "right")))
                scored += self._visit(term, docs, active[at : at + n], top)
                at += n
            left[items] -= reach[term]
        return scored

    def _visit(self, term: int, docs: np.ndarray, items: np.ndarray, top: Top) -> int:
        q, scored = self.queries, 0
        columns = np.unique(np.concatenate([q.of(i) for i in items]))
        summary = self.summary(term, columns)
        weights = np.zeros(len(q.weights))
        for i in items.tolist():
            own = q.of(i)
            bound = summary[:, np.searchsorted(columns, own)] @ q.weights[own]
            live = bound >= max(top.least[i], 1)
            if live.any():
                found = docs[np.repeat(live, BLOCK_POSTINGS)[: len(docs)]]
                weights[own] = q.weights[own]
                top.offer(i, self, found, self.scores(found, weights))
                weights[own] = 0
                scored += len(found)
        return scored


class Top:
    """The best documents of each item so far, and the score that another one must reach."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least, self.best = k, least.astype(np.float64), [{} for _ in least]

    def offer(self, item: int, shard: Shard, docs: np.ndarray, scores: np.ndarray) -> None:
        best = self.best[item]
        for d in np.flatnonzero(scores >= max(self.least[item], 1)).tolist():
            id_, row = shard.ids[docs[d]], int(shard.rows[docs[d]])
            best[row] = (-int(scores[d]), id_ is None, id_ or 0, row)
        if len(best) >= self.k:
            kept = sorted(best.values())[: self.k]
            self.best[item] = {x[3]: x for x in kept}
            self.least[item] = max(self.least[item], -kept[-1][0])

    def rows(self) -> pa.RecordBatch:
        flat = [(i, None if x[1] else x[2], -x[0], x[3]) for i, best in enumerate(self.best) for x in best.values()]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*flat)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["item", "doc_id", "score", "row"])


def shards(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[Shard]:
    """Shards of a stream of (row, doc_id, n, terms, times)."""
    held: list[pa.RecordBatch] = []
    docs = entries = 0

    def made() -> Shard:
        t = pa.Table.from_batches(held).combine_chunks()
        terms = t["terms"].combine_chunks()
        bounds = terms.offsets.to_numpy().astype(np.int64)
        return Shard(t["row"].to_numpy(), t["doc_id"].to_pylist(), bounds - bounds[0], terms.flatten().to_numpy(), t["times"].combine_chunks().flatten().to_numpy(), t["n"].to_numpy(), queries)

    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            held.append(batch.slice(lo, 4096))
            docs, entries = docs + held[-1].num_rows, entries + len(held[-1].column(3).flatten())
            if docs >= SHARD_DOCS or entries >= SHARD_ENTRIES:
                yield made()
                held, docs, entries = [], 0, 0
    if docs:
        yield made()


def search(found: DataFrame, queries: Queries, k: int, least: np.ndarray) -> DataFrame:
    """(item, rank, doc_id, score) of the ``k`` best documents of each item; ``least`` holds scores that are known to be reached ``k`` times."""
    shared = found.sparkSession.sparkContext.broadcast((queries, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, floor = shared.value
        top = Top(k, floor)
        for shard in shards(batches, own):
            shard.search(top)
        yield top.rows()
        release()

    best = found.select("row", "doc_id", "n", "terms", "times").mapInArrow(run, "item int, doc_id long, score long, row long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def _one_pass(docs: DataFrame, wanted: list, k: int) -> DataFrame:
    """Ranked documents of the items in ``wanted``, rows of (item_id, term) sorted by item."""
    spark = docs.sparkSession
    hashes = np.array([r.term for r in wanted], np.int64).view(np.uint64)
    vocabulary, terms = np.unique(hashes, return_inverse=True)
    starts = [i for i, r in enumerate(wanted) if i == 0 or r.item_id != wanted[i - 1].item_id]
    found = vectors(docs, vocabulary)
    size = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    held = np.zeros(len(vocabulary), np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():  # a row per term of the pass
        held[r.t] = r.df
    weights = np.array([math.floor(1000 * math.log((2 * size.n + 2) / (2 * int(df) + 1))) for df in held], np.float64)
    queries = Queries(np.array([*starts, len(wanted)]), terms, weights, int(size.n), max(int(size.words), 1))
    least = np.zeros(len(starts))
    seeds = search(found.filter(F.pmod(F.xxhash64("row"), F.lit(SEED_PART)) == 0), queries, k, least)
    for r in seeds.filter(F.col("rank") == k).collect():  # a row per item of the pass
        least[r.item] = r.score
    names = spark.createDataFrame([(i, wanted[s].item_id) for i, s in enumerate(starts)], f"item int, item_id {_kind(wanted)}")
    return search(found, queries, k, least).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _kind(wanted: list) -> str:
    return "string" if any(isinstance(r.item_id, str) for r in wanted) else "long"


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of each item, among all ``docs`` (doc_id, text).

    Terms are runs of ASCII letters, digits and characters outside ASCII, A-Z in lower case. An item's
    terms count once each; rows of one item_id (also null) make one item, and items without terms give no
    rows. Only documents with a score above 0 are ranked; equal scores rank by doc_id, null last, and
    repeated rows count as documents of their own. Null and empty texts have no terms and are no
    documents. An empty table of either kind gives no rows. Very long documents are read whole. Items
    come in passes of about ``BLOCK_TERMS`` terms, so what is broadcast is bounded whatever the items'
    number; one item makes one pass at least, whatever its length. Other columns are not read.
    """
    wanted = item_terms(items)
    total = wanted.count()
    kind = items.schema["item_id"].dataType.simpleString()
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    passes = -(-total // BLOCK_TERMS)
    share = F.pmod(F.xxhash64("item_id"), F.lit(max(passes, 1)))
    for i in range(passes):
        block = wanted.filter(share == i).orderBy("item_id", "term").collect()
        if block:
            found = _one_pass(docs, block, k).withColumn("item_id", F.col("item_id").cast(kind))
            out = found if passes == 1 else out.unionByName(stored(found, "search-pass"))
    return out
