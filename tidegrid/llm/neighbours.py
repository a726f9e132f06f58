"""Nearest neighbours by multi-index hashing of learned binary codes, reranked by float vectors.

Codes are the signs of vectors under learned rotations (iterative quantization on a bounded sample). A
code is split into substrings, and every substring has an index. Two codes within a Hamming radius
agree on at least one substring up to its share of the radius (pigeonhole), so probing each index
within that share finds every code in the radius. For each query and block of rows the radius grows
until enough rows lie in it; all rows in the radius are reranked by the exact inner product.

Rows and queries are dealt into blocks of bounded size, and each pair of blocks is one task's group.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 4096  # rows that the rotations are learned on (lowest hash)
ROTATIONS, STEPS = 4, 20
SUBSTRING_BITS = 16
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024
# The radius begins at two fifths of the bits and is wide enough for a block of rows once this share of
# them (and four times k) lie in it; all of them are reranked.
ENOUGH = 0.03


def learn_rotations(sample: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) with ``ROTATIONS`` rotations side by side, each by iterative quantization."""
    rng, mean = np.random.default_rng(seed), sample.mean(axis=0)
    centred, dim, parts = sample - mean, sample.shape[1], []
    for _ in range(ROTATIONS):
        turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        for _ in range(STEPS):
            u, _, v = np.linalg.svd(np.sign(centred @ turn).T @ centred)
            turn = (u @ v).T
        parts.append(turn)
    return mean, np.concatenate(parts, axis=1)


def encode(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes as rows of 16-bit substrings, padded with zero bits."""
    bits = (vectors - mean) @ projection > 0
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint16)


@lru_cache(maxsize=None)
def flips(distance: int) -> np.ndarray:
    """All differences of a substring with exactly ``distance`` bits."""
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(SUBSTRING_BITS), distance)], np.uint16)


@dataclass
class MultiIndex:
    """An index per substring: rows sorted by its value."""

    codes: np.ndarray

    def __post_init__(self):
        self.whole = self.codes.view(np.uint64)
        self.order = [np.argsort(c, kind="stable") for c in self.codes.T]
        self.sorted = [c[o] for c, o in zip(self.codes.T, self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code differs from ``code`` in at most ``radius`` bits."""
        number = self.codes.shape[1]
        found = np.zeros(len(self.codes), bool)
        for j in range(number):
            # shares of the radius: if every substring exceeded its own, the sum would exceed the radius
            share = (radius - j) // number
            if share < 0:
                continue
            if sum(len(flips(d)) for d in range(min(share, 4) + 1)) < len(self.codes) and share <= 4:
                values = np.concatenate([flips(d) for d in range(share + 1)]) ^ code[j]
                lo, hi = np.searchsorted(self.sorted[j], values, "left"), np.searchsorted(self.sorted[j], values, "right")
                for a, b in zip(lo[hi > lo], hi[hi > lo]):
                    found[self.order[j][a:b]] = True
            else:  # more values than rows: read the index through
                found[self.order[j][np.bitwise_count(self.sorted[j] ^ code[j]) <= share]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.whole[rows] ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64) <= radius]


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _search(model, k: int):
    """The ``k`` best rows of a block for each query id of a block; ``asked`` holds an id's different vectors in a row."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], []]
        if rows.num_rows and queries.num_rows:
            mean, projection = model.value
            ids, vectors = rows.column("vec_id").to_numpy(), _matrix(rows.column("vector"))
            asked, wanted = queries.column("vec_id").to_numpy(), _matrix(queries.column("vector"))
            index, codes = MultiIndex(encode(vectors, mean, projection)), encode(wanted, mean, projection)
            enough = min(len(ids), max(4 * k + 1, int(ENOUGH * len(ids))))
            least, step = projection.shape[1] * 2 // 5, max(1, projection.shape[1] // 42)
            order = np.argsort(asked, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(asked[order])) + 1):
                q, top = asked[own[0]], (np.zeros(0, np.int64), np.zeros(0))
                others = ids != q
                wide = min(int(others.sum()), enough)
                for code, vector in zip(codes[own], wanted[own]):
                    radius = least
                    near = index.within(code, radius)
                    while others[near].sum() < wide:  # rows of the query's id do not count
                        radius += step
                        near = index.within(code, radius)
                    near = near[others[near]]
                    near, scores = np.append(top[0], near), np.append(top[1], (vectors[near] * vector).sum(axis=1))
                    best = np.lexsort((ids[near], -scores))
                    best = best[np.sort(np.unique(near[best], return_index=True)[1])][:k]  # a row once, with its best score
                    top = near[best], scores[best]
                out[0].append(np.full(len(top[0]), q))
                out[1].append(ids[top[0]])
                out[2].append(top[1])
        columns = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table({"query_id": pa.array(columns[0].astype(np.int64)), "vec_id": pa.array(columns[1].astype(np.int64)), "score": pa.array(columns[2].astype(np.float64))})

    return run


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, not all zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows nearest to each row whose vec_id is divisible by ``every``.

    ``vectors`` has vec_id and embedding. Nearness is the inner product in double precision, ties go
    to the smaller vec_id; rows with the query's id are no candidates. Null ids, vectors that are null,
    zero or hold null or non-finite components, and vectors of another than the most common length take
    no part. If there are fewer than k candidates, all are returned; an empty table gives no rows.
    Rows with one id are candidates each; as queries they are one, with the nearest to any of them: a
    candidate row counts once, with its best score.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q"))
    most = lengths.orderBy(F.desc("n"), "d").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vector") == most.d)
    sample = rows.orderBy(F.xxhash64("vec_id", "vector")).limit(SAMPLE).select("vector").toArrow()
    model = spark.sparkContext.broadcast(learn_rotations(_matrix(sample.column("vector"))))

    row_blocks, query_blocks = -(-most.n // BLOCK_ROWS), max(1, -(-most.q // BLOCK_QUERIES))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    base = rows.withColumns({"r": dealt(row_blocks), "q": every_block(query_blocks)})
    asked = rows.filter(F.col("vec_id") % every == 0).distinct().withColumns({"q": dealt(query_blocks), "r": every_block(row_blocks)})
    found = base.groupBy("r", "q").cogroup(asked.groupBy("r", "q")).applyInArrow(_search(model, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
