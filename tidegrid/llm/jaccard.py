"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection.

1. Every document becomes a set of hashed shingles. Documents with equal sets form a class.
2. Sets that may link have similar sizes, so sizes are cut into bands, and the differences between two
   linked sets of a band are at most d. The hash range is cut into d + 1 parts; by the pigeonhole
   principle two linked sets agree on a whole part. A tile is the classes of a band that agree on one
   part. Nearly all tiles hold one class and go.
3. Within tiles, bitmaps of the sets bound the overlap from above: the bits in which two bitmaps
   differ are at most the elements in which the sets differ.
4. Pairs that pass are settled by intersecting the sorted arrays.

Tiles of many copies would give quadratically many pairs. So a tile has a leader, the class with the
largest tiles, and first each class is compared with only one leader, the one with which it shares most
tiles. Then components are taken, and a second round compares, in blocks of bounded size, only classes
of a tile that are still in different components. Every pair of a tile is so either compared or
already connected: components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.components import components
from tidegrid.llm.scratch import checked, stored
from tidegrid.llm.textops import NOT_SPACE, hash_windows, kept, mix, word_pieces

# Salts of the two set hashes, of the parts and of the bitmaps.
SALTS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x3C6EF372FE94F82B, 0x510E527FADE682D1)
BAND_RATIO = 1.5
LEAST_BITS = 1024  # of a bitmap; a larger set has two bits for each element at least
TILE_ROWS = 1024
GROUP_BYTES = 8 << 20  # of bitmaps and ids that are compared in one call


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, lower-cased; a text of fewer than k words is one shingle."""
    kept("shingles", lambda: None)
    for p in word_pieces(column, NOT_SPACE, True):
        windows = hash_windows(p.hashes, k)
        for lo, hi in zip(p.bounds[:-1], p.bounds[1:]):
            own = windows[lo : hi - k + 1].copy() if hi - lo >= k else hash_windows(p.hashes[lo:hi], int(hi - lo)) if hi > lo else windows[:0]
            own.sort()
            yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    return mix(s, SALTS[0]).sum(dtype=np.uint64), mix(s, SALTS[1]).sum(dtype=np.uint64)


class Bands:
    """Bands of set sizes, and the tiles' parts for a similarity of ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent, self.lower, self.cuts = percent, [1], {}

    def tiles(self, n: int) -> list[int]:
        """Bands in which a set of n is compared: its own as the larger one, further ones as the smaller one."""
        while self.lower[-1] * self.percent <= 100 * n or self.lower[-1] <= n:
            self.lower.append(max(self.lower[-1] + 1, int(np.ceil(self.lower[-1] * BAND_RATIO))))
        own = int(np.searchsorted(self.lower, n, "right")) - 1
        last = own
        while 100 * n >= self.percent * self.lower[last + 1]:
            last += 1
            if last + 1 == len(self.lower):
                self.lower.append(max(self.lower[-1] + 1, int(np.ceil(self.lower[-1] * BAND_RATIO))))
        return list(range(own, last + 1))

    def parts(self, band: int) -> np.ndarray:
        """Upper ends of all but the last part of the hash range."""
        if band not in self.cuts:
            if band + 1 == len(self.lower):
                self.lower.append(max(self.lower[-1] + 1, int(np.ceil(self.lower[-1] * BAND_RATIO))))
            largest = self.lower[band + 1] - 1
            n = 2 * largest * (100 - self.percent) // (100 + self.percent) + 1
            self.cuts[band] = np.array([(j << 64) // n for j in range(1, n)], np.uint64)
        return self.cuts[band]

    def signatures(self, s: np.ndarray) -> np.ndarray:
        """One hash per band and part. Two linked sets of a band have one in common.

        That two parts are both empty says little, so an empty part is joined with the part after it,
        as it is and with each element left out: if linked sets agree on empty parts only, at least one
        of those is followed by a part with a single difference, or by another one of them.
        """
        mixed = mix(s, SALTS[2])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        out = []
        for band in self.tiles(len(s)):
            cuts = self.parts(band)
            ends = np.concatenate([[0], np.searchsorted(s, cuts), [len(s)]])
            part = mix(np.arange(len(cuts) + 1, dtype=np.uint64) + np.uint64(band << 40), SALTS[3])
            content = sums[ends[1:]] - sums[ends[:-1]]
            empty = ends[1:] == ends[:-1]
            out.append(mix(mix(content[~empty]) ^ part[~empty]))
            for j in np.flatnonzero(empty):
                after = (j + 1) % len(part)
                variants = content[after] - np.append(mixed[ends[after] : ends[after + 1]], np.uint64(0))
                out.append(mix(mix(variants, SALTS[1]) ^ part[j]))
        return np.concatenate(out)


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bitmap: a bit is the number of its elements modulo 2, so equal elements cancel out."""
    width = max(LEAST_BITS, 1 << (2 * len(s) - 1).bit_length())
    at = (mix(s, SALTS[3]) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=width) & 1, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, longs: int) -> np.ndarray:
    """A bitmap as it would be with fewer bits: parities of places that fall together add up."""
    return np.bitwise_xor.reduce(bits.reshape(-1, longs), axis=0)


def may_link(n: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` elements together may link if they differ in ``differ`` elements at least."""
    return (100 + percent) * (n - differ) >= 2 * percent * n


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(s), *fingerprint(s)) for s in shingle_sets(batch.column(2), k)]
            n, f, g = zip(*sets) if sets else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), _signed(f), _signed(g)], ["doc_id", "row", "n", "f", "g"])

    return run


def _signatures(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, signs, members, held = Bands(percent), [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays([_signed(np.concatenate(signs)), _signed(np.concatenate(members))], ["sig", "f"])

        for batch in batches:
            for s in shingle_sets(batch.column(0), k):
                if len(s):
                    signs.append(bands.signatures(s))
                    members.append(np.full(len(signs[-1]), fingerprint(s)[0], np.uint64))
                    held += len(signs[-1])
                    if held > 100_000:
                        yield flush()
                        signs, members, held = [], [], 0
        if held:
            yield flush()

    return run


def _bitmaps(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(fingerprint(s)[0], len(s), bitmap(s).tobytes()) for s in shingle_sets(batch.column(0), k) if len(s)]
            f, n, bits = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([_signed(f), pa.array(n, pa.int64()), pa.array(bits, pa.binary())], ["f", "n", "bits"])

    return run


def _elements(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(fingerprint(s)[0], s.tobytes()) for s in shingle_sets(batch.column(0), k) if len(s)]
            f, elements = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([_signed(f), pa.array(elements, pa.binary())], ["f", "elements"])

    return run


def _bounded(percent: int):
    """Pairs that the bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            differ = np.zeros(len(n), np.int64)
            for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                longs = min(len(x), len(y))
                differ[i] = np.bitwise_count(folded(x, longs) ^ folded(y, longs)).sum(dtype=np.int64)
            keep = pa.array(may_link(n, differ, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return run


def _intersect(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return run


def verified(pairs: DataFrame, bitmaps: DataFrame, elements, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link: first by the bitmaps' bound, then by intersection.

    ``elements`` gives (f, elements) for a table of members f; only sets of pairs that pass are made.
    """
    x = bitmaps.select(F.col("f").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xb"))
    y = bitmaps.select(F.col("f").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("yb"))
    near = pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "xb", "yb").mapInArrow(_bounded(percent), "a long, b long")
    passed = checked(stored(near, "passed"))  # small beside the sets, which then need not move
    sets = elements(passed.select(F.explode(F.array("a", "b")).alias("f")).distinct())
    sides = [sets.join(passed.withColumn("f", F.col(side)), "f").select("a", "b", F.col("elements").alias(name)) for side, name in (("a", "x"), ("b", "y"))]
    rows = sides[0].join(sides[1], ["a", "b"]).select("a", "b", "x", "y")
    return stored(rows.mapInArrow(_intersect(percent), "a long, b long"), "links")


def _compare(percent: int):
    """Pairs of a group of tiles that are in different components and pass the bitmaps' bound."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["sig", "i", "j", "part"], kind="stable")
        key = rows[["sig", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        f, n, label, part = (rows[c].to_numpy() for c in ("f", "n", "label", "part"))
        bitmaps = [np.frombuffer(x, np.uint64) for x in rows["bits"]]
        left, right = [], []
        for lo, hi in zip(starts, np.append(starts[1:], len(rows))):
            same = part[lo] == part[hi - 1]
            longs = min(len(x) for x in bitmaps[lo:hi])
            bits = np.stack([folded(x, longs) for x in bitmaps[lo:hi]])
            middle = hi if same else lo + int(np.searchsorted(part[lo:hi], part[hi - 1]))
            for u in range(lo, middle):
                v = np.arange(u + 1 if same else middle, hi)
                v = v[label[v] != label[u]]
                differ = np.bitwise_count(bits[v - lo] ^ bits[u - lo]).sum(axis=1, dtype=np.int64)
                v = v[may_link(n[v] + n[u], differ, percent)]
                left.append(np.full(len(v), f[u]))
                right.append(f[v])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def unresolved_members(tiles: DataFrame, labels: DataFrame, bitmaps: DataFrame, group_bytes: int | None = None) -> DataFrame:
    """Members of pairs of blocks (sig, i, j) that are still apart, dealt to groups of about ``GROUP_BYTES``.

    Tiles are cut into blocks of ``TILE_ROWS`` by label; pairs of blocks of one single label are skipped. A
    block is in a group once for each of its pairs, and counts as often.
    """
    rows = tiles.join(labels.withColumnRenamed("node", "f"), "f", "left").withColumn("label", F.coalesce("root", "f")).drop("root")
    mixed = rows.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("sig")
    place = F.row_number().over(Window.partitionBy("sig").orderBy("label", "f")) - 1
    rows = stored(rows.join(mixed, "sig", "left_semi").withColumn("part", F.floor(place / TILE_ROWS).cast("int")), "tiles")
    parts = rows.groupBy("sig", "part").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    second = parts.select("sig", F.col("part").alias("j"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    blocks = parts.withColumnRenamed("part", "i").join(second, "sig").filter("i <= j AND NOT (lo = hi AND lo2 = hi2 AND lo = lo2)").select("sig", "i", "j")
    sides = blocks.withColumn("part", F.explode(F.array_distinct(F.array("i", "j"))))
    members = rows.join(sides, ["sig", "part"]).join(bitmaps, "f")
    held = rows.join(bitmaps, "f").groupBy("sig", "part").agg(F.sum(F.octet_length("bits") + 64).alias("bytes"))
    size = sides.join(held, ["sig", "part"]).select(F.sum("bytes")).first()[0] or 0
    groups = max(1, -(-size // (group_bytes or GROUP_BYTES)))
    return members.withColumn("group", F.pmod(F.xxhash64("sig", "i", "j"), F.lit(groups)))


def unresolved_pairs(tiles: DataFrame, labels: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Pairs of tiles' members with different labels that the bitmaps do not rule out."""
    members = unresolved_members(tiles, labels, bitmaps)
    return members.groupBy("group").applyInPandas(_compare(percent), "a long, b long").distinct()


def _once(rows: DataFrame) -> DataFrame:
    """One row per member; only tables with repeated rows of one id and text have more."""
    repeated = rows.groupBy("f").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    return rows if repeated.isEmpty() else rows.dropDuplicates(["f"])


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Sets are the distinct shingles of ``k`` words, lower-cased in A-Z; two documents link when
    100 * intersection >= ``percent`` * union. ``component_id`` is the smallest doc_id reachable by
    links, itself included. A text of fewer than k words is one shingle; null texts and texts without
    words have none, link with nothing and are their own component. Repeated rows and ids give a row
    each; a component without any id has a null one. An empty table gives no rows. Other columns are
    not read. Shingles and classes are identified by 64-bit hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row", F.xxhash64("doc_id", "text"))
    sketches = stored(docs.select("doc_id", "row", "text").mapInArrow(
        _sketch(k), "doc_id long, row long, n long, f long, g long"), "sketches")
    classes = stored(sketches.filter("n > 0").groupBy("f", "g", "n").agg(
        F.min("row").alias("first_row"), F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies")), "classes")
    repeated = classes.filter("copies > 1").select("f", "first_row")
    others = stored(sketches.join(checked(repeated), "f").filter("row != first_row").select("row").distinct(), "copies")

    # tiles with several classes; of tiles with the same members, one
    signs = docs.join(checked(others), "row", "left_anti").select("text").mapInArrow(_signatures(k, percent), "sig long, f long")
    tile = Window.partitionBy("sig")
    tiles = signs.withColumns({
        "m": F.count(F.lit(1)).over(tile), "x": F.bit_xor(F.xxhash64("f")).over(tile), "y": F.bit_xor(F.xxhash64("f", F.lit(1))).over(tile)})
    tiles = stored(tiles.filter("m > 1"), "tiles")
    unlike = tiles.select("sig", "m", "x", "y").groupBy("m", "x", "y").agg(F.min("sig").alias("sig")).select("sig")
    tiles = stored(tiles.join(unlike, "sig", "left_semi").select("sig", "f", "m"), "tiles")

    wanted = stored(classes.join(tiles.select("f").distinct(), "f", "left_semi").select(F.col("first_row").alias("row")), "members")
    texts = docs.join(checked(wanted), "row", "left_semi").select("text")
    bitmaps = _once(stored(texts.mapInArrow(_bitmaps(k), "f long, n long, bits binary"), "bitmaps"))

    def elements(members: DataFrame) -> DataFrame:
        rows = stored(classes.join(members, "f", "left_semi").select(F.col("first_row").alias("row")), "members")
        own = docs.join(checked(rows), "row", "left_semi").select("text").mapInArrow(_elements(k), "f long, elements binary")
        return _once(stored(own, "elements"))

    weights = tiles.groupBy("f").agg(F.sum("m").alias("w"))
    leaders = tiles.join(weights, "f").groupBy("sig").agg(F.max_by("f", F.struct("w", "f")).alias("leader"))
    shared = tiles.join(leaders, "sig").filter("f != leader").groupBy("f", "leader").agg(F.count(F.lit(1)).alias("c"))
    star = shared.groupBy("f").agg(F.max_by("leader", F.struct("c", "leader")).alias("leader"))
    star = stored(star.select(F.least("f", "leader").alias("a"), F.greatest("f", "leader").alias("b")).distinct(), "star")
    links = verified(star, bitmaps, elements, percent)
    labels = stored(components(links), "labels")
    rest = unresolved_pairs(tiles.select("sig", "f"), labels, bitmaps, percent)
    more = verified(rest.join(star, ["a", "b"], "left_anti"), bitmaps, elements, percent)
    if not more.isEmpty():
        labels = stored(components(links.union(more)), "labels")

    named = classes.select("f", "first_doc").join(labels.withColumnRenamed("node", "f"), "f")
    firsts = named.groupBy("root").agg(F.min("first_doc").alias("component"))
    linked = named.join(firsts, "root").select("f", "component")
    own = classes.select("f", "g", "n", "first_doc").join(linked, "f", "left").select(
        "f", "g", "n", F.coalesce("component", "first_doc").alias("component"))
    rows = sketches.filter("n > 0").join(own, ["f", "g", "n"]).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    return rows.union(sketches.filter("n = 0").select("doc_id", "n", "doc_id"))
