"""Exact medians over a mapping in packs, without its pairs.

Targets are cut into areas along a space-filling curve. Values are reduced to a row for each record and pack of
sources and sent to the areas that the pack is within reach of, as are the pack's positions, once. A task holds an
area's targets and positions and takes its records in order, some at a time, finds the pairs of a run of targets
and picks the middle of their values. What is moved grows with the values, not with the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.operators.mapping import _AXES, _SLACK_M, PAIRS_AT_ONCE, Packs
from tidegrid.sizing import affordable_salts, bounded_broadcast, spread_join

# Values, and numbers kept for each source of an area, of the records that a task takes at once.
HELD_AT_ONCE = 1 << 22
# Pairs that are compared at once: arrays that stay in a processor's cache.
COMPARED_AT_ONCE = 1 << 19
# Rows that are given back at once.
ROWS_AT_ONCE = 1 << 16
# Values of a source that are taken one after the other; any others are taken together.
LAYERS = 8
# Kinds of rows that a task reads, in this order for each area.
TILE, SOURCES, VALUES = range(3)


class _Record:
    """Values of one record in an area: those of source i are at ``begin[i]`` and the ``count[i] - 1`` places after it."""

    def __init__(self, key: pa.Array, source: np.ndarray, value: np.ndarray, missing: np.ndarray, n: int):
        self.key, self.missing = key, None
        if len(missing):
            self.missing = np.zeros(n, bool)
            self.missing[missing] = True
        self.count = np.bincount(source, minlength=n)
        self.begin = np.cumsum(self.count) - self.count
        self.layers = int(self.count.max(initial=0))
        order = np.argsort(value)  # NaN comes last, as in a sorted column
        place = np.empty(len(value), np.int64)
        place[order] = np.arange(len(value))
        self.sorted, self.place = value[order], place[np.argsort(source, kind="stable")]

    def middles(self, target: np.ndarray, source: np.ndarray, n: int, strict: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(target, median, whether there is one) of those of ``n`` targets that are paired with any of the record's rows."""
        if n > 1 and int(self.count[source].sum()) > 4 * PAIRS_AT_ONCE:  # sources with many values
            half = n // 2
            for first, own, size in ((0, target < half, half), (half, target >= half, n - half)):
                for found, middle, there in self.middles(target[own] - first, source[own], size, strict):
                    yield found + first, middle, there
            return
        lost = np.zeros(n, bool)
        if self.missing is not None:
            lost[target[self.missing[source]]] = True
            if strict:
                whole = ~lost[target]
                target, source = target[whole], source[whole]
        bits = max(1, len(self.sorted).bit_length())
        kind = np.uint32 if n << bits <= 1 << 32 else np.uint64
        pieces = [np.empty(0, kind)]
        owner = target.astype(kind) << kind(bits)
        for nth in range(min(self.layers, LAYERS + 1)):
            more = np.flatnonzero(self.count[source] > nth)
            owner, source = owner[more], source[more]
            mine, at = owner, self.begin[source] + nth
            if nth == LAYERS:  # all others at once
                each = self.count[source] - nth
                mine, at = np.repeat(owner, each), np.repeat(at - (np.cumsum(each) - each), each) + np.arange(each.sum())
            pieces.append(mine | self.place[at].astype(kind))
        # by target, then by the place of the value among all of the record's
        ranked = np.sort(np.concatenate(pieces))
        ends = np.searchsorted(ranked >> kind(bits), np.arange(n + 1, dtype=kind))
        first, sizes = ends[:-1], np.diff(ends)
        there = sizes > 0
        low, high = (self.sorted[(ranked[(first + k)[there]] & kind((1 << bits) - 1)).astype(np.int64)] for k in ((sizes - 1) // 2, sizes // 2))
        middle = np.zeros(n)
        with np.errstate(invalid="ignore"):
            middle[there] = np.where(low == high, low, low * 0.5 + high * 0.5)
        found = np.flatnonzero(there | lost)
        yield found, middle[found], there[found]


class _Area:
    """An area's targets and the packs of sources in reach of it."""

    def __init__(self) -> None:
        self.tiles: list[tuple[pa.StructArray, pa.Array]] = []
        self.packs: dict[int, int] = {}
        self.positions: list[dict[str, np.ndarray]] = []
        self.n = 0

    def add(self, pack: int, at: dict[str, np.ndarray]) -> None:
        self.packs[pack] = self.n
        self.positions.append(at)
        self.n += len(at["x"])

    def pairs(self, t: pa.StructArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first, last, target, source) of the pairs within the targets' radii, for a run of targets at a time, in no order."""
        own = {c: t.field(c).to_numpy(zero_copy_only=False) for c in (*_AXES, "r")}
        gap = 0.0
        for c in _AXES:
            low, high = (np.array([f(p[c]) for p in self.positions]) for f in (np.min, np.max))
            gap = gap + np.maximum(np.maximum(low - own[c][:, None], own[c][:, None] - high), 0.0) ** 2
        inside = np.sqrt(gap) <= own["r"][:, None] + 2 * _SLACK_M
        ends, first = np.cumsum(inside @ np.array([len(p["x"]) for p in self.positions])), 0
        starts = list(self.packs.values())
        while first < len(t):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + COMPARED_AT_ONCE, "right")))
            target, source = [], []
            for p in np.flatnonzero(inside[first:last].any(axis=0)):
                near = np.flatnonzero(inside[first:last, p])
                dx, dy, dz = (own[c][near + first][:, None] - self.positions[p][c] for c in _AXES)
                dist = np.rint(np.sqrt(dx * dx + dy * dy + dz * dz) * 1000) / 1000  # as near_positions
                a, b = np.nonzero(dist <= own["r"][near + first][:, None])
                target.append(near[a])
                source.append(b + starts[p])
            if target:
                yield first, last, np.concatenate(target), np.concatenate(source)
            first = last

    def medians(self, records: list[_Record], strict: bool) -> Iterator[pa.RecordBatch]:
        keys = pa.concat_arrays([r.key for r in records])
        for t, cells in self.tiles:
            out: list[tuple[np.ndarray, ...]] = []
            for first, last, target, source in self.pairs(t):
                for r, record in enumerate(records):
                    for found, middle, there in record.middles(target, source, last - first, strict):
                        out.append((np.full(len(found), r), found + first, middle, ~there))
                if sum(len(o[0]) for o in out) >= ROWS_AT_ONCE:
                    yield _rows(keys, cells, out)
                    out = []
            if out:
                yield _rows(keys, cells, out)


def _rows(keys: pa.Array, cells: pa.Array, out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    r, cell, middle, gone = (np.concatenate(c) for c in zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([keys.take(pa.array(r)), cells.take(pa.array(cell)), pa.array(middle, mask=gone)], ["k", "cell_id", "v"])


def _in_order(strict: bool):
    """Medians of rows sorted by area, kind and record, for ``mapInArrow``."""

    def arrays(batch: pa.RecordBatch, i: int, *names: str) -> list[np.ndarray]:
        return [batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        area, no, records, held = _Area(), None, [], 0
        key, named, parts = None, None, []

        def close() -> None:
            """The record that was read last is complete."""
            nonlocal parts, held
            if parts:
                source, value, missing = (np.concatenate(c) for c in zip(*parts, strict=True))
                records.append(_Record(key, source, value, missing, area.n))
                held, parts = held + len(value) + area.n, []

        for batch in batches:
            numbers, kinds, packs = (batch.column(c).to_pylist() for c in ("area", "kind", "pack"))
            for i, (number, kind, pack) in enumerate(zip(numbers, kinds, packs, strict=True)):
                name = repr(batch.column("k")[i].as_py()) if kind == VALUES else None
                if number != no or name != named:
                    close()
                    if records and (number != no or held >= HELD_AT_ONCE):
                        yield from area.medians(records, strict)
                        records, held = [], 0
                    if number != no:
                        area, no = _Area(), number
                    key, named = batch.column("k").slice(i, 1), name
                if kind == TILE:
                    t = pa.StructArray.from_arrays([batch.column(c)[i].values for c in (*_AXES, "r")], [*_AXES, "r"])
                    area.tiles.append((t, batch.column("cells")[i].values))
                elif kind == SOURCES:
                    area.add(pack, dict(zip(_AXES, (a.copy() for a in arrays(batch, i, *_AXES)), strict=True)))
                else:
                    places, values, missing = arrays(batch, i, "places", "values", "missing")
                    parts.append((places.astype(np.int64) + area.packs[pack], values.copy(), missing.astype(np.int64) + area.packs[pack]))
        close()
        if records:
            yield from area.medians(records, strict)

    return run


def median_over_packs(obs: DataFrame, packs: Packs, cells: DataFrame, keys: Sequence[str], value: str, strict: bool, broadcast_limit: int) -> DataFrame:
    """Median per (record keys, target cell) of the sources in its radius; ``cells`` has one row per target.

    Missing values are left out; with ``strict`` one of them makes the median missing. Each observation of a source
    counts, and targets whose sources have none do not come out.
    """
    tiles, near, n = packs.areas(cells)
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    seen = obs.select(key.alias("k"), "src_id", F.col(value).cast("double").alias("v"))
    placed = packs.sources.select("pack", F.posexplode("s").alias("place", "s")).select("s.src_id", "pack", F.col("place").cast("short").alias("place"))
    # rows in memory are several times as large as stored positions
    seen = spread_join(seen, placed, ["src_id"], salt_from=["k"], salts=affordable_salts(obs, placed), limit=broadcast_limit // 4)
    there = F.col("v").isNotNull()
    # lists of plain numbers take a third of the room of a list of structs; each skips what the other one skips
    sheets = seen.groupBy("pack", "k").agg(
        F.collect_list(F.when(there, F.col("place"))).alias("places"), F.collect_list("v").alias("values"),
        F.collect_list(F.when(~there, F.col("place"))).alias("missing"))
    near = bounded_broadcast(near)
    rows = [
        tiles.select("area", F.lit(TILE).alias("kind"), F.col("t.cell_id").alias("cells"), *[F.col(f"t.{c}").alias(c) for c in (*_AXES, "r")]),
        packs.sources.join(near, "pack").select("area", F.lit(SOURCES).alias("kind"), "pack", *[F.col(f"s.{c}").alias(c) for c in _AXES]),
        sheets.join(near, "pack").select("area", F.lit(VALUES).alias("kind"), "pack", "k", "places", "values", "missing"),
    ]
    asked = rows[2].unionByName(rows[1], allowMissingColumns=True).unionByName(rows[0], allowMissingColumns=True)
    asked = asked.repartitionById(n, F.col("area").cast("int")).sortWithinPartitions("area", "kind", "k", "pack")
    out = T.StructType([T.StructField("k", asked.schema["k"].dataType), T.StructField("cell_id", T.LongType()), T.StructField("v", T.DoubleType())])
    found = asked.mapInArrow(_in_order(strict), out)
    return found.select(*[F.col("k")[k].alias(k) for k in keys], "cell_id", F.col("v").alias(value))
