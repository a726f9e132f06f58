"""Substring dedup by fixed-block anchors.

A window of ``window`` words that a document shares with another one holds, wherever it begins, one of
the other document's non-overlapping blocks of window / 2 words. So the aligned blocks of every document
are the index, and every rolling run of that many words is a probe. Where a probe meets a block of
another document, both places are anchors, and the windows around anchors are the only ones that can
repeat. Those are matched exactly: a window is removed if the same words also start in a document with
a smaller id. Adjacent windows join to maximal repeats.

Both exchanges move packed arrays by hash range. Before an exchange each task settles what it can by
itself and sends a sequence of words once, so a passage in a third of all documents costs a
few entries per task and not one per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.chunks import HashTable
from tidegrid.llm.scratch import checked, stored
from tidegrid.llm.textops import NOT_SPACE, Words, hash_windows, word_pieces

WINDOW = 50
WHOLE = 1 << 40  # end of the span of an exact copy, beyond any document
UNIT_BYTES = 4 << 20  # of text that a task settles at once
RANGE_BYTES = 8 << 20  # of text for each hash range, rather more than a million probes
REMEMBERED = 1 << 20  # windows that a task knows from its earlier units
PACKED = "part int, known boolean, hashes binary, places binary, flags binary, rows binary, ids binary, counts binary"


def _ranges(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _packed(part: int, known: bool, hashes: np.ndarray, places: np.ndarray, flags: np.ndarray, doc: np.ndarray, rows: np.ndarray, ids: np.ndarray | None) -> tuple:
    """One row of entries in document order; documents are run-length coded, places as narrow as they can be."""
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    counts = np.diff(np.append(first, len(doc))).astype(np.uint32)
    narrow = np.uint16 if places.max(initial=0) < 1 << 16 else np.uint32
    return (part, known, hashes.tobytes(), places.astype(narrow).tobytes(), np.packbits(flags).tobytes(),
            rows[doc[first]].tobytes(), b"" if ids is None else ids[doc[first]].tobytes(), counts.tobytes())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.bool_(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f.split()[0] for f in PACKED.split(", ")])


def _unpacked(table: pa.Table, width: type) -> tuple[np.ndarray, ...]:
    """(hashes, places, flags, rows, ids) of all entries of a group."""
    out = []
    for r in table.to_pylist():
        counts = np.frombuffer(r["counts"], np.uint32)
        n = int(counts.sum())
        places = np.frombuffer(r["places"], np.uint16 if len(r["places"]) == 2 * n else np.uint32).astype(np.uint32)
        hashes = np.frombuffer(r["hashes"], width) if len(r["hashes"]) else np.zeros(n, width)
        out.append((hashes, places, np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=n).astype(bool),
                    np.repeat(np.frombuffer(r["rows"], np.int64), counts), np.repeat(np.frombuffer(r["ids"], np.int64) if r["ids"] else np.zeros(len(counts), np.int64), counts)))
    return tuple(np.concatenate(c) for c in zip(*out))


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by hash, first entry of each group in that order, group of each entry in that order)."""
    order = np.argsort(hashes, kind="stable")
    new = np.append(True, hashes[order][1:] != hashes[order][:-1])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _send(p: Words, at: np.ndarray, hashes: np.ndarray, flags: np.ndarray, known: np.ndarray, sent: np.ndarray, rows: np.ndarray, ids: np.ndarray | None, ranges: int, width: type) -> pa.RecordBatch | None:
    """Entries known to this task go to the range of their document, the others to that of their hash."""
    owner, out = p.owner(), []
    for mask, is_known in ((known, True), (sent, False)):
        doc, place = owner[at[mask]], at[mask] - p.bounds[owner[at[mask]]]
        part = rows[doc] % ranges if is_known else _ranges(hashes[mask], ranges)
        order = np.argsort(part.astype(np.uint16 if ranges < 1 << 16 else np.uint32), kind="stable")
        cuts = np.searchsorted(part[order], np.arange(ranges + 1))
        own_hashes, own_flags = hashes[mask].astype(width), flags[mask]
        for r in np.flatnonzero(np.diff(cuts)):
            chosen = order[cuts[r] : cuts[r + 1]]
            out.append(_packed(int(r), is_known, own_hashes[:0] if is_known else own_hashes[chosen], place[chosen], own_flags[chosen], doc[chosen], rows, ids))
    return _batch(out) if out else None


def _probes(window: int, ranges: int):
    """Every rolling run of half a window, flagged if it is (or equals, in this task) an aligned block."""
    half = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_rows = batch.column(0).to_numpy(zero_copy_only=False)
            for p in word_pieces(batch.column(1), NOT_SPACE, False, UNIT_BYTES):
                rows = all_rows[p.first : p.last]
                hashes, owner = hash_windows(p.hashes, half), p.owner()
                at = np.flatnonzero(p.inside(half)[: len(hashes)] & (np.diff(p.bounds) >= window)[owner[: len(hashes)]])
                if not len(at):
                    continue
                hashes, doc = hashes[at], owner[at]
                aligned = (at - p.bounds[doc]) % half == 0
                order, first, group = _groups(hashes)
                sorted_doc = doc[order]
                flags, shared, leads = np.zeros(len(at), bool), np.zeros(len(at), bool), np.zeros(len(at), bool)
                any_aligned = np.maximum.reduceat(aligned[order], first)
                flags[order] = any_aligned[group]
                shared[order] = (sorted_doc[first] != sorted_doc[np.append(first[1:], len(at)) - 1])[group]
                leads[order] = sorted_doc == sorted_doc[first][group]
                out = _send(p, at, hashes, flags, shared & flags, leads, rows, None, ranges, np.uint32)
                if out is not None:
                    yield out

    return run


def _anchors(table: pa.Table) -> pa.Table:
    """(row, place) of the probes that meet an aligned block of another document."""
    known = table.filter(table.column("known"))
    table = table.filter(pa.compute.invert(table.column("known")))
    rows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    if known.num_rows:
        _, place, _, row, _ = _unpacked(known, np.uint32)
        rows.append(row)
        places.append(place)
    if table.num_rows:
        hashes, place, flags, row, _ = _unpacked(table, np.uint32)
        order, first, group = _groups(hashes)
        row, place = row[order], place[order]
        met = np.maximum.reduceat(flags[order], first) & (np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first))
        rows.append(row[met[group]])
        places.append(place[met[group]])
    return pa.table({"row": pa.array(np.concatenate(rows)), "place": pa.array(np.concatenate(places).astype(np.int32))})


class Seen:
    """Smallest id of each window that a task has met; it forgets all of them when they grow too many."""

    def __init__(self):
        self.known, self.ids = HashTable(), np.zeros(0, np.int64)

    def least(self, hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Smallest ids before these, which are then remembered; ``hashes`` are distinct."""
        if len(self.ids) > REMEMBERED:
            self.__init__()
        at = self.known.find(hashes)
        new = np.flatnonzero(at < 0)
        out = ids.copy()
        out[at >= 0] = self.ids[at[at >= 0]]
        self.ids[at[at >= 0]] = np.minimum(out, ids)[at >= 0]
        self.known.add(hashes[new], np.arange(len(self.ids), len(self.ids) + len(new), dtype=np.int32))
        self.ids = np.concatenate([self.ids, ids[new]])
        return out


def _windows(window: int, ranges: int):
    """The windows around anchors; in this task already settled where a smaller id has the same words."""
    half = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for batch in batches:
            all_rows, all_ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            anchors = batch.column(3)
            offsets, values = anchors.offsets.to_numpy(), anchors.values.to_numpy(zero_copy_only=False)
            for p in word_pieces(batch.column(2), NOT_SPACE, False, UNIT_BYTES):
                rows, ids = all_rows[p.first : p.last], all_ids[p.first : p.last]
                own = np.repeat(np.arange(p.last - p.first), np.diff(offsets[p.first : p.last + 1]))
                g = values[offsets[p.first] : offsets[p.last]] + p.bounds[own]
                low, high = np.maximum(g - half, p.bounds[own]), np.minimum(g, p.bounds[own + 1] - window)
                low, high = low[low <= high], high[low <= high]
                steps = np.zeros(len(p.hashes) + 2, np.int64)
                np.add.at(steps, low, 1)
                np.add.at(steps, high + 1, -1)
                at = np.flatnonzero(np.cumsum(steps) > 0)
                if not len(at):
                    continue
                hashes, doc = hash_windows(p.hashes, window)[at], p.owner()[at]
                order, first, group = _groups(hashes)
                least = np.minimum.reduceat(ids[doc[order]], first)
                least = np.minimum(least, seen.least(hashes[order][first], least))
                later, sent = np.zeros(len(at), bool), np.zeros(len(at), bool)
                later[order] = ids[doc[order]] > least[group]
                sent[order] = ids[doc[order]] == least[group]
                out = _send(p, at, hashes, later, later, sent, rows, ids, ranges, np.uint64)
                if out is not None:
                    yield out

    return run


def _repeats(groups: int):
    """Windows whose words also start in a document with a smaller id, packed by ``groups`` groups of documents."""

    def run(table: pa.Table) -> pa.Table:
        known = table.filter(table.column("known"))
        table = table.filter(pa.compute.invert(table.column("known")))
        rows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        if known.num_rows:
            _, place, _, row, _ = _unpacked(known, np.uint64)
            rows.append(row)
            places.append(place)
        if table.num_rows:
            hashes, place, _, row, ids = _unpacked(table, np.uint64)
            order, first, group = _groups(hashes)
            row, place, ids = row[order], place[order], ids[order]
            later = ids > np.minimum.reduceat(ids, first)[group]
            rows.append(row[later])
            places.append(place[later])
        row, place = np.concatenate(rows), np.concatenate(places)
        order = np.lexsort((row, row % groups))
        row, place, group = row[order], place[order], (row % groups)[order]
        cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(row) else np.zeros(0, int)
        bounds = list(zip(cuts, np.append(cuts[1:], len(row))))
        return pa.table({"docs": pa.array(group[cuts].astype(np.int32)), "rows": pa.array([row[a:b].tobytes() for a, b in bounds], pa.binary()),
                         "starts": pa.array([place[a:b].tobytes() for a, b in bounds], pa.binary())})

    return run


def _spans(window: int):
    """Maximal repeats of each document as start, end, start, end ... in words."""

    def run(table: pa.Table) -> pa.Table:
        row, start = (np.concatenate([np.frombuffer(x, kind) for x in table.column(c).to_pylist()]) for c, kind in (("rows", np.int64), ("starts", np.uint32)))
        order = np.lexsort((start, row))
        row, start = row[order], start[order].astype(np.int64)
        new = np.append(True, (row[1:] != row[:-1]) | (start[1:] > start[:-1] + window))
        first = np.flatnonzero(new)
        spans = np.column_stack([start[first], start[np.append(first[1:], len(row)) - 1] + window])
        docs = np.flatnonzero(np.append(True, row[first][1:] != row[first][:-1]))
        return pa.table({"row": pa.array(row[first][docs]), "spans": pa.array([x.ravel().tolist() for x in np.split(spans, docs[1:])], pa.list_(pa.int64()))})

    return run


def _cut(window: int):
    """The words outside the spans, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            spans = batch.column(2).to_pylist()
            for p in word_pieces(batch.column(1), NOT_SPACE, False):
                keep = np.ones(len(p.hashes), bool)
                for d in range(p.last - p.first):
                    own = p.bounds[d + 1] - p.bounds[d]
                    for lo, hi in zip(*[iter(spans[p.first + d] or ())] * 2):
                        if hi <= own or own >= window:
                            keep[p.bounds[d] + lo : p.bounds[d] + min(hi, own)] = False
                starts, ends = p.starts[keep], p.ends[keep]
                left = np.concatenate([[0], np.cumsum(keep)])[p.bounds]
                lengths = ends - starts + 1  # with the space that follows
                stops = np.cumsum(lengths)
                where = np.repeat(starts - stops + lengths, lengths) + np.arange(int(stops[-1]) if len(stops) else 0)
                out = p.data[np.minimum(where, max(len(p.data) - 1, 0))] if len(where) else np.zeros(0, np.uint8)
                out[stops - 1] = 0x20
                at = np.concatenate([[0], stops])[left]
                raw = out.tobytes()
                kept.extend(raw[lo : max(lo, hi - 1)].decode() for lo, hi in zip(at[:-1], at[1:]))
                total = np.diff(p.bounds)
                n_words.extend(total.tolist())
                n_removed.extend((total - np.diff(left)).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"])

    return run


def exact_copies(docs: DataFrame) -> DataFrame:
    """Rows whose whole text a smaller id has: their windows all repeat, and none of them is needed as a reference."""
    marks = docs.select("row", "doc_id", F.md5("text").alias("mark"))
    first = marks.groupBy("mark").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("mark", "first")
    return stored(marks.join(checked(first), "mark").filter("doc_id > first").select("row").distinct(), "copies")


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, spans) of the documents (row, doc_id, text) that hold repeats; see ``remove_repeats``.

    The span of an exact copy ends at ``WHOLE``; it counts if the document has a window at all.
    """
    usable = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("row", "doc_id", "text")
    copies = exact_copies(usable)
    usable = usable.join(checked(copies), "row", "left_anti")
    size = usable.select(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(8, -(-size // RANGE_BYTES))
    anchors = usable.select("row", "text").mapInArrow(_probes(window, ranges), PACKED).groupBy("part").applyInArrow(_anchors, "row long, place int")
    anchors = stored(anchors.groupBy("row").agg(F.collect_set("place").alias("places")), "anchors")
    around = usable.join(checked(anchors), "row").select("row", "doc_id", "text", "places")
    repeats = around.mapInArrow(_windows(window, ranges), PACKED).groupBy("part").applyInArrow(_repeats(ranges), "docs int, rows binary, starts binary")
    repeats = repeats.groupBy("docs").applyInArrow(_spans(window), "row long, spans array<long>")
    return stored(repeats.unionByName(copies.select("row", F.array(F.lit(0), F.lit(WHOLE)).cast("array<bigint>").alias("spans"))), "repeats")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of ``docs`` (doc_id, text).

    Removed is each word in a window of ``window`` words that also starts in a document with a smaller
    id; all windows are judged on the input. ``kept`` is the other words joined by one space. Null texts
    have no words. A null id is neither smaller nor larger than others, so such documents stay whole.
    Rows with one id do not remove each other's words. An empty table gives no rows. Other columns are
    not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(docs, window)
    return docs.join(checked(spans), "row", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut(window), "doc_id long, n_words long, n_removed long, kept string")
