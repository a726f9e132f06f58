"""Alignment of two tokenizers' tokens over the bytes they cover.

Both tokenizers read a text with a space before it (the second one adds that space itself). Every token
ends at a byte; where tokens of both end, the text is cut into groups. The ends of each side are a
dictionary from end to token number; the hash sets of their keys are intersected, and the sorted common
ends slice both id lists into groups. Tokens of one group are linked, each with each.

Words repeat, so each worker aligns a stretch of text once and keeps it. A stretch begins at a space
that follows another character than a space and stands before a visible one: the byte-level tokenizer
always cuts there, and no piece of the other holds a space after another character (checked when its
file is loaded; where one does, texts are aligned whole).
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.chunks import _VISIBLE, HashTable
from tidegrid.llm.scratch import checked, stored
from tidegrid.llm.textops import buffers, hash_spans, kept, pieces, release

CACHE_ENTRIES = 1 << 19
CACHE_BYTES = 96 << 20
# Id pairs whose counts are broadcast, the most frequent ones: at most this many rows of three numbers.
FREQUENT_PAIRS = 1 << 17
# An id pair as one number: the first id times this, plus the second.
PAIR = 1 << 32
SPACE_MARK = "▁"

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def byte_letters() -> dict[str, int]:
    """The printable letter that a byte-level vocabulary writes for each byte.

    Printable bytes stand for themselves; the others follow from U+0100 on in ascending order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Sides:
    """Both tokenizers with the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        letters = byte_letters()
        self.bytes_a = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        byte = re.compile("<0x([0-9A-F]{2})>")
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := byte.fullmatch(n)) else n.replace(SPACE_MARK, " ").encode() for n in names]
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain_a = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
        # an identity normalization keeps runs of spaces and compatibility characters as they are
        probe = "  x ﬁ 　y  "
        plain_b = "".join(self.b.encode(probe, out_type=str)).replace(SPACE_MARK, " ") == " " + probe
        self.cuts = plain_a and plain_b and not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", n) for n in names)

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both sides for texts that begin with the space."""
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        return zip(ids_a, self.b.encode([t[1:] for t in texts], num_threads=1))

    def groups(self, text: str, ids_a: list[int], ids_b: list[int]) -> list[tuple[list[int], list[int]]] | None:
        """Groups of token ids in the order of the text; None where the tokens' bytes are not those of ``text``."""
        told_a, told_b = [self.bytes_a[i] for i in ids_a], [self.bytes_b[i] for i in ids_b]
        whole = text.encode()
        if b"".join(told_a) != whole or b"".join(told_b) != whole:
            return None
        # dictionaries from each byte where a token ends to the number of tokens up to it
        ends_a = dict(zip(accumulate(map(len, told_a)), range(1, len(told_a) + 1)))
        ends_b = dict(zip(accumulate(map(len, told_b)), range(1, len(told_b) + 1)))
        out, i, j = [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            k, m = ends_a[end], ends_b[end]
            out.append((ids_a[i:k], ids_b[j:m]))
            i, j = k, m
        return out


def links(groups: list[tuple[list[int], list[int]]]) -> dict[int, int]:
    """How often each id pair is linked: in a group each token of one side with each of the other."""
    out: dict[int, int] = {}
    for a, b in groups:
        if len(a) * len(b) <= 64:
            for x in a:
                x *= PAIR
                for y in b:
                    out[x + y] = out.get(x + y, 0) + 1
        else:
            many = Counter(b).items()
            for x, n in Counter(a).items():
                for y, m in many:
                    out[x * PAIR + y] = out.get(x * PAIR + y, 0) + n * m
    return out


def told(groups: list[tuple[list[int], list[int]]]) -> str:
    """The groups as text: ids of a side by commas, the sides by a bar, groups by semicolons."""
    return ";".join([f"{a[0]}|{b[0]}" if len(a) == len(b) == 1 else ",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups])


class Aligner:
    """Aligned stretches of a worker process, each kept under its hash."""

    def __init__(self, path_a: str, path_b: str):
        self.sides = Sides(path_a, path_b)
        self.reset()

    def reset(self) -> None:
        self.known, self.texts, self.bytes = HashTable(), [], 0
        self.numbers = np.zeros((1 << 10, 5), np.int64)  # tokens of A and B, groups, links, whether the bytes agree
        self.at, self.pairs, self.times, self.used = np.zeros((1 << 10) + 1, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def learn(self, texts: list[str]) -> None:
        numbers, pairs, times, at = [], [], [], []
        for text, (ids_a, ids_b) in zip(texts, self.sides.encode(texts)):
            groups = self.sides.groups(text, ids_a, ids_b)
            found = links(groups or ())
            pairs += found
            times += found.values()
            numbers.append((len(ids_a), len(ids_b), len(groups or ()), sum(found.values()), groups is not None))
            at.append(self.used + len(pairs))
            self.texts.append(told(groups or ()))
            self.bytes += len(self.texts[-1])
        first, last, used = len(self.texts) - len(texts), len(self.texts), self.used + len(pairs)
        while last > len(self.numbers):
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
            self.at = np.concatenate([self.at, np.zeros(len(self.at) - 1, np.int64)])
        while used > len(self.pairs):
            self.pairs, self.times = (np.concatenate([x, np.zeros_like(x)]) for x in (self.pairs, self.times))
        self.numbers[first:last], self.at[first + 1 : last + 1] = numbers, at
        self.pairs[self.used : used], self.times[self.used : used] = pairs, times
        self.used = used

    def entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Entry of each stretch; unseen ones are aligned first."""
        if len(self.texts) > CACHE_ENTRIES or self.bytes + 16 * self.used > CACHE_BYTES:
            self.reset()
        hashes = hash_spans(data, starts, ends)
        found = self.known.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            where, base = missing[first], len(self.texts)
            for lo in range(0, len(new), 4096):
                self.learn([data[starts[i] : ends[i]].tobytes().decode() for i in where[lo : lo + 4096]])
            self.known.add(new, np.arange(base, base + len(new), dtype=np.int32))
            found[missing] = self.known.find(hashes[missing])
        return found.astype(np.int64)

    def read(self, column: pa.Array) -> Iterator[pa.RecordBatch]:
        """Rows of ``ALIGNED`` but the id, for texts that begin with the space; empty ones have no tokens."""
        data, offsets = buffers(column)
        for first, last in pieces(offsets):
            part, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            cut = np.zeros(len(part) + 1, bool)
            if self.sides.cuts and len(part) > 2:
                space = part == 0x20
                cut[1:-2] = space[1:-1] & ~space[:-2] & _VISIBLE[part[2:]]
                ends = bounds[1:][bounds[1:] > 0]
                cut[ends - 1] = False  # what follows is another text
            cut[bounds] = True
            cut[len(part)] = False
            starts = np.flatnonzero(cut)
            owners = np.searchsorted(starts, bounds)
            entries = self.entries(part, starts, np.append(starts[1:], len(part)))
            yield self._rows(entries, owners)
        release()

    def _rows(self, entries: np.ndarray, owners: np.ndarray) -> pa.RecordBatch:
        n_docs = len(owners) - 1
        sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.numbers[entries], axis=0)])
        numbers = sums[owners[1:]] - sums[owners[:-1]]
        whole = numbers[:, 4] == np.diff(owners)  # the bytes of every stretch agree
        numbers[~whole] = 0
        texts = [";".join([self.texts[e] for e in entries[a:b].tolist()]) if ok else "" for a, b, ok in zip(owners[:-1], owners[1:], whole)]
        # links of each document: those of its stretches, summed by id pair
        owner = np.repeat(np.arange(n_docs), np.diff(owners))
        use = whole[owner]
        sizes = (self.at[entries + 1] - self.at[entries])[use]
        ends = np.cumsum(sizes)
        where = np.repeat(self.at[entries][use] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        pairs, times, owner = self.pairs[where], self.times[where], np.repeat(owner[use], sizes)
        order = np.lexsort((pairs, owner))
        pairs, times, owner = pairs[order], times[order], owner[order]
        new = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1])])) if len(pairs) else np.zeros(0, np.int64)
        times = np.add.reduceat(times, new) if len(new) else times
        lists = pa.array(np.searchsorted(owner[new], np.arange(n_docs + 1)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [*(pa.array(numbers[:, i]) for i in range(4)), pa.array(texts, pa.string()),
             pa.ListArray.from_arrays(lists, pa.array(pairs[new])), pa.ListArray.from_arrays(lists, pa.array(times))],
            ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str | Column = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of both tokenizers and their groups for every row of ``docs``: columns of ``ALIGNED``.

    ``path_a`` is a byte-level file for tokenizers, ``path_b`` a sentencepiece model that puts a space
    before a text. ``groups`` is the text ``a1,a2|b1;a3|b2`` of all groups; ``pairs`` holds each linked
    id pair once (the first id times 2^32, plus the second) and ``times`` how many links it has.
    Null and empty texts, and texts whose joined token bytes are not a space and the text (such as
    one that holds U+2581), have no tokens: zeros, an empty ``groups``, no pairs. Ids may be null or
    repeat; every row gives one row. Long texts are read whole; a group's links are counted by id pair,
    so a group takes memory as the product of its distinct ids, not of its tokens. An empty table gives
    no rows; other columns are not read.
    """
    ids = F.col(id_col) if isinstance(id_col, str) else id_col

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        for batch in batches:
            at = 0
            for rows in aligner.read(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, rows.num_rows), *rows.columns], ["doc_id", *rows.schema.names])
                at += rows.num_rows

    spaced = F.when(F.length(text) > 0, F.concat(F.lit(" "), F.col(text)))
    return docs.select(ids.cast("long").alias("doc_id"), spaced.alias("text")).mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n_docs, best) of all documents: in how many rows a pair is linked, and whether none with its first id has more.

    The highest counts are one row per id of the first vocabulary, so their table is bounded by it.
    """
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs")), "pair-counts")
    first = F.shiftright("pair", 32).alias("first")
    most = stored(counts.groupBy(first).agg(F.max("n_docs").alias("most")), "pair-most")
    return counts.withColumn("first", first).join(checked(most), "first").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame, counts: DataFrame, row: str = "row") -> DataFrame:
    """(row, n_best, count_sum) of rows with links: links that are best for their first id, and counts summed over links.

    ``aligned`` has a distinct ``row`` per row, ``pairs`` and ``times``. Counts are looked up in two
    tiers: the ``FREQUENT_PAIRS`` most frequent pairs are broadcast, a table of bounded size; the rest
    joins by pair, where no pair has more rows than the rarest broadcast one.
    """
    total = counts.count()
    near = stored(counts.orderBy(F.desc("n_docs"), "pair").limit(FREQUENT_PAIRS), "pair-near")
    each = aligned.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(row, F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    score = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n_docs")).alias("count_sum")]
    found = each.join(F.broadcast(near), "pair").groupBy(row).agg(*score)
    if total > FREQUENT_PAIRS:
        rare = each.join(F.broadcast(near.select("pair")), "pair", "left_anti")
        far = rare.join(counts.join(F.broadcast(near.select("pair")), "pair", "left_anti"), "pair").groupBy(row).agg(*score)
        found = found.unionByName(far).groupBy(row).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found


def score_links(aligned: DataFrame) -> DataFrame:
    """``aligned`` without its pairs, with n_best and count_sum over all its documents.

    The rows are stored first: each gets a number that stays the same, and nothing is encoded twice.
    """
    rows = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(rows), "pairs")
    scores = link_scores(rows.filter(F.size("pairs") > 0), counts)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.drop("pairs", "times").join(scores, "row", "left").select(
        *[c for c in rows.columns if c not in ("row", "pairs", "times")], zero("n_best"), zero("count_sum"))
