"""Encoding texts through a cache of chunks that no pre-token crosses.

A byte-level tokenizer cuts text by a fixed pattern before merging bytes. Wherever white space ends
before a visible character, that pattern always cuts: the last space goes with the next pre-token, a
last line feed stands alone. So a text can be cut there, each chunk encoded by itself, and the result
joined: the tokens are those of the whole text. Chunks repeat, so each is encoded once per worker.
Texts that hold an added token's string are encoded whole, as is every text of other tokenizers.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa

from tidegrid.llm.textops import BYTE_BASE, buffers, hash_spans, kept, pieces, release

_byte = np.arange(256)
# Lead bytes C2, E1, E2 and E3 also begin white space outside ASCII, so no cut is made before them.
_VISIBLE = (_byte > 0x20) & (_byte != 0x7F) & ~np.isin(_byte, (0xC2, 0xE1, 0xE2, 0xE3))
CACHE_ENTRIES = 1 << 20
POOL_IDS = 1 << 22


class HashTable:
    """Open addressing from 64-bit hashes to small integers, looked up many at a time.

    Keys may have been chosen by their value (the smallest of some, those of a range), so their first bits
    alone would crowd them into few slots and every lookup there would walk past the others.
    """

    def __init__(self, bits: int = 12):
        self.bits, self.count = bits, 0
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(BYTE_BASE) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Value of each key, or -1."""
        out, left, slots = np.full(len(keys), -1, np.int32), np.arange(len(keys)), self._slots(keys)
        while len(left):
            there = self.keys[slots]
            hit = there == keys[left]
            out[left[hit]] = self.values[slots[hit]]
            more = ~hit & (there != 0)
            left, slots = left[more], (slots[more] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Insert distinct keys that are not there yet."""
        while (self.count + len(keys)) * 2 > len(self.keys):
            used = np.flatnonzero(self.keys)
            old = self.keys[used], self.values[used]
            self.__init__(self.bits + 1)
            self._place(*old)
        self._place(keys, values)

    def _place(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.count += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] == 0)
            _, first = np.unique(slots[free], return_index=True)
            put = free[first]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            keep = np.ones(len(keys), bool)
            keep[put] = False
            keys, values, slots = keys[keep], values[keep], (slots[keep] + 1) & ((1 << self.bits) - 1)


@dataclass
class Chunks:
    """Chunks of documents ``first`` to ``last`` of a batch."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def texts(self, which: np.ndarray) -> list[str]:
        """The chunks at ``which``, taken out of the buffer together."""
        offsets = pa.py_buffer(np.append(self.starts, len(self.data)).astype(np.int64))
        whole = pa.Array.from_buffers(pa.large_string(), len(self.starts), [None, offsets, pa.py_buffer(self.data)])
        return whole.take(pa.array(which)).to_pylist()


def chunked(column: pa.Array, whole: tuple[bytes, ...] | None):
    """Cut each text at sure pre-token borders; ``whole``: strings whose texts stay uncut, None for all."""
    data, offsets = buffers(column)
    for first, last in pieces(offsets):
        part = data[offsets[first] : offsets[last]]
        bounds = offsets[first : last + 1] - offsets[first]
        cut = np.zeros(len(part) + 1, bool)
        if whole is not None and len(part):
            visible = np.zeros(len(part), bool)
            visible[:-1] = _VISIBLE[part[1:]]
            visible[bounds[1:][bounds[1:] > 0] - 1] = False  # what follows a text's last byte is another text
            cut[:-1] = visible & ((part == 0x20) | (part == 0x0A))
            cut[1:] |= visible & (part == 0x0A)
            raw = part.tobytes()
            for text in whole:
                at = raw.find(text)
                while at >= 0:
                    d = int(np.searchsorted(bounds, at, "right")) - 1
                    cut[bounds[d] : bounds[d + 1]] = False
                    at = raw.find(text, int(bounds[d + 1]))
        cut[bounds] = True
        cut[len(part)] = False
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(part))
        yield Chunks(first, last, part, starts, ends, np.searchsorted(starts, bounds), hash_spans(part, starts, ends))
    release()


class Encoder:
    """A tokenizer of a worker process with its cache; ``ids`` keeps the ids, else only their number."""

    def __init__(self, path: str, ids: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole: tuple[bytes, ...] | None = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            pre = spec.get("pre_tokenizer") or {}
            byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            added = [t for t in spec.get("added_tokens") or [] if not (t["lstrip"] or t["rstrip"] or t["single_word"])]
            if byte_level and not spec.get("normalizer") and len(added) == len(spec.get("added_tokens") or []):
                self.whole = tuple(t["content"].encode() for t in added)
            self._encode = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        self.ids = ids
        self.reset()

    def reset(self) -> None:
        self.known, self.size = HashTable(), 0
        self.lengths, self.at = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int64)
        self.pool, self.used = np.zeros(1 << 14 if self.ids else 0, np.uint32), 0

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._encode(texts)

    def entries(self, chunks: Chunks, which: np.ndarray | None = None) -> np.ndarray:
        """Cache entry of each chunk (of those at ``which``); unseen chunks are encoded first."""
        if self.size > CACHE_ENTRIES or self.used > POOL_IDS:
            self.reset()
        hashes = chunks.hashes if which is None else chunks.hashes[which]
        found = self.known.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            where = missing[first] if which is None else which[missing[first]]
            for lo in range(0, len(new), 4096):
                self._learn(chunks.texts(where[lo : lo + 4096]))
            self.known.add(new, np.arange(self.size - len(new), self.size, dtype=np.int32))
            found[missing] = self.known.find(hashes[missing])
        return found

    def _learn(self, texts: list[str]) -> None:
        ids = self.encode(texts)
        lengths = np.fromiter(map(len, ids), np.int32, len(ids))
        while self.size + len(ids) > len(self.lengths):
            self.lengths, self.at = np.concatenate([self.lengths] * 2), np.concatenate([self.at] * 2)
        self.lengths[self.size : self.size + len(ids)] = lengths
        if self.ids:
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
            while self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.used : self.used + len(flat)] = flat
            self.at[self.size : self.size + len(ids)] = self.used + np.cumsum(lengths) - lengths
            self.used += len(flat)
        self.size += len(ids)

    def expand(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all entries in order, number of each)."""
        lengths = self.lengths[entries].astype(np.int64)
        ends = np.cumsum(lengths)
        where = np.repeat(self.at[entries] - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.pool[where], lengths


def worker_encoder(path: str, ids: bool) -> Encoder:
    """The encoder of this worker process, kept from task to task."""
    return kept(("encoder", path, ids), lambda: Encoder(path, ids))
