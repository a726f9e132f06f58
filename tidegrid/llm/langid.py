"""Language of texts by a linear-chain conditional random field over their words.

A word is a run of letters. Its score for a language adds up learned weights of its prefixes,
suffixes, byte n-grams and itself (hashed), and of the lexicons of the languages it is in; transitions
between languages are learned too. Forward-backward gives each word the probability of each language,
which labels the words of code-switched text; a text's language is the one with the largest mean.

The weights are fitted by gradient ascent of the likelihood on a bounded sample of labelled texts. Half
of the training sequences are spliced from texts of different languages, so that transitions are seen.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.chunks import HashTable
from tidegrid.llm.scratch import checked, hash_share, stored
from tidegrid.llm.textops import hash_spans, kept, mix, word_pieces

# The classifier is fitted on at most this many labelled texts (those with the lowest hash of each
# language in turn), each of at most this many bytes.
TRAIN_DOCS, TRAIN_BYTES = 1000, 16384
HELD_OUT = 2  # of crc32(doc_id as text) modulo 4
FEATURE_BITS = 16
SEQUENCE = 128
EPOCHS, RATE, DECAY = 2, 0.3, 1e-6
LEXICON_WORDS = 2000  # most frequent words of the sample, per language
CACHED_TYPES = 1 << 19
UNDETERMINED = "und"

_byte = np.arange(256)
LETTERS = ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)


def fold(data: np.ndarray) -> np.ndarray:
    """Lower-case the Latin letters that UTF-8 writes with a lead byte of C3 (in place of a copy)."""
    out = data.copy()
    upper = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][upper] += 0x20
    return out


def _slot(hashes: np.ndarray, salt: int) -> np.ndarray:
    return (mix(hashes, 0x9E37 + salt) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


@dataclass
class Features:
    """Hashed features of word types: one of each fixed kind, and n-grams with bounds per word."""

    fixed: list[np.ndarray]
    grams: list[tuple[np.ndarray, np.ndarray]]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        out = sum(weights[f] for f in self.fixed)
        for slots, bounds in self.grams:
            sums = np.concatenate([np.zeros((1, weights.shape[1])), np.cumsum(weights[slots], axis=0, dtype=np.float64)])
            out = out + sums[bounds[1:]] - sums[bounds[:-1]]
        return out

    def gradient(self, by_word: np.ndarray) -> np.ndarray:
        size = 1 << FEATURE_BITS
        slots = np.concatenate([*self.fixed, *(s for s, _ in self.grams)])
        words = np.concatenate([*[np.arange(len(by_word))] * len(self.fixed), *(np.repeat(np.arange(len(by_word)), np.diff(b)) for _, b in self.grams)])
        return np.stack([np.bincount(slots, by_word[words, j], size) for j in range(by_word.shape[1])], axis=1)


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Features:
    """Features of the words at the spans of (folded) ``data``."""
    fixed = [_slot(hash_spans(data, starts, ends), 0)]
    for k in (1, 2, 3):
        fixed.append(_slot(hash_spans(data, starts, np.minimum(starts + k, ends)), k))
        fixed.append(_slot(hash_spans(data, np.maximum(ends - k, starts), ends), 3 + k))
    grams = []
    for k in (2, 3):
        number = np.maximum(ends - starts - k + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(number)])
        at = np.repeat(starts - bounds[:-1], number) + np.arange(bounds[-1])
        grams.append((_slot(hash_spans(data, at, at + k), 6 + k), bounds))
    return Features(fixed, grams)


@dataclass
class Model:
    """The weights; ``lexicon`` maps word hashes to bits of languages."""

    languages: list[str]
    weights: np.ndarray
    in_lexicon: np.ndarray
    start: np.ndarray
    move: np.ndarray
    lexicon: HashTable

    def lexicons(self, hashes: np.ndarray) -> np.ndarray:
        bits = np.maximum(self.lexicon.find(hashes), 0)
        return (bits[:, None] >> np.arange(len(self.languages)) & 1).astype(np.float64)

    def emissions(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        return features(data, starts, ends).scores(self.weights) + self.lexicons(hashes) @ self.in_lexicon


def forward_backward(scores: np.ndarray, valid: np.ndarray, start: np.ndarray, move: np.ndarray, pairs: bool = False):
    """Probabilities of labels for sequences (sequence, position, label); with ``pairs`` also summed pair probabilities.

    ``valid`` marks the positions of each sequence, without gaps from the left.
    """
    peak = scores.max(axis=2, keepdims=True)
    emit, trans = np.exp(scores - peak), np.exp(move - move.max())
    n, length, labels = scores.shape
    ahead, behind = np.empty_like(emit), np.ones_like(emit)
    now = np.exp(start - start.max()) * emit[:, 0]
    for t in range(length):
        if t:
            now = (now @ trans) * emit[:, t]
        now = now / now.sum(axis=1, keepdims=True)
        ahead[:, t] = now
    for t in range(length - 2, -1, -1):
        back = (emit[:, t + 1] * behind[:, t + 1]) @ trans.T
        back = back / back.sum(axis=1, keepdims=True)
        behind[:, t] = np.where(valid[:, t + 1, None], back, 1.0)
    gamma = ahead * behind
    gamma /= gamma.sum(axis=2, keepdims=True)
    gamma[~valid] = 0
    if not pairs:
        return gamma
    xi = ahead[:, :-1, :, None] * trans * (emit[:, 1:] * behind[:, 1:])[:, :, None, :]
    xi /= xi.sum(axis=(2, 3), keepdims=True)
    return gamma, (xi * valid[:, 1:, None, None]).sum(axis=(0, 1))


def fit(texts: list[str], langs: list[str], seed: int = 7) -> Model:
    """Fit a model; the same sample gives the same model."""
    languages = sorted(set(langs))
    count, rng = len(languages), np.random.default_rng(seed)
    types, words, data, starts, ends, place = {}, [], [], [], [], 0
    for first, p in _folded(pa.array(texts, pa.string())):
        kinds, index, inverse = np.unique(p[3], return_index=True, return_inverse=True)
        own = np.empty(len(kinds), np.int64)
        for j, (h, i) in enumerate(zip(kinds.tolist(), index.tolist())):
            if h not in types:
                types[h] = len(types)
                piece = p[0][p[1][i] : p[2][i]]
                data.append(piece)
                starts.append(place)
                place += len(piece)
                ends.append(place)
            own[j] = types[h]
        tokens = own[inverse]
        words.extend((languages.index(langs[first + d]), tokens[lo:hi]) for d, (lo, hi) in enumerate(zip(p[4][:-1], p[4][1:])) if hi > lo)
    data = np.concatenate(data) if data else np.zeros(0, np.uint8)
    hashes = np.array(list(types), np.uint64)
    model = Model(languages, np.zeros((1 << FEATURE_BITS, count)), np.zeros((count, count)), np.zeros(count), np.zeros((count, count)), HashTable())
    if not words:
        return model
    often = np.zeros((len(types), count), np.int64)
    for lang, tokens in words:
        often[:, lang] += np.bincount(tokens, minlength=len(types))
    bits = np.zeros(len(types), np.int32)
    for lang in range(count):
        top = np.argsort(-often[:, lang], kind="stable")[:LEXICON_WORDS]
        bits[top[often[top, lang] > 0]] |= 1 << lang
    model.lexicon.add(hashes[bits > 0], bits[bits > 0])
    known, member = features(data, np.array(starts), np.array(ends)), model.lexicons(hashes)

    tokens, labels = _sequences(words, rng)
    squares = [np.full_like(x, 1e-8) for x in (model.weights, model.in_lexicon, model.start, model.move)]
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(tokens)), max(1, len(tokens) // 256)):
            y, x = labels[rows], tokens[rows]
            valid = y >= 0
            emission = known.scores(model.weights) + member @ model.in_lexicon
            gamma, pairs = forward_backward(emission[np.maximum(x, 0)], valid, model.start, model.move, pairs=True)
            truth = (y[:, :, None] == np.arange(count)) & valid[:, :, None]
            error = truth - gamma
            by_word = np.stack([np.bincount(x[valid], error[valid][:, j], len(types)) for j in range(count)], axis=1)
            moved = np.zeros((count, count))
            both = valid[:, 1:] & valid[:, :-1]
            np.add.at(moved, (y[:, :-1][both], y[:, 1:][both]), 1)
            slopes = [known.gradient(by_word), member.T @ by_word, error[:, 0].sum(axis=0), moved - pairs]
            for value, slope, square in zip((model.weights, model.in_lexicon, model.start, model.move), slopes, squares):
                slope = slope / len(rows) - DECAY * value
                square += slope * slope
                value += RATE * slope / np.sqrt(square)
    model.weights = model.weights.astype(np.float32)
    return model


def _sequences(words: list[tuple[int, np.ndarray]], rng) -> tuple[np.ndarray, np.ndarray]:
    """Training sequences of types and labels, -1 beyond their ends: whole runs, and splices of short spans."""
    runs, spans = [], []
    for lang, tokens in words:
        for at in range(0, len(tokens), SEQUENCE):
            run = tokens[at : at + SEQUENCE]
            runs.append([(lang, run)])
            cuts = np.sort(rng.integers(0, len(run) + 1, max(1, len(run) // 24)))
            spans.extend((lang, part) for part in np.split(run, cuts) if len(part))
    order, current, size = rng.permutation(len(spans)), [], 0
    for i in order:
        if size + len(spans[i][1]) > SEQUENCE:
            runs.append(current)
            current, size = [], 0
        current.append(spans[i])
        size += len(spans[i][1])
    if current:
        runs.append(current)
    tokens, labels = np.full((len(runs), SEQUENCE), -1), np.full((len(runs), SEQUENCE), -1)
    for row, parts in enumerate(runs):
        flat = np.concatenate([p for _, p in parts])
        tokens[row, : len(flat)] = flat
        labels[row, : len(flat)] = np.repeat([lang for lang, _ in parts], [len(p) for _, p in parts])
    return tokens, labels


def _folded(column: pa.Array) -> Iterator[tuple[int, tuple]]:
    """(first document, (folded bytes, starts, ends, hashes, bounds)) of each piece."""
    for p in word_pieces(column, LETTERS, True):
        data = fold(p.data)
        yield p.first, (data, p.starts, p.ends, hash_spans(data, p.starts, p.ends), p.bounds, p.last - p.first)


def held_out(doc_id: Column) -> Column:
    """True for the documents kept from training; a null id is in neither part and gives false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def sample(docs: DataFrame) -> DataFrame:
    """(text, lang, h) of the labelled texts of ``docs`` that a model is fitted on, at most ``TRAIN_DOCS``.

    Languages take turns, each with its texts of the lowest hashes, so a rare one is learned from all it
    has (with more than ``TRAIN_DOCS`` languages some are not learned). A text counts once per language,
    however many copies it has. Only hashes below a bound from each language's number of texts are ranked,
    and texts are fetched for what was chosen, so no task gets more as partitions grow in number.
    """
    usable = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.octet_length("text").between(1, TRAIN_BYTES))
    usable = usable.select("doc_id", "text", "lang", F.xxhash64("text").alias("h"))
    bounds = stored(usable.groupBy("lang").agg((F.lit(4.0 * TRAIN_DOCS) / F.approx_count_distinct("h")).alias("share")), "languages")
    low = usable.join(checked(bounds), "lang").filter(hash_share(F.col("h")) < F.col("share"))
    low = low.groupBy("lang", "h").agg(F.min("doc_id").alias("doc_id"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = stored(low.withColumn("turn", turn).orderBy("turn", "h", "lang").limit(TRAIN_DOCS), "language-sample")
    return usable.join(checked(chosen), ["lang", "h", "doc_id"]).groupBy("lang", "h").agg(F.min("text").alias("text")).select("text", "lang", "h")


def train(docs: DataFrame) -> bytes:
    """Fit a model on ``sample`` of ``docs`` (doc_id, text, lang) outside the held-out part; one task."""
    chosen = sample(docs).repartition(1).sortWithinPartitions("h", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, langs = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            langs += batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, langs))], pa.binary())], ["model"])

    rows = chosen.select("text", "lang").mapInArrow(run, "model binary").collect()
    return bytes(rows[0].model) if rows else pickle.dumps(fit([], []))


class Labeller:
    """A model in a worker with the scores of the word types seen so far."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.known, self.size = HashTable(), 0
        self.scores = np.zeros((1 << 12, len(self.model.languages)), np.float32)

    def emissions(self, piece: tuple) -> np.ndarray:
        data, starts, ends, hashes, _, _ = piece
        if self.size > CACHED_TYPES:
            self.reset()
        found = self.known.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            at = missing[first]
            while self.size + len(new) > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.scores[self.size : self.size + len(new)] = self.model.emissions(data, starts[at], ends[at], new)
            self.known.add(new, np.arange(self.size, self.size + len(new), dtype=np.int32))
            self.size += len(new)
            found[missing] = self.known.find(hashes[missing])
        return self.scores[found]

    def probabilities(self, piece: tuple) -> np.ndarray:
        """(word, language) probabilities; a document is read in sequences of ``SEQUENCE`` words."""
        emission, bounds = self.emissions(piece), piece[4]
        lengths = np.diff(bounds)
        number = -(-lengths // SEQUENCE)
        firsts = np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(number)[:-1]]) * SEQUENCE, number) + np.arange(number.sum()) * SEQUENCE
        lasts = np.minimum(firsts + SEQUENCE, np.repeat(bounds[1:], number))
        out = np.zeros(emission.shape, np.float32)
        for lo in range(0, len(firsts), 2048):
            first, last = firsts[lo : lo + 2048], lasts[lo : lo + 2048]
            longest = int((last - first).max())
            at = first[:, None] + np.arange(longest)
            valid = at < last[:, None]
            scores = np.where(valid[:, :, None], emission[np.minimum(at, len(emission) - 1)], np.float32(0))
            gamma = forward_backward(scores, valid, self.model.start.astype(np.float32), self.model.move.astype(np.float32))
            out[at[valid]] = gamma[valid]
        return out


def _worker_labeller(data: bytes) -> Labeller:
    return kept(("labeller", data), lambda: Labeller(pickle.loads(data)))


def identify(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches) of every row of ``docs`` (doc_id, text), by a trained model.

    ``score`` is the mean probability of the predicted language over the words; ``n_switches`` counts
    adjacent words with different likeliest languages. Null texts and texts without a letter are "und"
    with score 0, as is everything if the model has no languages. Ties go to the first language in order.
    Repeated rows give a row each; an empty table gives none. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _worker_labeller(shared.value)
        names = np.array([*labeller.model.languages, UNDETERMINED], object)
        for batch in batches:
            lang, score, words, switches = [], [], [], []
            for first, piece in _folded(batch.column(1)):
                data, starts, _, _, bounds, n = piece
                lengths = np.diff(bounds)
                best, mean, changes = np.full(n, len(names) - 1), np.zeros(n), np.zeros(n, np.int64)
                if len(starts) and len(names) > 1:
                    p = labeller.probabilities(piece)
                    sums = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, axis=0, dtype=np.float64)])
                    means = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(lengths, 1)[:, None]
                    lettered = np.add.reduceat(np.append(data[starts] < 0x80, False), np.minimum(bounds[:-1], len(starts))) > 0
                    for d in np.flatnonzero((lengths > 0) & ~lettered):  # no word begins with an ASCII letter
                        lettered[d] = any(map(str.isalpha, batch.column(1)[first + int(d)].as_py()))
                    sure = (lengths > 0) & lettered
                    best[sure], mean[sure] = means[sure].argmax(axis=1), means[sure].max(axis=1)
                    likeliest = p.argmax(axis=1)
                    turn = np.concatenate([[0, 0], np.cumsum(likeliest[1:] != likeliest[:-1])])
                    changes[sure] = turn[bounds[1:][sure]] - turn[bounds[:-1][sure] + 1]
                lang.extend(names[best])
                score.extend(np.clip(mean, 0, 1).tolist())
                words.extend(lengths.tolist())
                switches.extend(changes.tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(words, pa.int64()), pa.array(switches, pa.int64())],
                ["doc_id", "lang_pred", "score", "n_words", "n_switches"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, n_words long, n_switches long")
