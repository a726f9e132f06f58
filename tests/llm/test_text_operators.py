"""Operators on documents against brute force over awkward rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import folded, prose, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegrid.llm import chunks, decontaminate, jaccard, langid, mixture, substrings, tokencount, tokenfiles
from tidegrid.session import shared_dir

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [" \n x", "a  ", "a  b    c", "x\n<|endoftext|> y", "x \n<|endoftext|>", "a\n\n\nb  c\t d\r\ne", "é  x　 y\n　", "a\x1c b\x85\x85", "it's\n's", "\U0001F600 \U0001F600", "y" * 5000]


def multiset(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return chunks.Encoder(PATH, True)


def token_rows(awkward):
    return awkward + [(100 + i, t, "en", "a") for i, t in enumerate(ODD)]


def test_token_counts(corpus, awkward, library):
    rows = token_rows(awkward)
    expected = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in rows)
    assert multiset(tokencount.count_tokens(corpus(rows), PATH), "doc_id", "n_bytes", "n_tokens") == expected
    assert tokencount.count_tokens(corpus([]), PATH).count() == 0


def test_token_counts_of_other_tokenizers(corpus, awkward):
    import sentencepiece

    model, bpe = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
    rows = [r for r in token_rows(awkward) if len(r[1] or "") < 4000]
    sp, tk = sentencepiece.SentencePieceProcessor(model_file=model), tokenizers.Tokenizer.from_file(bpe)
    assert multiset(tokencount.count_tokens(corpus(rows), model), "doc_id", "n_tokens") == Counter((r[0], len(sp.encode(r[1] or ""))) for r in rows)
    assert multiset(tokencount.count_tokens(corpus(rows), bpe), "doc_id", "n_tokens") == Counter(
        (r[0], len(tk.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)


ENDS = ["", " ", "  ", "\n", "\n\n", "\n\n\n", " \n", "\n ", " \n\n", "\t", "\r\n", "\u3000", "\u00a0\n", "\n\n "]
MIDDLES = ["x", "a b", "é", "日本", "1", "'s", ",.", "<|endoftext|>", "<|endof", "text|>", "\u0085", "\U0001F600", "y\n\nz", ""]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(ENDS), st.sampled_from(MIDDLES), st.sampled_from(ENDS)), min_size=1, max_size=12))
def test_ids_do_not_depend_on_the_next_text(library, encoder, parts):
    """Whatever stands next in the batch, the ids are those of the library for each text alone."""
    import pyarrow as pa

    texts = ["".join(p) for p in parts]
    for batch in [texts, *[[t] for t in texts], texts[::-1]]:
        got = []
        for c in chunks.chunked(pa.array(batch), encoder.whole):
            ids, lengths = encoder.expand(encoder.entries(c))
            ends = np.concatenate([[0], np.cumsum(lengths)])[c.bounds]
            got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in batch]


def test_token_counts_at_text_ends(corpus, library):
    """Texts that end in white space before texts of every kind, in one batch and dealt over several."""
    texts = [a + e for a in ("x", "a b", "日") for e in ENDS]
    rows = [(2 * i + j, t, "en", "a") for i, t in enumerate(texts) for j, t in enumerate((t, MIDDLES[i % len(MIDDLES)]))]
    expected = Counter((i, len(library.encode(t, add_special_tokens=False).ids)) for i, t, _, _ in rows)
    for parts in (1, 3, 7):
        found = tokencount.count_tokens(corpus(rows).coalesce(1).repartition(parts, "doc_id"), PATH)
        assert multiset(found, "doc_id", "n_tokens") == expected


def test_cache_is_bounded(library, monkeypatch):
    monkeypatch.setattr(chunks, "CACHE_ENTRIES", 5)
    import pyarrow as pa

    encoder, rng = chunks.Encoder(PATH, True), random.Random(1)
    texts = [prose(rng, 50) for _ in range(20)]
    for text in texts:
        (c,) = chunks.chunked(pa.array([text]), encoder.whole)
        assert encoder.expand(encoder.entries(c))[0].tolist() == library.encode(text).ids
    assert encoder.size < 100


def test_token_files(spark, corpus, awkward, library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK_DOCS", 7)
    rows, folder = token_rows(awkward), shared_dir(spark, "files")
    tokenfiles.write_token_files(corpus(rows), folder, PATH)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in tokenfiles.read_token_files(spark, folder).collect())
    ids = lambda t: library.encode(t or "", add_special_tokens=False).ids + [0]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert Counter((k, i, n, c) for k, i, _, n, c in got) == Counter((i is not None, i or 0, len(ids(t)), crc(ids(t))) for i, t, _, _ in rows)
    start = 0
    for _, _, at, n, _ in sorted(got, key=lambda r: r[2]):
        assert at == start
        start += n
    assert [r[:2] for r in sorted(got, key=lambda r: r[2])] == [r[:2] for r in got]
    assert sorted(tokenfiles.read_document(spark, folder, 71)) == sorted(ids(t) for i, t, _, _ in rows if i == 71)
    assert tokenfiles.read_document(spark, folder, 53)[0] == next(ids(t) for i, t, _, _ in rows if i == 53)
    assert tokenfiles.read_document(spark, folder, 9999) == []
    stored = spark.read.parquet(f"{folder}/blocks")
    assert stored.select("dictionary").distinct().count() == 1
    empty = shared_dir(spark, "files")
    tokenfiles.write_token_files(corpus([]), empty, PATH)
    assert tokenfiles.read_token_files(spark, empty).count() == 0


def brute_components(rows, k, percent):
    sets = []
    for _, t, _, _ in rows:
        w = words(folded(t))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least[find(i)] if least[find(i)] is not None else r[0])
    return Counter((r[0], len(sets[i]), least[find(i)] if sets[i] else r[0]) for i, r in enumerate(rows))


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (1, 50)])
def test_jaccard(corpus, awkward, k, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_ROWS", 3)
    got = multiset(jaccard.jaccard_components(corpus(awkward), k, percent), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(awkward, k, percent)


def test_jaccard_chain_without_hub(corpus, monkeypatch):
    """Copies that differ step by step link only to their neighbours, so no leader connects them."""
    monkeypatch.setattr(jaccard, "TILE_ROWS", 4)
    base = [f"w{i}" for i in range(60)]
    rows = [(100 - s, " ".join(base[s : s + 40]), "en", "a") for s in range(21)] + [(200, " ".join(base[::-1]), "en", "a")]
    got = multiset(jaccard.jaccard_components(corpus(rows), 3, 80), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(rows, 3, 80)
    assert len({c for _, _, c in got}) == 2


def test_jaccard_empty(corpus):
    assert jaccard.jaccard_components(corpus([])).count() == 0
    assert jaccard.jaccard_components(corpus([(1, None, None, None)])).first().component_id == 1


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_pigeonhole_parts_share(percent):
    """Linked sets agree on a part in a common band, at any sizes."""
    rng = np.random.default_rng(percent)
    for n in [1, 2, 3, 4, 5, 7, 9, 10, 11, 15, 19, 20, 33, 50, 99, 300, 1000]:
        bands = jaccard.Bands(percent)
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for drop in range(0, n // 2 + 1, max(1, n // 20)):
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, drop // 3, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if len(b) and 100 * common >= percent * (len(a) + len(b) - common):
                assert set(bands.signatures(a).tolist()) & set(bands.signatures(b).tolist())


@pytest.mark.parametrize("blocks", [1, 5])
def test_decontaminate(corpus, spark, awkward, blocks, monkeypatch):
    rng = random.Random(3)
    source = [t for _, t, _, _ in awkward if t and 200 < len(t) < 3000]
    items = [(i, " ".join(words(rng.choice(source))[a : a + n])) for i, (a, n) in enumerate([(0, 30), (5, 12), (20, 10), (3, 9), (0, 1), (2, 2), (1, 3), (7, 40)])]
    items += [(20, None), (21, ""), (None, "le la der die"), (0, items[0][1]), (22, "quite other words that no text has in it at all")]
    benchmark = spark.createDataFrame([(*r, "clash", "clash") for r in items], "item_id long, text string, words string, doc_id string")
    if blocks > 1:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", sum(len((t or "").encode()) for _, t in items) // blocks)
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(t))
    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        for at in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows[tuple(w[at : at + 10])].add("null" if i is None else str(i))
    expected = Counter()
    for i, t, _, _ in awkward:
        w, hit, found = split(t), set(), set()
        for size in {len(x) for x in windows}:
            for at in range(len(w) - size + 1):
                if own := windows.get(tuple(w[at : at + size])):
                    hit |= set(range(at, at + size))
                    found |= own
        expected[i, len(w), tuple(sorted(hit)), tuple(sorted(found))] += 1
    got = Counter()
    for r in decontaminate.contamination(corpus(awkward), benchmark).collect():
        spans = list(zip(r.spans[::2], r.spans[1::2]))
        assert all(a < b for a, b in spans) and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))
        got[r.doc_id, r.n_words, tuple(x for a, b in spans for x in range(a, b)), tuple(r.items)] += 1
    assert got == expected


def test_decontaminate_empty(corpus, spark, awkward):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {tuple(r.spans) for r in decontaminate.contamination(corpus(awkward), none).collect()} == {()}
    assert decontaminate.contamination(corpus([]), spark.createDataFrame([(1, "a b")], none.schema)).count() == 0


@pytest.mark.parametrize("window", [50, 8])
def test_remove_repeats(corpus, awkward, window, monkeypatch):
    monkeypatch.setattr(substrings, "UNIT_BYTES", 3000)
    starts = {}
    for i, t, _, _ in awkward:
        w = words(t)
        for at in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[at : at + window])
                starts[key] = min(i, starts.get(key, i))
    expected = Counter()
    for i, t, _, _ in awkward:
        w, gone = words(t), set()
        for at in range(len(w) - window + 1):
            if i is not None and starts[tuple(w[at : at + window])] < i:
                gone |= set(range(at, at + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        expected[i, len(w), len(gone), kept] += 1
    assert multiset(substrings.remove_repeats(corpus(awkward), window), "doc_id", "n_words", "n_removed", "kept") == expected
    assert substrings.remove_repeats(corpus([]), window).count() == 0


def test_mix(corpus, awkward):
    rng = random.Random(9)
    rows = awkward + [(1000 + i, prose(rng, rng.randrange(1, 60)), "en", rng.choice(["hot", "hot", "é", "z", "", None])) for i in range(400)]
    got = mixture.mix(corpus(rows)).collect()
    assert len(got) == len(rows)
    by, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in got:
        by[r.source] += r.size
        target[r.source] = r.target
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(words(t))) for i, t, _, _ in rows)
    weights = dict(zip(sorted(by, key=lambda s: (s is None, s or "")), [3, 1, 2] * 9))
    want, open_, full = 1.5 * sum(by.values()), set(by), {}
    while over := [s for s in open_ if want * weights[s] / sum(weights[x] for x in open_) > 2 * by[s]]:
        for s in over:
            full[s] = 2.0 * by[s]
            open_.discard(s)
        want = 1.5 * sum(by.values()) - sum(full.values())
    for s in by:
        assert target[s] == pytest.approx(full.get(s, want * weights[s] / sum(weights[x] for x in open_) if s in open_ else 0))
        assert abs(taken[s] - target[s]) <= max(3, 0.03 * target[s])
    again = mixture.mix(corpus(rows).repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixture.mix(corpus([])).count() == 0
    assert [r.taken for r in mixture.mix(corpus([(1, None, "en", None)])).collect()] == [0]


def test_apportion_is_highest_quotients(spark):
    rng = random.Random(2)
    rows = [(g, i, rng.choice([0, 1, rng.randrange(1000)]), 37 * g) for g in range(1, 6) for i in range(12)]
    df = spark.createDataFrame(rows, "g long, i long, votes long, seats long")
    got = {(r.g, r.i): r.quota for r in mixture.apportion(df, ["g"], "votes", "seats", ["i"]).collect()}
    for g in range(1, 6):
        quotients = sorted(((-v / (2 * j + 1), i, j) for gg, i, v, s in rows if gg == g and v for j in range(s)))
        won = Counter(i for _, i, _ in quotients[: 37 * g])
        assert {i: got[g, i] for i in range(12)} == {i: won[i] for i in range(12)}


def test_groups_of_blocks_are_bounded(spark, monkeypatch):
    """A tile of many classes that are all apart: blocks count once for each pair they are in."""
    monkeypatch.setattr(jaccard, "TILE_ROWS", 64)
    n, limit = 3000, 1 << 18
    tiles = spark.range(n).select(F.lit(7).cast("long").alias("sig"), F.col("id").alias("f"))
    bitmaps = tiles.select("f", F.lit(500).cast("long").alias("n"), F.lit(b"x" * 128).alias("bits"))
    labels = spark.createDataFrame([], "node long, root long")
    members = jaccard.unresolved_members(tiles, labels, bitmaps, limit)
    sizes = [r.b for r in members.groupBy("group").agg(F.sum(F.octet_length("bits") + 64).alias("b")).collect()]
    assert max(sizes) <= 2 * limit and len(sizes) > 20
    pairs = members.select("i", "j").distinct().count()
    blocks = -(-n // 64)
    assert pairs == blocks * (blocks + 1) // 2


def test_language_sample(corpus):
    """Languages take turns, a text counts once, the rarest language is learned, and partitions do not matter."""
    rows = [(i, f"the common words {i % 2000}" if i % 3 else "one text a third of the rows hold", "en", None) for i in range(6000)]
    rows += [(10_000 + i, f"seltene Worte {i}", "de", None) for i in range(6)] + [(20_000, None, "fr", None), (None, "sans", "fr", None), (20_001, "x" * 20_000, "fr", None)]
    rows += [(3, "the common words 3", "en", None)] * 3
    usable = {(r[1], r[2]) for r in rows if r[0] is not None and r[1] and len(r[1]) <= langid.TRAIN_BYTES and zlib.crc32(str(r[0]).encode()) % 4 != langid.HELD_OUT}
    rare = {u for u in usable if u[1] == "de"}
    docs = corpus(rows)
    got = [(r.text, r.lang) for r in langid.sample(docs).collect()]
    assert rare and len(got) == len(set(got)) == langid.TRAIN_DOCS and set(got) <= usable
    assert {g for g in got if g[1] == "de"} == rare
    assert set(got) == {(r.text, r.lang) for r in langid.sample(docs.repartition(64)).collect()}
    assert langid.sample(corpus([])).count() == 0


def test_language(corpus, spark):
    tables = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(tables)
    model = langid.train(docs)
    found = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    truth = [(r.doc_id, r.lang) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(found[i].lang_pred == lang for i, lang in truth) >= 0.97 * len(truth)
    texts = {r.lang: r.text for r in docs.filter("n_chars > 2000").collect()}
    both = " ".join(texts["en"].split()[:60] + texts["fr"].split()[:40])
    odd = [(1, None, None, None), (2, "", None, None), (3, "12 ,;", None, None), (4, "\U0001F600 €", None, None), (5, both, None, None), (6, both, None, None),
           (6, both, None, None), (None, "the", None, None), (7, "日本", None, None), (8, texts["de"] * 30, None, None)]
    got = {r.doc_id: r for r in langid.identify(corpus(odd), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and [got[i].score for i in (1, 2, 3, 4)] == [0.0] * 4
    assert got[5].lang_pred == "en" and 1 <= got[5].n_switches <= 8 and 0.5 < got[5].score < 0.75
    assert got[8].lang_pred == "de" and got[7].lang_pred != "und" and got[None].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in langid.identify(corpus(odd), langid.train(corpus([]))).collect()} == {"und"}
    assert langid.identify(corpus([]), model).count() == 0


def test_forward_backward_is_exact():
    """Probabilities against the sum over all labellings."""
    import itertools

    rng = np.random.default_rng(0)
    scores, start, move = rng.normal(size=(1, 5, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    total, marginal, pairs = 0, np.zeros((5, 3)), np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=5):
        p = np.exp(start[path[0]] + sum(scores[0, t, x] for t, x in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
        total += p
        for t, x in enumerate(path):
            marginal[t, x] += p
        for a, b in zip(path, path[1:]):
            pairs[a, b] += p
    padded = np.concatenate([scores, np.zeros((1, 3, 3))], axis=1)
    valid = np.array([[True] * 5 + [False] * 3])
    gamma, xi = langid.forward_backward(padded, valid, start, move, pairs=True)
    np.testing.assert_allclose(gamma[0, :5], marginal / total)
    np.testing.assert_allclose(xi, pairs / total)
    assert not gamma[0, 5:].any()



def test_unseen_chunks_are_taken_out_together(encoder, monkeypatch):
    """Chunks that a worker has not seen leave the buffer in one step per piece, whole and in order, with their ids."""
    import pyarrow as pa

    texts = [*ODD, None, "", "z\U0001F600 é\n　x " * 50]
    learned = []
    keep = chunks.Encoder._learn
    monkeypatch.setattr(chunks.Encoder, "_learn", lambda self, new: learned.extend(new) or keep(self, new))
    encoder.reset()
    for c in chunks.chunked(pa.array(texts), encoder.whole):
        cut = [c.data[a:b].tobytes().decode() for a, b in zip(c.starts, c.ends)]
        some = np.array([len(cut) - 1, 0, 2])
        assert c.texts(some) == [cut[i] for i in some] and c.texts(np.arange(len(cut))) == cut
        ids, lengths = encoder.expand(encoder.entries(c))
        at = np.concatenate([[0], np.cumsum(lengths)])[c.bounds]
        for i, (lo, hi) in enumerate(zip(at[:-1], at[1:])):
            assert ids[lo:hi].tolist() == encoder.encode([texts[c.first + i] or ""])[0]
        assert set(cut) <= set(learned) and len(learned) == len(set(learned))


def longest_run(table):
    edges = np.flatnonzero(np.diff(np.concatenate([[0], table.keys != 0, [0]]).astype(int)))
    return int((edges[1::2] - edges[::2]).max())


@pytest.mark.parametrize("chosen", ["smallest of eight", "range", "any"])
def test_chosen_keys_do_not_crowd(chosen):
    rng = np.random.default_rng(7)
    keys = rng.integers(1, 1 << 64, (6000, 8), dtype=np.uint64)
    keys = np.unique({"smallest of eight": keys.min(axis=1), "range": keys[:, 0] >> np.uint64(5), "any": keys[:, 0]}[chosen])
    table = chunks.HashTable()
    table.add(keys[::2], np.arange(len(keys[::2]), dtype=np.int32))
    assert longest_run(table) < 64
    assert (table.find(keys[::2]) == np.arange(len(keys[::2]))).all() and (table.find(keys[1::2]) == -1).all()


def test_windows_are_looked_up_without_crowding():
    rng = random.Random(3)
    items = [(str(i), " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))) for i in range(200)]
    index = decontaminate.prefix_index(decontaminate.cut_windows(items, 10), {})  # all shingles equally rare
    assert index.table.count > 1000 and longest_run(index.table) < 64


def test_words_take_little_memory():
    """A worker holds a few times a small piece of the texts while it finds words, however many there are; pieces change nothing."""
    import tracemalloc

    import pyarrow as pa

    from tidegrid.llm import textops

    column = pa.array(["some words of a text that is cut " * 30] * 4000)
    tracemalloc.start()
    try:
        found = [p.hashes for p in textops.word_pieces(column, textops.NOT_SPACE, True)]
        held = sum(h.nbytes for h in found)
        assert tracemalloc.get_traced_memory()[1] - held < 20 << 20
    finally:
        tracemalloc.stop()
    whole = [p.hashes for p in textops.word_pieces(column, textops.NOT_SPACE, True, 1 << 30)]
    assert len(found) > 8 and len(whole) == 1 and (np.concatenate(found) == whole[0]).all()
