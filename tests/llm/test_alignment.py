"""Cross-tokenizer alignment against a plain version over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from conftest_llm import prose
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegrid.llm import alignment

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [" ", "  ", "\n", "a▁b", "<|endoftext|>", "x <|endoftext|> y", "<s> </s>", "<0x41> <unk>", "1111111111111", "a  b   c ", "\n\n x\n\n", "é日本　y",
       "\U0001F600 \U0001F600", "a\x00b", "y" * 3000, "ab12" * 800, "  x", "x  y", "x \t y", " x", "ﬁ Å"]


@pytest.fixture(scope="module")
def both():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def letters():
    """Byte of each letter of a byte-level vocabulary, as the library's own decoder tells it."""
    from tokenizers.pre_tokenizers import ByteLevel

    alphabet = sorted(ByteLevel.alphabet())
    return {c: ord(c) if ord(c) < 256 else None for c in alphabet}


def plain(both, text):
    """Groups of the whole text, by comparing every pair of ends."""
    a, b = both
    if not text:
        return []
    one, two = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    known = letters()
    rest = iter(sorted(set(range(256)) - {x for x in known.values() if x is not None}))
    table = {c: x if x is not None else next(rest) for c, x in sorted(known.items(), key=lambda k: ord(k[0]))}
    told_a = [bytes(table[c] for c in a.id_to_token(i)) for i in one]
    told_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in two)]
    if b"".join(told_a) != (" " + text).encode() or b"".join(told_b) != (" " + text).encode():
        return []
    groups, here, i, j, x, y = [], ([], []), 0, 0, 0, 0
    while i < len(told_a) or j < len(told_b):
        if x <= y and i < len(told_a):
            x += len(told_a[i])
            here[0].append(one[i])
            i += 1
        else:
            y += len(told_b[j])
            here[1].append(two[j])
            j += 1
        if x == y:
            groups.append(here)
            here = ([], [])
    return groups


def brute(both, rows):
    groups = [plain(both, t) for _, t in rows]
    linked = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    count, most = Counter(p for found in linked for p in set(found)), defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = Counter()
    for (i, _), g, found in zip(rows, groups, linked):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out[i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(found), sum(count[p] == most[p[0]] for p in found),
            sum(count[p] for p in found), hashlib.sha256(text.encode()).hexdigest() if g else ""] += 1
    return out


def digest(df):
    from pyspark.sql import functions as F

    df = df.withColumn("sha", F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(""))
    return Counter(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha").collect())


@pytest.mark.parametrize("frequent", [1 << 17, 40])
def test_alignment(corpus, awkward, both, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT_PAIRS", frequent)
    rows = [r for r in awkward if len(r[1] or "") < 4000] + [(100 + i, t, "en", "a") for i, t in enumerate(ODD)]
    found = alignment.score_links(alignment.align(corpus(rows).repartition(3), A, B))
    assert digest(found) == brute(both, [r[:2] for r in rows])


def test_long_text(corpus, both):
    rows = [(1, prose(random.Random(3), 60_000), "en", "a"), (2, "0123456789" * 20_000, "en", "a"), (3, "日本語é" * 5000, None, None)]
    assert digest(alignment.score_links(alignment.align(corpus(rows), A, B))) == brute(both, [r[:2] for r in rows])


def test_empty_and_null(corpus):
    assert alignment.score_links(alignment.align(corpus([]), A, B)).count() == 0
    rows = [(None, None, None, None), (None, "", None, None), (7, None, "en", "a")]
    found = alignment.score_links(alignment.align(corpus(rows), A, B)).collect()
    assert sorted((r.doc_id is None, r.n_a, r.n_links, r.count_sum, r.groups) for r in found) == [(False, 0, 0, 0, ""), (True, 0, 0, 0, ""), (True, 0, 0, 0, "")]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=30), st.lists(st.sampled_from([" ", "  ", "a", "bc", "\n", "日", "1", "'s", " ", "."]), max_size=12).map("".join)), min_size=1, max_size=8))
def test_stretches_make_whole_texts(aligner, both, texts):
    """Cut at spaces or read whole, the groups are the same."""
    import pyarrow as pa

    spaced = pa.array([" " + t if t else None for t in texts], pa.string())
    got = [x for rows in aligner.read(spaced) for x in rows.column("groups").to_pylist()]
    assert got == [alignment.told([(a, b) for a, b in plain(both, t)]) for t in texts]


def test_cache_is_bounded(aligner, both, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(alignment, "CACHE_ENTRIES", 3)
    rng = random.Random(2)
    for text in [prose(rng, 40) for _ in range(10)]:
        (rows,) = aligner.read(pa.array([" " + text]))
        assert rows.column("groups").to_pylist() == [alignment.told(plain(both, text))]
    assert len(aligner.texts) < 100
