"""Ranked search against plain scoring of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import VOCABULARY, folded, prose

from tidegrid.llm import ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute(docs, items, k=50):
    terms = [(i, Counter(TERM.findall(folded(t)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n_docs, n_words = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall(folded(t)))
    out = []
    for item, query in asked.items():
        scores = []
        for i, c in terms:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in query if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return Counter(out)


def texts(seed, n, words=400, size=60):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(words)] + VOCABULARY
    weights = [1 / (i + 1) for i in range(len(names))]
    return [" ".join(rng.choices(names, weights, k=rng.randrange(1, size))) for _ in range(n)]


ITEMS = [(1, "The of and"), (2, "nothing-here zzz"), (3, None), (4, ""), (5, "w3 W3 w5 é 日本"), (5, "w7 w9"), (None, "w1 w200"), (7, "the"), (8, "w390 w391 w392 foo bar")]


@pytest.mark.parametrize("k", [50, 3])
def test_search(spark, corpus, awkward, k):
    rows = awkward + [(1000 + i, t, "en", "a") for i, t in enumerate(texts(1, 400))] + [(1000 + i, t, "en", "a") for i, t in enumerate(texts(1, 30))]
    items = ITEMS + [(100 + i, t) for i, t in enumerate(texts(2, 20, size=30))]
    got = ranked.ranked_search(corpus(rows).repartition(3), spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS term", "1 AS item"), k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == brute([(r[0], r[1]) for r in rows], items, k)


def _shard(docs, queries_terms, lo, hi):
    """A shard over documents given as {term number: times}, with all weights fixed."""
    weights = np.array([7000.0 / (t + 1) // 1 for t in range(hi)])
    bounds = np.concatenate([[0], np.cumsum([len(q) for q in queries_terms])])
    q = ranked.Queries(bounds, np.concatenate([np.sort(list(x)) for x in queries_terms]).astype(np.int64), weights, len(docs), sum(sum(d.values()) for d in docs))
    sizes = np.array([len(d) for d in docs])
    terms = np.concatenate([np.sort(list(d)) for d in docs]).astype(np.int32)
    times = np.concatenate([[d[t] for t in sorted(d)] for d in docs]).astype(np.int32)
    n = np.array([sum(d.values()) for d in docs])
    return q, ranked.Shard(np.arange(len(docs)), list(range(len(docs))), np.concatenate([[0], np.cumsum(sizes)]), terms, times, n, q)


def made(seed, n_docs, n_terms=300, n_queries=30):
    rng = random.Random(seed)
    pick = lambda: min(n_terms - 1, int(rng.paretovariate(0.6)) - 1)
    docs = [dict(Counter(pick() for _ in range(rng.randrange(5, 40)))) for _ in range(n_docs)]
    docs += [dict(docs[rng.randrange(50)]) for _ in range(n_docs // 3)]
    return docs, [sorted({rng.randrange(n_terms) for _ in range(rng.randrange(1, 25))}) for _ in range(n_queries)]


@pytest.mark.parametrize("seed,postings", [(1, 1), (2, 5), (3, 64)])
def test_blocks_are_skipped_only_when_they_cannot_matter(monkeypatch, seed, postings):
    monkeypatch.setattr(ranked, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(ranked, "SUMMARY_CELLS", 500)
    docs, queries = made(seed, 900)
    q, shard = _shard(docs, queries, 0, 300)
    top = ranked.Top(10, np.zeros(len(queries)))
    scored = shard.search(top)
    full = 0
    for i, query in enumerate(queries):
        weights = np.zeros(300)
        weights[query] = q.weights[query]
        scores = shard.scores(np.arange(len(docs)), weights)
        full += int((scores > 0).sum())
        best = sorted(((-int(s), shard.ids[d]) for d, s in enumerate(scores) if s > 0))[:10]
        assert [(x[0], x[2]) for x in sorted(top.best[i].values())] == best
    again = ranked.Top(10, top.least)  # the score to beat known at the start
    assert shard.search(again) < scored < 3 * full
    assert again.best == top.best


def test_bounds_hold():
    docs, queries = made(5, 300)
    q, shard = _shard(docs, queries, 0, 300)
    for term in range(0, 300, 7):
        items = q.holders[q.held[term] : q.held[term + 1]]
        inside = shard.posting[shard.lists[term] : shard.lists[term + 1]]
        for i in items:
            weights = np.zeros(300)
            weights[q.of(i)] = q.weights[q.of(i)]
            bound = shard.summary(term, q.of(i)) @ q.weights[q.of(i)]
            scores = shard.scores(inside, weights)
            assert (scores <= np.repeat(bound, ranked.BLOCK_POSTINGS)[: len(inside)]).all()


def test_several_passes(spark, corpus, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_TERMS", 20)
    docs = [(i, t, None, None) for i, t in enumerate(texts(3, 60))]
    items = [(i, t) for i, t in enumerate(texts(4, 12, size=12))]
    got = ranked.ranked_search(corpus(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute([r[:2] for r in docs], items)


def test_empty_tables(spark, corpus):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked.ranked_search(corpus([]), items).collect() == []
    assert ranked.ranked_search(corpus([(1, "the", None, None)]), items.limit(0)).collect() == []
    assert ranked.ranked_search(corpus([(None, None, None, None), (2, "", None, None)]), items).collect() == []


def test_sql_says_the_same(corpus, awkward):
    import duckdb
    import pyarrow as pa

    from tidegrid.llm.sqltext import RANKED

    docs, items = [(i, t) for i, t, _, _ in awkward], ITEMS + [(50, prose(random.Random(3), 30))]
    documents = pa.table({"doc_id": pa.array([d[0] for d in docs], pa.int64()), "text": pa.array([d[1] for d in docs], pa.string())})  # noqa: F841
    benchmark = pa.table({"item_id": pa.array([i[0] for i in items], pa.int64()), "text": pa.array([i[1] for i in items], pa.string())})  # noqa: F841
    assert Counter(duckdb.sql(RANKED).fetchall()) == brute(docs, items)
