"""Ranked search against scores worked out document by document."""

import math
import random
import re
from collections import Counter

import pytest

from replyforge.llm import lexical_search
from replyforge.llm.lexical_search import Postings, build, search

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
A_Z = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return WORD.findall((text or "").translate(A_Z))


def search_by_hand(docs, queries, k):
    """Every document's score for every query; None stands in front of all keys."""
    counted = [(key, Counter(terms(text))) for key, text in docs]
    counted = [(key, c, sum(c.values())) for key, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    found = []
    for item, text in set(queries):
        scores = []
        for key, own, n in counted:
            m = 25 + 75 * n * n_docs // n_terms
            score = 0
            for t, times in Counter(terms(text)).items():
                if own[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * own[t] // (1000 * own[t] + 8 * m))
            if score:
                scores.append((-score, key is not None, key or 0))
        found += [(item, r, k_ if there else None, -s) for r, (s, there, k_) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found, key=str)


def made_docs(seed, n, vocabulary=60):
    numbers = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    odds = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(numbers.choices(words, odds, k=int(numbers.paretovariate(0.8)) % 400 + 1))) for i in range(n)]


def rows_of(spark, docs, queries, k=10, parts=3):
    index = build(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts))
    found = search(index, spark.createDataFrame(queries, "item_id long, text string"), k)
    return sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("shard, stretch", [(1 << 21, (512, 16_384)), (3000, (16, 64)), (40, (4, 4))])
def test_ranks_of_made_documents(spark, monkeypatch, shard, stretch):
    monkeypatch.setattr(lexical_search, "SHARD_TERMS", shard)
    monkeypatch.setattr(lexical_search, "STRETCH", stretch)
    docs = made_docs(1, 900)
    queries = [(i, text) for i, (_, text) in enumerate(made_docs(2, 25, 70))] + [(99, "nowhere"), (98, "w0 w0 W1"), (97, None)]
    assert rows_of(spark, docs, queries) == search_by_hand(docs, queries, 10)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "QUERY_TERMS", 30)
    docs, queries = made_docs(3, 200), made_docs(4, 30)
    assert rows_of(spark, docs, queries, 3) == search_by_hand(docs, queries, 3)


def test_blocks_that_cannot_score_stay_packed(spark, monkeypatch):
    """One rare term decides: almost nothing of the frequent term's list is unpacked."""
    docs = [(i, "common " * (1 + i % 5) + f"filler{i}") for i in range(20_000)] + [(50_000 + i, "rare common") for i in range(10)]
    index = build(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    asked = index.where("term IN (CAST('rare' AS BINARY), CAST('common' AS BINARY)) OR term IS NULL").toArrow()
    searcher = lexical_search.Searcher(asked, len(docs), sum(len(t.split()) for _, t in docs))
    weights = [(t, lexical_search.weight(len(docs), d)) for t, d in ((b"rare", 10), (b"common", len(docs)))]
    best, keys = searcher.best(weights, 10)
    assert sorted(keys.tolist()) == list(range(50_000, 50_010))
    common: Postings = searcher.lists[b"common"]
    assert common.ready.sum() < 0.05 * len(common.ready)


def test_ties_repeats_and_very_common_terms(spark):
    docs = [(i, "same text here") for i in range(300)] + [(5, "same text here"), (None, "same text here"), (None, None), (7, ""), (8, "!!")]
    queries = [(1, "same"), (1, "text here"), (1, "same"), (2, "SAME élan")]
    assert rows_of(spark, docs, queries) == search_by_hand(docs, queries, 10)


def test_odd_rows(spark, odd_docs, odd_rows):
    queries = [(r[0] or 0, r[1]) for r in odd_rows]
    shown = spark.createDataFrame([(i, t, "x") for i, t in queries], "item_id long, text string, score string")
    found = search(build(odd_docs), shown)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    want = search_by_hand([(r[0], r[1]) for r in odd_rows], queries, 10)
    assert sorted(map(tuple, found.collect()), key=str) == want


def test_counts_above_a_byte(spark):
    docs = [(1, "a " * 300 + "b"), (2, "a b " * 40_000), (3, "b")] + [(10 + i, "c") for i in range(300)]
    queries = [(1, "a b"), (2, "c a")]
    assert rows_of(spark, docs, queries, parts=1) == search_by_hand(docs, queries, 10)


def test_no_rows(spark, no_docs):
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(build(no_docs), some).collect() == []
    assert search(build(spark.createDataFrame([(1, "a")], "doc_id long, text string")), some.limit(0)).collect() == []
