"""Suffix-array dedup where one passage is in most rows: right results, and no task that gets an entry per row."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyforge.llm import packed, suffix_dedup
from tests.llm.test_duplicates import check_cut

PASSAGE = "the one passage that very many of the rows hold, word for word and always the same, over some two hundred bytes"


def hot_rows(n):
    numbers = random.Random(n)
    own = lambda: "".join(numbers.choice("abcdefghij ") for _ in range(numbers.randint(0, 90)))
    rows = [(key, own() + PASSAGE + own()) for key in range(n)]
    rows += [(n + key, own()) for key in range(20)]
    rows += [(n + 30, PASSAGE + "|" + PASSAGE + "|" + PASSAGE), (3, PASSAGE * 2), (3, PASSAGE * 2), (3, "x" + PASSAGE)]  # within a row, equal keys
    return rows + [(None, own() + PASSAGE) for _ in range(9)] + [(None, PASSAGE)] * 3


@pytest.mark.parametrize("hot", [5, 1 << 16])
def test_cut_of_a_passage_in_most_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot, raising=False)
    rows = hot_rows(150)
    check_cut(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)
    only_null = [(None, t) for _, t in rows[:40]] + [(7, t) for _, t in rows[20:60]]
    check_cut(spark.createDataFrame(only_null, "doc_id long, text string").repartition(4), only_null)


def test_entries_of_a_hot_anchor(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 50, raising=False)
    docs = spark.createDataFrame(hot_rows(2000), "doc_id long, text string").repartition(4)
    rows, n_buckets = suffix_dedup._rows(docs, "doc_id", "text", []), 4
    shared = suffix_dedup._shared(suffix_dedup._anchor_rows(rows, n_buckets), n_buckets)
    sent = suffix_dedup._segments(suffix_dedup._texts(rows, n_buckets), shared, n_buckets).where(F.col("bucket") < n_buckets)
    entries = Counter(packed.gather(sent.toArrow(), "grams", np.uint64).tolist())
    assert max(entries.values()) <= 50 * n_buckets
