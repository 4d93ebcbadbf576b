"""The near-duplicate stage of the pipeline at its own shingle size and similarity."""

import random
import re

import corpus_pipeline
import pytest

from replyforge.llm import jaccard_join
from tests.llm.test_duplicates import near_copies


def components(rows, percent, size):
    """(key, shingles, smallest key reachable) of every row by comparing all pairs."""
    sets = []
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        sets.append((key, {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}))
    least = {k: k for k, _ in sets}
    changed = True
    while changed:
        changed = False
        for a, x in sets:
            for b, y in sets:
                if least[a] < least[b] and 100 * len(x & y) >= percent * len(x | y):
                    least[b], changed = least[a], True
    return sorted((k, len(s), least[k]) for k, s in sets)


def between(seed=5):
    """Pairs of 300 words with 20 to 32 neighbouring words replaced, and with 60 appended: some only link at 80 % of five words."""
    numbers, rows = random.Random(seed), []
    for n in range(20, 33):
        base = [f"w{numbers.randrange(10**6)}" for _ in range(300)]
        other = base[:100] + [f"x{numbers.randrange(10**6)}" for _ in range(n)] + base[100 + n :]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(other))]
    base = [f"w{numbers.randrange(10**6)}" for _ in range(300)]
    return [*rows, (len(rows), " ".join(base)), (len(rows) + 1, " ".join([*base, *(f"y{i}" for i in range(60))]))]


@pytest.mark.parametrize("make", [between, near_copies])
def test_five_words_at_eighty_percent(spark, make):
    rows = make(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = components(rows, 80, 5)
    found = jaccard_join.join_components(docs, percent=80, size=5)
    assert sorted(tuple(r) for r in found.collect()) == want
    kept = corpus_pipeline.ngram_jaccard_join(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [k for k, _, least in want if k == least]


def test_the_limits_differ():
    rows = between()
    assert components(rows, 80, 5) != [(k, n, least) for k, n, least in components(rows, 85, 5)]
    assert sum(k == least for k, _, least in components(rows, 80, 5)) < sum(k == least for k, _, least in components(rows, 85, 4))


def test_rows_that_repeat_a_kept_key(spark):
    copy, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, copy), (1, copy), (1, other), (2, copy), (3, None), (3, None), (4, "c d"), (None, copy), (None, copy)]
    docs = spark.createDataFrame([(k, t, "n") for k, t in rows], "doc_id long, text string, name string").repartition(3)
    kept = jaccard_join.deduplicate(docs, percent=80, size=5)
    want = [(1, copy), (1, other), (3, None), (4, "c d"), (None, copy), (None, copy)]
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(want, key=str)
