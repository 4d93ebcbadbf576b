"""The quality query against features, table look-ups and trees worked out one by one."""

import itertools
import math
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pytest

from replyforge.llm import quality_model, queries

SF_DIR = "/root/testdata/sf0.001"


def features_by_hand(text):
    """One text's features in plain Python, in the order of ``FEATURES``."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(quality_model.FEATURES)
    is_mark = lambda b: 32 < b < 127 and not chr(b).isalnum()
    count = lambda test: sum(1 for b in data if test(b))
    words = [w for w in re.split(rb"[ \t\n\x0b\f\r]", data) if w]
    solid = max(count(lambda b: b not in b" \t\n\x0b\f\r"), 1)
    some, newline = max(len(words), 1), data.count(b"\n")
    pairs = list(itertools.pairwise(words))
    lines = [x for x in re.findall(rb"[^\n]*\n|[^\n]+", data) if len(x) > 1]
    return [
        math.log1p(len(data)),
        math.log1p(len(words)),
        solid / some,
        count(lambda b: 65 <= b <= 90) / solid,
        count(lambda b: 48 <= b <= 57) / solid,
        count(is_mark) / solid,
        count(lambda b: b < 128 and chr(b) in "#*$%&|<>@^~_{}[]\\/=+") / solid,
        count(lambda b: b in b"!?") / solid,
        count(lambda b: b > 127) / solid,
        len(words) / (newline + 1),
        len(set(words)) / some,
        max(Counter(words).values(), default=0) / some,
        sum(a == b for a, b in pairs) / some,
        len(set(pairs)) / max(len(words) - 1, 1),
        1 - len(set(lines)) / max(len(lines), 1),
        sum(is_mark(w[-1]) for w in words) / some,
    ]


def score_by_hand(model, text):
    row = features_by_hand(text)
    bins = [bisect_right(list(edges), value) for edges, value in zip(model.edges, row, strict=True)]
    total = model.base + sum(table[b] for table, b in zip(model.tables, bins, strict=True))
    total += sum(table[bins[i], bins[j]] for i, j, table in model.pairs)
    return 1 / (1 + math.exp(-total))


def test_query_by_hand(spark):
    model = queries.learnt_quality(spark, SF_DIR)
    assert len(model.tables) == len(quality_model.FEATURES) and model.pairs
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SF_DIR, "documents").collect()}
    found = queries.op7_quality_model(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        want = score_by_hand(model, texts[r["doc_id"]])
        assert r["score"] == pytest.approx(want, rel=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.3)


def test_odd_texts_by_hand(spark, odd_docs, odd_rows):
    model = queries.learnt_quality(spark, SF_DIR)
    found = sorted((r["doc_id"] or 0, r["score"]) for r in quality_model.score(odd_docs, model).select("doc_id", "score").collect())
    want = sorted((row[0] or 0, score_by_hand(model, row[1])) for row in odd_rows)
    assert [k for k, _ in found] == [k for k, _ in want]
    assert [s for _, s in found] == pytest.approx([s for _, s in want], rel=1e-9)


def tree_by_hand(g, h, smooth):
    """Every cut of the bins, then every cut of each side; the first of the best ones."""
    gain = lambda a, b: sum(g[a:b]) ** 2 / (sum(h[a:b]) + smooth)

    def cut(a, b):
        return max(range(a + 1, b), key=lambda c: (round(gain(a, c) + gain(c, b), 9), -c)) if b - a > 1 else a

    middle, out = cut(0, len(g)), [0.0] * len(g)
    for a, b in ((0, middle), (middle, len(g))):
        c = cut(a, b) if b > a else a
        for x, y in ((a, c), (c, b)):
            out[x:y] = [sum(g[x:y]) / (sum(h[x:y]) + smooth)] * (y - x)
    return out


def test_trees_by_hand():
    numbers = np.random.default_rng(3)
    for n in (1, 2, 3, 5, 12):
        for _ in range(20):
            g, h = numbers.normal(size=n), numbers.uniform(0.1, 2, size=n)
            assert quality_model.shallow_tree(g, h, 2.0).tolist() == pytest.approx(tree_by_hand(g.tolist(), h.tolist(), 2.0))
