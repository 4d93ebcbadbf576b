"""Suffix-array dedup and the Jaccard join against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyforge.llm import jaccard_join, suffix_dedup
from replyforge.llm.suffix_groups import suffix_arrays

ALL = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def cut_by_hand(rows):
    """{(key, text): (bytes, removed, spans, digest)}; a null key is larger than all."""
    first = {}
    order = lambda k: (k is None, k or 0)
    for key, text in sorted(rows, key=lambda r: order(r[0])):
        for at in range(len(text) - 49):
            first.setdefault(text[at : at + 50], key)
    found = {}
    for key, text in rows:
        gone = bytearray(len(text))
        for at in range(len(text) - 49):
            if order(first[text[at : at + 50]]) < order(key):
                gone[at : at + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        found[key, text] = (len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return found


def check_cut(docs, rows):
    rows = [(r[0], (r[1] or "").encode()) for r in rows]
    want = sorted([(k is None, k or 0, *v) for k, v in ((r[0], cut_by_hand(rows)[r]) for r in rows)])
    got = suffix_dedup.remove_repeats(docs, outputs=ALL).collect()
    assert sorted([(g[0] is None, g[0] or 0, *g[1:]) for g in got]) == want


def test_suffix_arrays_of_many_strings():
    numbers = random.Random(7)
    for _ in range(200):
        strings = [[numbers.randint(1, 3) for _ in range(numbers.randint(0, 25))] for _ in range(numbers.randint(1, 6))]
        want, at = [], 0
        for s in strings:
            want += [at + i for i in sorted(range(len(s)), key=lambda i, s=s: s[i:])]
            at += len(s)
        symbols, lengths = np.array([c for s in strings for c in s], np.int64), np.array([len(s) for s in strings])
        assert suffix_arrays(symbols, lengths).tolist() == want


def test_cut_of_odd_rows(odd_docs, odd_rows):
    short = [r for r in odd_rows if len(r[1] or "") < 100_000]
    check_cut(odd_docs.where("coalesce(length(text), 0) < 100000"), short)


def test_cut_of_a_very_long_text(odd_docs):
    found = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(odd_docs, outputs=ALL).where("doc_id in (10, 13)").collect()}
    assert found[10]["n_removed"] == 0
    assert found[13]["n_removed"] == found[13]["n_bytes"]  # its text begins like the long one's


@pytest.mark.parametrize("split", [1, 64])
def test_cut_of_texts_with_few_letters(spark, monkeypatch, split):
    """Periodic and overlapping repeats, and anchors with many segments."""
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    numbers = random.Random(split)
    pool = ["".join(numbers.choice("ab") for _ in range(120)) for _ in range(4)] + ["a" * 130, "ab" * 70]
    rows = []
    for key in range(60):
        parts = [numbers.choice(pool)[numbers.randint(0, 40) : numbers.randint(60, 120)] for _ in range(numbers.randint(0, 4))]
        rows.append((key, "é".join(parts)))
    check_cut(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_cut_carries_columns_and_text(odd_docs):
    carried = ["lang", "key", "bucket"]
    found = suffix_dedup.remove_repeats(odd_docs, outputs=("kept_text",), carry=carried)
    assert found.columns == ["doc_id", "kept_text", *carried]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert (rows[2]["kept_text"], rows[2]["lang"], rows[2]["key"], rows[2]["bucket"]) == ("", "en", "k", 1)
    assert rows[11]["lang"] is None


def test_empty_tables(no_docs):
    assert suffix_dedup.remove_repeats(no_docs, outputs=ALL).collect() == []
    assert jaccard_join.join_components(no_docs).collect() == []
    assert jaccard_join.deduplicate(no_docs).collect() == []


def components_by_hand(rows, percent=85):
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        own = {tuple(words[i : i + 4]) for i in range(len(words) - 3)} or ({tuple(words)} if words else set())
        sets.setdefault(key, []).append(own)
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    flat = [(k, s) for k, own in sets.items() for s in own]
    for i, (a, x) in enumerate(flat):
        for b, y in flat[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return sorted((k, len(s), find(k)) for k, s in flat)


def near_copies(seed, n_groups=6, copies=9):
    numbers, rows = random.Random(seed), []
    for g in range(n_groups):
        words = [f"w{numbers.randint(0, 400)}" for _ in range(numbers.choice([3, 12, 60, 150]))]
        for _ in range(copies):
            own = list(words)
            for _ in range(numbers.randint(0, 3)):
                own[numbers.randrange(len(own))] = f"x{numbers.randint(0, 50)}"
            rows.append((len(rows), numbers.choice([" ", "\n"]).join(own).upper() if g % 2 else " ".join(own)))
    return rows


@pytest.mark.parametrize("tile", [2, 7, 1000])
def test_components_of_near_copies(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    rows = near_copies(tile)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(tuple(r) for r in jaccard_join.join_components(docs).collect()) == components_by_hand(rows)


def test_components_of_odd_rows(odd_docs, odd_rows):
    keyed = [(r[0], r[1]) for r in odd_rows if r[0] is not None]
    found = jaccard_join.join_components(odd_docs)
    assert sorted(tuple(r) for r in found.where("doc_id is not null").collect()) == components_by_hand(keyed)
    assert {r["component_id"] for r in found.where("doc_id is null").collect()} == {None}


def test_one_document_of_a_group_stays(odd_docs):
    kept = jaccard_join.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r["doc_id"] for r in kept.where(F.col("doc_id").isNotNull()).collect())
    assert ids == [1, 4, 5, 6, 7, 8, 10, 11, 12, 13]
