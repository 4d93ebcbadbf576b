"""Packing against the tokenizer library and a plain form of the rule."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from replyforge.llm.packing import assign, capacities, cost, pack

WORD = public_tokenizers.path("word_bpe_49k.json")


def assign_by_hand(sizes, length, quadratic):
    """The same rule with plain lists: longest piece first, cheapest sequence with room for it, else cut."""
    room = [int(c) for c in capacities(sum(sizes), length)]
    full, spent, waiting, pieces = room[:], [0.0] * len(room), [(n, i, 0) for i, n in enumerate(sizes) if n], []
    while waiting:
        n, document, start = min(waiting, key=lambda w: (-w[0], w[1], w[2]))
        waiting.remove((n, document, start))
        fits = [q for q in range(len(room)) if room[q] >= n] or [q for q in range(len(room)) if room[q]]
        place = min(fits, key=lambda q: (spent[q], q))
        taken = min(n, room[place])
        pieces.append((document, start, taken, place, full[place] - room[place]))
        room[place] -= taken
        spent[place] += taken + quadratic * taken * taken
        if taken < n:
            waiting.append((n - taken, document, start + taken))
    return pieces


@pytest.mark.parametrize("length", [8, 64, 100])
def test_assignment_follows_the_rule(length):
    numbers = random.Random(length)
    for _ in range(60):
        sizes = [numbers.randint(0, length) for _ in range(numbers.randint(0, 40))]
        assert assign(sizes, length, 0.01) == assign_by_hand(sizes, length, 0.01)


def test_no_padding_and_even_cost():
    numbers = random.Random(1)
    sizes = [numbers.randint(1, 700) for _ in range(2000)]
    pieces = assign(sizes)
    full = len([c for c in capacities(sum(sizes), 2048) if c == 2048])
    filled, spent = defaultdict(int), defaultdict(float)
    for _, _, n, q, _ in pieces:
        filled[q] += n
        spent[q] += cost(n)
    assert all(n == 2048 or n & (n - 1) == 0 for n in filled.values())
    assert max(spent[q] for q in range(full)) < 1.05 * min(spent[q] for q in range(full))
    assert len(pieces) <= len(sizes) + len(filled)


def checked(found, texts, length):
    """Texts by their pieces: every id once, in its place, and sequences full or a power of two long."""
    library, sequences, documents = Tokenizer.from_file(WORD), defaultdict(list), defaultdict(list)
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or at & (at - 1) == 0
    for key, text in texts.items():
        want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        parts = sorted(documents.pop(key))
        assert sum((ids for _, ids, _ in parts), []) == want
        assert [s for s, _, _ in parts] == np.cumsum([0, *[len(ids) for _, ids, _ in parts]])[:-1].tolist()
        assert {n for _, _, n in parts} == {len(want)}
    assert not documents


def test_pieces_of_odd_rows(spark, odd_rows):
    """Each row a document of its own: keys made different to tell repeated rows apart."""
    schema = "doc_id long, text string, length string, ids int"
    rows = [(i, r[1], "x", 5) for i, r in enumerate(odd_rows)]
    docs = spark.createDataFrame(rows, schema).repartition(2)
    for length, group in ((2048, 1 << 21), (64, 1000)):
        found = pack(docs, WORD, length=length, group_tokens=group).collect()
        checked(found, {i: t for i, t, *_ in rows}, length)


def test_null_and_repeated_keys(spark, odd_docs, odd_rows):
    library = Tokenizer.from_file(WORD)
    found = pack(odd_docs, WORD).groupBy("doc_id").sum("length").collect()
    want = defaultdict(int)
    for key, text, *_ in odd_rows:
        want[key] += len(library.encode(text or "", add_special_tokens=False).ids) + 1
    assert {r[0]: r[1] for r in found} == want


def test_no_rows(no_docs):
    found = pack(no_docs, WORD)
    assert found.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "cost"]
    assert found.collect() == []
