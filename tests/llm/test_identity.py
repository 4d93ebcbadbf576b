"""Texts that collide under polynomial hashes: complementary words of a Thue-Morse build."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from replyforge.llm import automaton, presplit, token_count, token_files
from replyforge.llm.decontaminate import mark
from replyforge.llm.jaccard_join import join_components
from replyforge.llm.presplit import PieceTable, cut

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def twins(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return [word, word.translate(str.maketrans("ab", "ba"))]


@pytest.fixture(scope="module")
def docs(spark):
    texts = [*twins(1024), *twins(2048), *twins(4096)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), texts


def test_joined_documents(docs):
    found = join_components(docs[0], percent=85, size=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i for i in range(6)}


def test_token_ids_and_counts(docs, tmp_path):
    frame, texts = docs
    library = Tokenizer.from_file(BYTE)
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    coded = {r["doc_id"]: r for r in automaton.encode_decode(frame, BYTE, outputs=("ids", "decoded_sha256")).collect()}
    assert [coded[i]["ids"] for i in range(6)] == ids
    assert [coded[i]["decoded_sha256"] for i in range(6)] == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    counted = {r["doc_id"]: r["n_tokens"] for r in token_count.token_counts(frame, BYTE).collect()}
    assert [counted[i] for i in range(6)] == list(map(len, ids))
    words = Tokenizer.from_file(WORD)
    want = [zlib.crc32(np.array([*words.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for t in texts]
    found = token_files.read(token_files.write(frame, WORD, str(tmp_path)), str(tmp_path)).orderBy("key").collect()
    assert [r["ids_crc32"] for r in found] == want


def test_benchmark_windows(spark, docs):
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(docs[1]) if i % 2], "item_id string, text string")
    found = {r["doc_id"]: list(r["items"]) for r in mark(docs[0], items, carry=["doc_id"]).collect()}
    assert found == {i: [str(i)] if i % 2 else [] for i in range(6)}


def test_pieces_with_equal_hashes_are_compared(monkeypatch):
    monkeypatch.setattr(presplit, "hash_spans", lambda content, starts, ends: (ends - starts).astype(np.uint64))
    table, asked = PieceTable(), []

    def value(pieces):
        asked.extend(pieces)
        return [p.upper() for p in pieces]

    for texts in (["ab cd ab", "x"], ["cd ef", "ab y x"], ["é ef"]):
        for pieces in cut(texts, False, lambda t: [], (), lambda t: t):
            slots = table.slots_of(pieces, value)
            want = [t for text in texts for t in text.split()]
            assert [table.values[s] for s in slots] == [w.upper() for w in want]
    assert sorted(asked) == ["ab", "cd", "ef", "x", "y", "é"]


def test_words_with_equal_hashes_are_compared(spark, monkeypatch):
    from replyforge.llm import words

    monkeypatch.setattr(words, "hash_spans", lambda content, starts, ends: (ends - starts).astype(np.uint64))
    from replyforge.llm.decontaminate import Index, item_windows, occurrences, prefix_index
    from replyforge.llm.words import words as cut_words
    from replyforge.llm.batches import utf8
    import pyarrow as pa

    windows = item_windows([("1", "one two six"), ("2", "ten two six"), ("3", "eleven")])
    indexes: list[Index] = prefix_index(windows, {})
    found = []
    for group in cut_words(*utf8(pa.array(["a ten two six b", "ONE two six", "twelve eleven", "one two ten"])), solid=False):
        row, start, window = occurrences(group, windows, indexes)
        found += sorted((r, windows.items[w][0]) for r, w in zip(row.tolist(), window.tolist(), strict=True))
    assert found == [(0, "2"), (1, "1"), (2, "3")]
