"""Token files, counts and the automaton against the tokenizer library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from replyforge.llm import token_files
from replyforge.llm.automaton import Codec, build, encode_decode, ids_of
from replyforge.llm.token_count import Counter, count_merges, token_counts
from replyforge.llm.vocabulary import read_vocabulary

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts():
    numbers = random.Random(5)
    letters = [*"aB9 \n\t'strevmld.!#", "é", "ß", "\xa0", "\x85", "\x1c", "’", "–", "中", "Ω", "́", "<|endoftext|>"]
    made = ["".join(numbers.choice(letters) for _ in range(numbers.randint(0, 40))) for _ in range(1500)]
    made += [f"a{chr(c)}b'{chr(c)} {chr(c)}{chr(c)}" for c in range(0x250)]
    made += ["!" * 400 + "a" * 300, "aaaa aaaaa", "", "İstanbul Σίσυφος ΑΣ é K <|startoftext|>x it'S I'LL"]
    return made


def test_counts_of_the_library(texts):
    library = Tokenizer.from_file(BYTE)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert Counter(BYTE).count(texts).tolist() == want


def test_ids_and_texts_of_the_library(texts):
    library, codec = Tokenizer.from_file(BYTE), Codec(BYTE)
    coded = codec.encode(texts)
    assert [ids_of(c) for c in coded] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [b"".join(x for _, _, x in c).decode() for c in coded] == texts


def test_automaton_accepts_what_merging_makes():
    """Every word of few letters: the accepted path has as many arcs as merging leaves symbols."""
    vocabulary = read_vocabulary(BYTE)
    machine, numbers = build(vocabulary), random.Random(2)
    for _ in range(3000):
        word = "".join(numbers.choice("aeinstr ") for _ in range(numbers.randint(1, 14))).encode()
        path = machine.encode(word)
        symbols = [vocabulary.byte_ids[b] for b in word]
        assert len(path) == len(word) - count_merges(symbols, vocabulary.merges)
        assert b"".join(vocabulary.labels[i] for i in path) == word


def test_word_ids_of_the_library(texts):
    library, encoder = Tokenizer.from_file(WORD), token_files.Encoder(WORD)
    want = [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want


def test_odd_rows(odd_docs, odd_rows):
    library = Tokenizer.from_file(BYTE)
    want = sorted((r[0] or 0, len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_rows)
    found = token_counts(odd_docs, BYTE)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    assert sorted((r[0] or 0, r[1], r[2]) for r in found.collect()) == want
    coded = encode_decode(odd_docs, BYTE, outputs=("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256")).collect()
    by_text = {r["decoded"]: r for r in coded}
    for _, text, *_ in odd_rows:
        row, ids = by_text[text or ""], library.encode(text or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("shared", ["path", "uri"])
def test_token_files(spark, odd_docs, odd_rows, tmp_path, shared):
    library = Tokenizer.from_file(WORD)
    folder = str(tmp_path) if shared == "path" else f"file://{tmp_path}"
    manifest = token_files.write(odd_docs, WORD, folder)
    found = token_files.read(manifest, folder).orderBy("start").collect()
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    assert len(found) == len(rows)
    for row, (key, text, *_) in zip(found, rows, strict=True):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert tuple(row) == (key, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    shards = manifest.orderBy("shard").collect()
    assert sum(r["n_ids"] for r in shards) == at and sum(r["n_docs"] for r in shards) == len(rows)
    for r in shards:
        assert len(np.fromfile(tmp_path / f"{r['stem']}.ids", "<u2")) == r["n_ids"]
        assert np.fromfile(tmp_path / f"{r['stem']}.offsets", "<u8")[-1] == r["n_ids"]


def test_empty_tables(spark, no_docs, tmp_path):
    assert token_counts(no_docs, BYTE).collect() == []
    assert encode_decode(no_docs, BYTE).collect() == []
    assert token_files.read(token_files.write(no_docs, WORD, str(tmp_path)), str(tmp_path)).collect() == []
