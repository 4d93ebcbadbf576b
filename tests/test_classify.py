"""Vectorised scoring against plain loops: words, runs by text, runs by bucket, blocks, streams."""

import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from replyforge.functions import spans
from replyforge.functions.spans import WordTable, distinct_words, fnv_hashes, hash_spans, run_buckets, runs, text_bytes
from replyforge.operators import classify as K

LABELS = ["__label__0", "__label__1", "__label__7"]


def hash_by_hand(word: bytes) -> int:
    h = 2166136261
    for byte in word:
        h = ((h ^ (byte | 0xFFFFFF00 if byte > 127 else byte)) * 16777619) % (1 << 32)
    return h - (1 << 32) if h >= 1 << 31 else h


def buckets_by_hand(words, longest, n_buckets):
    hashes = [hash_by_hand(w) for w in words if not w.startswith(b"__label__")]
    found = []
    for i in range(len(hashes)):
        h = hashes[i] % (1 << 64)
        for j in range(i + 1, min(len(hashes), i + longest)):
            h = (h * 116049371 + hashes[j]) % (1 << 64)
            found.append(h % n_buckets)
    return found


def score_by_hand(text, model, end=None, ngrams=1, buckets=None, n_buckets=None):
    """Best label and confidence of a text with plain dictionaries; None without a known token."""
    data = (text or "").encode()
    for c in K.WORD_END:
        data = data.replace(bytes([c]), b" ")
    words = [w for w in data.split(b" ") if w] + ([end.encode()] if end else [])
    tokens = [w.decode() for w in words]
    if buckets is None:
        tokens += [b" ".join(words[i : i + n]).decode() for n in range(2, ngrams + 1) for i in range(len(words) - n + 1)]
    found = [model[t] for t in tokens if t in model]
    if buckets is not None:
        found += [buckets.get(b, [0.0] * len(LABELS)) for b in buckets_by_hand(words, ngrams, n_buckets)]
    if not found:
        return None
    means = [sum(f[i] for f in found) / len(found) for i in range(len(LABELS))]
    total = sum(math.exp(m) for m in means)
    best = max(range(len(LABELS)), key=lambda i: (means[i], LABELS[i]))
    return int(LABELS[best].removeprefix("__label__")), math.exp(means[best]) / total


def texts(seed, n=200):
    numbers = random.Random(seed)
    words = ["a", "bb", "ccc", "é", "naïve", "中文字", "x" * 9, "y" * 300, "__label__1", "word", "zulu", "Ω"]
    gaps = [" ", "  ", "\n", "\t", "\x00", "\x0b"]
    made = ["".join(w + numbers.choice(gaps) for w in numbers.choices(words, k=numbers.randint(0, 12))) for _ in range(n)]
    return [*made, "", None, " ", "\n", "nowhere"]


def weights(keys, seed):
    numbers = random.Random(seed)
    return {k: [numbers.uniform(-2, 2) for _ in LABELS] for k in keys}


def frame(spark, table, name, kind):
    rows = [(label, k, w[i]) for k, w in table.items() for i, label in enumerate(LABELS)]
    return spark.createDataFrame(rows, f"label string, {name} {kind}, weight double")


def check(spark, docs, model, **options):
    by_hand = {k: v for k, v in options.items() if k not in ("block_bytes", "buckets")}
    want = {i: score_by_hand(t, model, buckets=options.get("buckets"), **by_hand) for i, t in enumerate(docs)}
    table = spark.createDataFrame(list(enumerate(docs)), "id int, text string").repartition(3)
    if "buckets" in options:
        options["buckets"] = frame(spark, options["buckets"], "bucket", "long")
    got = {r["id"]: (r["label"], r["confidence"]) for r in K.classify_text(table, frame(spark, model, "token", "string"), ["id"], **options).collect()}
    assert got.keys() == {i for i, w in want.items() if w}
    for i, (label, confidence) in got.items():
        assert label == want[i][0] and confidence == pytest.approx(want[i][1], rel=1e-9)


TOKENS = ["a", "bb", "é", "中文字", "x" * 9, "y" * 300, "</s>", "a bb", "é a", "bb é a", "word </s>", "zulu"]


def test_words_and_runs(spark):
    docs = texts(1)
    check(spark, docs, weights(TOKENS, 1))
    check(spark, docs, weights(TOKENS, 2), end="</s>", ngrams=3)
    check(spark, docs, weights(TOKENS, 2), end="</s>", ngrams=2, block_bytes=300)


def test_runs_known_by_bucket(spark):
    docs, n_buckets = texts(2), 97
    held = weights([b for b in range(n_buckets) if b % 3], 3)
    check(spark, docs, weights(TOKENS, 4), end="</s>", ngrams=3, buckets=held, n_buckets=n_buckets)
    check(spark, docs, weights(TOKENS, 4), ngrams=2, buckets=held, n_buckets=n_buckets, block_bytes=1000)
    check(spark, docs, weights(TOKENS, 4), ngrams=2, buckets=weights([5], 1), n_buckets=2_000_000)


def test_scoring_on_a_stream(spark, tmp_path):
    """A model of several blocks, which a batch writes between stages."""
    docs = [t for t in texts(3) if t and "\n" not in t and "\x0b" not in t]
    model = weights(TOKENS, 5)
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.txt").write_bytes("\n".join(docs).encode())
    rows = spark.readStream.format("text").load(str(tmp_path / "src")).withColumnRenamed("value", "text")
    scored = K.classify_text(rows, frame(spark, model, "token", "string"), ["text"], block_bytes=300)
    query = scored.withColumn("text", F.hex("text")).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    query.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    # A column of the key holds the text's hash alone; texts repeat with equal results.
    got = {(r["label"], round(r["confidence"], 9)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {score_by_hand(d, model) for d in docs} - {None}
    assert got == {(label, round(c, 9)) for label, c in want}


def joined(words):
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)])


def test_numbers_of_words():
    numbers = random.Random(7)
    words = list({bytes(numbers.choices(range(256), k=numbers.randint(0, 600 if i % 20 == 0 else 20))) for i in range(3000)})
    content, offsets = joined(words)
    table = WordTable(*joined(words[:2000]))
    assert table.find(content, offsets).tolist() == [*range(2000), *[-1] * (len(words) - 2000)]
    codes, held, places = distinct_words(content, offsets[:-1], offsets[1:])
    assert [held[places[c] : places[c + 1]].tobytes() for c in codes] == words
    assert fnv_hashes(content, offsets).tolist() == [hash_by_hand(w) for w in words]
    # Known values of the public hash for ASCII words.
    known = np.frombuffer(b"afoobar", np.uint8)
    assert [int(x) & 0xFFFFFFFF for x in fnv_hashes(known, np.array([0, 1, 7]))] == [0xE40C292C, 0xBF9CF968]
    assert WordTable(*joined([])).find(content, offsets).tolist() == [-1] * len(words)


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    monkeypatch.setattr(spans, "hash_spans", lambda content, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(2))
    words = [b"a", b"b", b"cc", b"dd", b"", b"ccc"]
    table = WordTable(*joined(words))
    asked = [b"b", b"x", b"dd", b"cc", b"a", b"", b"ccc", b"ccd"]
    assert table.find(*joined(asked)).tolist() == [1, -1, 3, 2, 0, 4, 5, -1]


def test_hashes_of_regular_words_differ():
    """Complementary words of a Thue-Morse build, which collide under every polynomial hash modulo a power of two."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    seen = set()
    for n in (8, 64, 128, 256, 1024, 2048, 4096):
        for w in (word[:n], word[:n].translate(str.maketrans("ab", "ba"))):
            data = np.frombuffer(f"__{w}".encode(), np.uint8)
            seen.add(int(hash_spans(data, np.array([2]), np.array([2 + n]))[0]))
    assert len(seen) == 14


def test_runs_and_buckets_of_rows():
    content, offsets = text_bytes(pa.array(["a b", None, "", "c", " d e"]).slice(1))
    starts, ends, rows = runs(content != 32, offsets)
    assert [(content[a:b].tobytes(), r) for a, b, r in zip(starts, ends, rows, strict=True)] == [(b"c", 2), (b"d", 3), (b"e", 3)]
    rows, found = run_buckets(fnv_hashes(content[[0, 2, 4]] if len(content) > 4 else content, np.array([0, 1, 2, 3])), np.array([0, 0, 0]), 3, 1000)
    assert len(found) == 3 and rows.tolist() == [0, 0, 0]


def test_rows_are_written_once_however_many_blocks(spark, monkeypatch):
    """What is written for a row must not grow with the weight table."""
    written, write = [], K.materialize
    monkeypatch.setattr(K, "materialize", lambda df, name, **options: written.append(name) or write(df, name, **options))
    for block_bytes, most in ((100, 1), (10, 1), (K.BLOCK_BYTES, 0)):
        written.clear()
        check(spark, texts(4, 40), weights(TOKENS, 6), block_bytes=block_bytes)
        assert len(written) <= most


def test_a_table_of_blocks_gives_every_row_as_a_whole_one_does(spark):
    """Columns of names used inside and of any type, rows that come twice, entries that come twice or lack a token."""
    docs = spark.createDataFrame([(i % 7, t) for i, t in enumerate([*texts(5, 50), "a bb", "a bb"])], "_chunk int, text string")
    docs = docs.selectExpr("*", "timestamp_seconds(_chunk) AS t", "named_struct('x', array(_chunk, null)) AS _asks", "map('k', _chunk) AS `a b`")
    rows = [("__label__0", "a", 0.5), ("__label__0", "a", 0.25), ("__label__1", "a", 0.6), ("__label__1", "bb", 0.3), ("__label__1", None, 9.0)]
    model = spark.createDataFrame(rows, "label string, token string, weight double")
    whole, blocks = (K.add_confidence(docs, model, block_bytes=b) for b in (K.BLOCK_BYTES, 50))
    assert whole.schema == blocks.schema
    assert sorted(map(str, whole.collect())) == sorted(map(str, blocks.collect())) and whole.count() == docs.count()


def test_chunks_ask_for_the_words_of_their_rows(monkeypatch):
    monkeypatch.setattr(K, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(K, "PIECE_BYTES", 500)
    monkeypatch.setattr(K, "TaskContext", type("Here", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})())}))
    all_texts = texts(6, 300)
    table = pa.table({"text": all_texts, "_n": pa.array([0] * len(all_texts), pa.int64()), "_sums": [[0.0, 0.0]] * len(all_texts)})
    split = K.Splitter("text", b"</s>", 2, 2)
    made = pa.Table.from_batches(K._chunker(split, True, 97, [*table.schema.names, "c", "asks", "words", "runs"])(iter(table.to_batches(120)))).to_pylist()
    rows = [r for r in made if not r["asks"]]
    assert [r["text"] for r in rows] == all_texts and len({r["c"] for r in rows}) > 3
    asked = {r["c"]: r for r in made if r["asks"]}
    assert asked.keys() == {r["c"] for r in rows} and len(asked) == sum(r["asks"] for r in made)
    for chunk, own in asked.items():
        words, runs_ = set(), set()
        for text in (r["text"] for r in rows if r["c"] == chunk):
            data = (text or "").encode().translate(bytes.maketrans(K.WORD_END, b" " * len(K.WORD_END)))
            cut = [w for w in data.split(b" ") if w] + [b"</s>"]
            words |= {w.decode() for w in cut} | {b" ".join(p).decode() for p in zip(cut, cut[1:], strict=False)}
            runs_ |= set(buckets_by_hand(cut, 2, 97))
        assert len(own["words"]) == len(words) and set(own["words"]) == words and own["runs"] == sorted(runs_)


def test_memory_for_a_large_batch():
    """A batch of 24 MB of text is scored in pieces."""
    words = [f"word{i}" for i in range(2000)]
    text = " ".join(words * 5)
    n = 24_000_000 // len(text)
    batch = pa.record_batch({"text": [text] * n, "_n": pa.array([0] * n, pa.int64()), "_sums": [[0.0, 0.0]] * n})
    sent = type("Sent", (), {})()
    sent._opened = [(K._find_words, (WordTable.of(pa.array(words)), np.ones((2000, 2)), True))]
    tracemalloc.start()
    many = [x for b in K._adder(sent, K.Splitter("text", None, 1, 2))(iter([batch])) for x in b.column(1).to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert many == [10_000] * n and peak < 150_000_000
