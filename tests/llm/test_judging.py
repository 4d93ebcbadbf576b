"""Decontamination, quality, language, licences and rules."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyforge.llm import decontaminate, language, license_scan, quality_model, quality_rules, queries
from tests.llm.conftest import SCHEMA, row, sentence

SF_DIR = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def marks_by_hand(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        for at in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[at : at + 10]), set()).add(str(item))
    found = []
    for key, text in docs:
        own, hit, names = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(own) - size + 1):
                if items_here := windows.get(tuple(own[at : at + size])):
                    hit |= set(range(at, at + size))
                    names |= items_here
        found.append((key, len(own), sorted(hit), sorted(names)))
    return sorted(found, key=str)


def marked(docs, items):
    rows = decontaminate.mark(docs, items, carry=["doc_id"]).collect()
    spread = [(r[0], r[1], [i for h in r[2] for i in range(h["first"], h["end"])], r[3]) for r in rows]
    return sorted(spread, key=str)


ITEMS = [(1, sentence(1, 14)), (2, "ONE, two"), (3, None), (4, ""), (5, "中文"), (6, sentence(3, 10)), (7, "a a a"), (None, "one")]


@pytest.mark.parametrize("block", [20, 500_000])
def test_marks(spark, monkeypatch, odd_docs, odd_rows, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    items = spark.createDataFrame([*ITEMS, ITEMS[0]], "item_id long, text string")
    more = [(20, "a a a a b a a a"), (21, sentence(1, 12)[:-3]), (22, "x one-TWO y")]
    docs = odd_docs.unionByName(spark.createDataFrame([row(*m) for m in more], SCHEMA))
    want = marks_by_hand([(r[0], r[1]) for r in odd_rows] + more, [i for i in ITEMS if i[0] is not None])
    assert marked(docs, items) == want


def test_clean_keeps_columns(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 5, 6, 7, 12]
    assert decontaminate.clean(no_docs, items).collect() == []
    assert decontaminate.clean(odd_docs, items.limit(0)).count() == odd_docs.count()


def remainder(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus


def test_held_out_quality(spark):
    labels = {r["doc_id"]: r["quality"] for r in queries.table(spark, SF_DIR, "labels").collect()}
    rows = [r for r in queries.op7_quality_model(spark, SF_DIR).collect() if r["doc_id"] in labels]
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if remainder(r["doc_id"], 5) == 0}
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert len(held) > 50 and right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, None, 0), (None, 1, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    everything = F.lit(True)
    for model in (
        quality_model.learn(odd_docs, labels, everything),
        quality_model.learn(odd_docs, labels.limit(0), everything),
        quality_model.learn(no_docs, labels, everything),
    ):
        found = quality_model.score(odd_docs, model)
        assert found.columns == ["doc_id", "score"]
        assert all(0 <= r["score"] <= 1 for r in found.collect()) and found.count() == odd_docs.count()
        assert quality_model.keep(odd_docs, model, 0.0).columns == odd_docs.columns
        assert quality_model.keep(odd_docs, model, 0.0).count() == odd_docs.count()
        assert quality_model.keep(odd_docs, model, 1.1).count() == 0
        assert quality_model.score(no_docs, model).collect() == []


def test_model_learns_a_pair():
    """The label is whether two features agree, which no sum of single tables can say."""
    numbers = np.random.default_rng(1)
    rows = numbers.random((4000, 3))
    labels = ((rows[:, 0] > 0.5) == (rows[:, 1] > 0.5)).astype(float)
    model = quality_model.fit(rows[:3000], labels[:3000], quality_model.Settings(pair_rounds=60))
    assert ((model.score(rows[3000:]) > 0.5) == labels[3000:]).mean() > 0.95


def test_features_do_not_depend_on_neighbours(odd_rows):
    texts = [(r[1] or "").encode() for r in odd_rows]
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    together = quality_model.text_features(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for text, found in zip(texts, together, strict=True):
        alone = quality_model.text_features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
        assert np.allclose(found, alone)


def test_held_out_language(spark):
    langs = {r["doc_id"]: r["lang"] for r in queries.table(spark, SF_DIR, "documents").select("doc_id", "lang").collect()}
    held = [r for r in queries.op8_language(spark, SF_DIR).collect() if r["held_out"]]
    assert {r["doc_id"] for r in held} == {k for k in langs if remainder(k, 4) == 2}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.97 * len(held)


def code_length_by_hand(counts, text, order=3):
    """Bits of a text in a context tree given as {context: {byte: count}}."""
    text, bits = b"\n" * order + text, 0.0
    for at in range(order, len(text)):
        for k in range(order, -1, -1):
            seen = counts.get(text[at - k : at])
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if text[at] in seen:
                bits -= np.log2(seen[text[at]] / whole)
                break
            bits -= np.log2(len(seen) / whole)
        else:
            bits += 8
    return bits


def test_code_lengths():
    learnt, asked = [b"the cat sat on the mat", b"", b"that"], [b"the hat", b"", b"zebra!", b"x"]
    pack = lambda texts: (np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts])))
    counts: dict = {}
    for text in learnt:
        padded = b"\n" * 3 + text
        for at in range(3, len(padded)):
            for k in range(4):
                own = counts.setdefault(padded[at - k : at], {})
                own[padded[at]] = own.get(padded[at], 0) + 1
    model = language.build({"aa": language.context_counts(*pack(learnt))}, 10_000)
    want = [code_length_by_hand(counts, t) for t in asked]
    assert np.allclose(model.code_lengths(*pack(asked))[:, 0], want, rtol=1e-5)


@pytest.mark.parametrize("same_text", [False, True])
def test_language_whose_rows_share_a_key(spark, same_text):
    """Thousands of rows of one language under one key, or even all alike, next to another language."""
    french = [(7, "le chat est sur la table " + ("" if same_text else f"et la maison {i}"), "fr") for i in range(3000)]
    english = [(100 + i, f"the cat is on the table and in the house {i}", "en") for i in range(500)]
    docs = spark.createDataFrame(french + english, "doc_id long, text string, lang string").repartition(4)
    model = language.learn(docs, F.lit(True))
    assert model.languages == ["en", "fr"]
    asked = spark.createDataFrame([(1, "la table est dans la maison"), (2, "the house is on the table")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language.predict(asked, model).collect()} == {1: "fr", 2: "en"}


def test_language_of_odd_rows(odd_docs, no_docs):
    model = language.learn(odd_docs, F.lit(True))
    assert model.languages == ["en"]
    found = language.predict(odd_docs, model)
    assert found.columns == ["doc_id", "lang_pred", "score"]
    und = sorted(r["doc_id"] or 0 for r in found.collect() if r["lang_pred"] == "und")
    assert und == [0, 5, 6, 7, 12]
    assert language.predict(no_docs, model).collect() == []
    untaught = language.predict(odd_docs, language.learn(no_docs, F.lit(True))).collect()
    assert {(r["lang_pred"], r["score"]) for r in untaught} == {("und", 0.0)}


def test_licences(spark, odd_docs, no_docs):
    long = dict((n, t) for n, t in license_scan.TEMPLATES if len(t) > 150)
    changed = long["gpl-3.0"].replace("redistribute", "spread")
    rows = [
        (1, sentence(1, 33) + "\nLICENSED under the apache license,  version 2.0.\n" + sentence(2, 21)),
        (2, sentence(1, 7) + " " + long["mit"].upper() + " " + sentence(4, 50) + " Released under the MIT License."),
        (3, "Released under the License."),
        (4, sentence(5, 11) + " " + changed + " " + sentence(6, 19)),
        (5, None),
        (6, "Released under the MIT License."),
        (6, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.scan(docs).collect()}
    assert {k for k in found} == {(1, "apache-2.0"), (2, "mit"), (4, "gpl-3.0"), (6, "mit")}
    assert found[1, "apache-2.0"] == found[2, "mit"] == 1.0
    assert 0.8 <= found[4, "gpl-3.0"] <= 1.0
    assert license_scan.scan(odd_docs).collect() == license_scan.scan(no_docs).collect() == []
    many = [(f"t{i}", sentence(100 + i, 12)) for i in range(3)]
    three = spark.createDataFrame([(i, "x y " + t + " z") for i, (_, t) in enumerate(many)], "doc_id long, text string")
    assert sorted(r["license"] for r in license_scan.scan(three, templates=many).collect()) == ["t0", "t1", "t2"]
    with pytest.raises(ValueError, match="fewer than"):
        license_scan.scan(docs, templates=[("x", "too short")])


def rules_by_hand(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(own) - 7):
        places.setdefault(tuple(own[i : i + 8]), []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    failed = len(own) < 20 or 100 * len(covered) > 30 * len(own)
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_rules(spark, odd_docs, odd_rows, no_docs):
    repeated = sentence(8, 12)
    more = [(30, f"{repeated} {sentence(9, 60)} {repeated}"), (31, "a b " * 30), (32, "x\ny\nx\n\nx\n"), (33, " ".join("abcdefgh" * 4))]
    docs = odd_docs.unionByName(spark.createDataFrame([row(*m) for m in more], SCHEMA))
    want = sorted(((r[0] or 0, *rules_by_hand(r[1])) for r in [*odd_rows, *more]), key=str)
    found = quality_rules.judge(docs)
    assert set(odd_docs.columns) < set(found.columns)
    assert sorted(((r["doc_id"] or 0, *[r[c] for c in COUNTS]) for r in found.collect()), key=str) == want
    assert quality_rules.judge(no_docs).collect() == []
    assert "base_failed" not in quality_rules.judge(docs, prefix="q_").columns


def test_lines(spark):
    good = "This is a sentence that says something about the world and its people.\nIt goes on for another line, too."
    bad = "Home | News | Sport | Contact\nRead more\nAAA!! BBB!! CCC!! DDD!! EEE!!\nBuy now"
    rows = [(1, f"{good}\n{bad}"), (2, f"{bad}\n" * 8), (3, good)]
    found = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["clean_text"] == good and found[1]["kept"]
    assert found[2]["clean_text"] == "" and not found[2]["kept"]
    assert found[3]["kept"]


def test_rules_stay_in_the_jvm(spark):
    for df in (queries.op9_license_scan(spark, SF_DIR), queries.op10_quality_rules(spark, SF_DIR)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_columns_named_like_inner_ones(spark):
    docs = spark.createDataFrame([(1, "good words here " * 10, "a", "b", "c")], "doc_id long, text string, __hits string, __Rules_words string, ___items string")
    items = spark.createDataFrame([(1, "other")], "item_id long, text string")
    assert [tuple(r)[2:] for r in decontaminate.clean(docs, items).collect()] == [("a", "b", "c")]
    judged = quality_rules.judge(docs)
    assert judged.columns[:5] == docs.columns and tuple(judged.first())[2:5] == ("a", "b", "c")
