"""The pipeline, stage by stage, against the rules its stages promise."""

import corpus_pipeline
from pyspark.sql import functions as F

from replyforge.llm import queries
from replyforge.sources.storage import materialize
from tests.llm.test_duplicates import components_by_hand, cut_by_hand
from tests.llm.test_judging import marks_by_hand

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    columns = docs.columns
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], SF_DIR), name))
    raw, good, distinct, cut, clean, coded = kept
    assert all(k.columns == columns for k in kept[:-1])

    labels = {r["doc_id"]: r["quality"] for r in queries.table(spark, SF_DIR, "labels").collect()}
    ids = {r["doc_id"] for r in good.select("doc_id").collect()}
    judged = [k for k in labels if labels[k] == (k in ids)]
    assert len(judged) >= 0.95 * len(labels)

    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    firsts = sorted(k for k, _, least in components_by_hand(rows) if k == least)
    rows = [(r["doc_id"], r["text"]) for r in distinct.collect()]
    assert sorted(k for k, _ in rows) == firsts

    want = cut_by_hand([(k, t.encode()) for k, t in rows])
    shorter = {r["doc_id"]: r for r in cut.collect()}
    for key, text in rows:
        n_bytes, n_removed, _, _ = want[key, text.encode()]
        assert n_bytes - n_removed - len(shorter[key]["text"].encode()) in range(7)  # halves of cut characters go
        assert shorter[key]["n_chars"] == len(shorter[key]["text"])

    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SF_DIR, "benchmark").collect()]
    marks = marks_by_hand([(k, r["text"]) for k, r in shorter.items()], items)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(k for k, _, hits, _ in marks if not hits)

    texts = clean.select("doc_id", F.sha2("text", 256).alias("digest"))
    joined = coded.join(texts, "doc_id")
    assert joined.count() == coded.count() == clean.count()
    assert joined.where("digest != decoded_sha256 or size(ids) != n_tokens").isEmpty()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    assert len(corpus_pipeline.STAGES) == 5
