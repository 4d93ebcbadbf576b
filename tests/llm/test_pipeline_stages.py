"""Every stage of the pipeline on odd rows and on an empty table."""

import pytest

import corpus_pipeline
from replyforge.sources.storage import materialize

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stage_takes_odd_rows(spark, odd_docs, no_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = materialize(odd_docs, "odd")
    found = stage(spark, docs, SF_DIR)
    rows = found.collect()
    last = name == corpus_pipeline.STAGES[-1][0]
    if not last:
        assert found.columns == docs.columns
        assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}
    if name in ("suffix_array_dedup", "bpe_encoding"):
        assert len(rows) == docs.count()
    if name == "ngram_jaccard_join":
        # Copies go, documents without a text in common stay; rows without a key are all kept.
        keys = [r["doc_id"] for r in rows]
        assert {1, 4, 8, 10, 11, 12} <= set(keys) and not {2, 3, 9} & set(keys) and keys.count(None) == 2
    empty = stage(spark, no_docs, SF_DIR)
    assert empty.collect() == [] and (last or empty.columns == no_docs.columns)
