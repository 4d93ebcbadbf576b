"""Checkpoint algebra and anti-joins."""

from pyspark.sql import functions as F

from replyforge.operators import checkpoints as C
from suite.base import query

# Four checkpoint files from lowest to highest precedence; each holds a record for every document, of which
# only each n-th has a response.
_ANSWERED = (2, 3, 5, 7)


def _sources(t):
    saved = t["saved"]
    return [
        saved.withColumns(
            {
                "response": F.when(F.col("doc_id") % n == 0, F.concat(F.lit(f"{rank}:"), "lang")),
                "status": F.when(F.col("doc_id") % 4 == rank, F.lit("processing")).otherwise(F.col("status")),
            }
        )
        for rank, n in enumerate(_ANSWERED)
    ]


_UNION = " UNION ALL ".join(
    f"""SELECT doc_id, id, seq, prompt, CASE WHEN doc_id % {n} = 0 THEN '{rank}:' || lang END AS response, error,
               CASE WHEN doc_id % 4 = {rank} THEN 'processing' ELSE status END AS status, {rank} AS rank
        FROM {{saved}}"""
    for rank, n in enumerate(_ANSWERED)
)
_MERGED = f"""
    SELECT id, rank, prompt, response, status, bucket FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY (bucket = 'completed') DESC, rank DESC, seq DESC) AS rn FROM (
        SELECT *, CASE WHEN coalesce(response, '') = '' OR error IS NOT NULL THEN 'no_response'
                       WHEN status IS NULL OR status = 'completed' THEN 'completed'
                       WHEN status IN ('processing', 'error', 'max_rounds', 'resume') THEN 'processing' ELSE 'ignored' END AS bucket
        FROM ({_UNION})) WHERE bucket IN ('completed', 'processing')) WHERE rn = 1"""


@query(f"SELECT id, status, response, bucket FROM ({_MERGED})")
def merge_checkpoints(t):
    return C.merge_checkpoints(_sources(t)).select("id", "status", "response", "bucket")


@query(
    """SELECT doc_id, id, bucket FROM {saved_buckets}"""
)
def classify_checkpoint(t):
    return C.classify_checkpoint(t["saved"], True).select("doc_id", "id", "bucket")


@query("SELECT doc_id, CASE WHEN coalesce(response, '') = '' OR error IS NOT NULL THEN 'no_response' ELSE 'completed' END AS bucket FROM {saved}")
def classify_checkpoint_without_processor(t):
    return C.classify_checkpoint(t["saved"], False).select("doc_id", "bucket")


@query("""
    SELECT id, max(seq) AS seq, arg_max(coalesce(status, '-'), seq) AS status, arg_max(coalesce(response, '-'), seq) AS response
    FROM {records} GROUP BY id""")
def last_wins(t):
    kept = C.last_wins(t["records"], ["id"], ["seq"])
    return kept.select("id", "seq", F.coalesce("status", F.lit("-")).alias("status"), F.coalesce("response", F.lit("-")).alias("response"))


_DONE = "SELECT uuid FROM {done_events} WHERE success AND uuid IS NOT NULL"


@query(f"SELECT o_orderkey, uuid FROM (SELECT o_orderkey, cast(o_custkey % 200 AS string) AS uuid FROM {{orders}}) WHERE uuid NOT IN ({_DONE})")
def skip_done(t):
    items = t["orders"].select("o_orderkey", (F.col("o_custkey") % 200).cast("string").alias("uuid"))
    return C.skip_done(items, t["done_events"])


_HOT = "CASE WHEN o_custkey % 3 = 0 THEN '7' WHEN o_custkey % 3 = 1 THEN '-1' WHEN o_custkey % 50 <> 0 THEN cast(o_custkey % 1000 AS string) END"


@query(
    f"""SELECT o_orderkey, uuid FROM (SELECT o_orderkey, {_HOT} AS uuid FROM {{orders}})
        WHERE uuid IS NULL OR uuid NOT IN ({_DONE})"""
)
def skip_done_hot_ids(t):
    """Two ids own a third of the rows each; null ids are never done."""
    items = t["orders"].select("o_orderkey", F.expr(_HOT).alias("uuid"))
    return C.skip_done(items, t["done_events"])


@query(
    """SELECT w.id, coalesce(s.prompt, w.prompt) AS prompt, s.response, s.id IS NOT NULL AS reused
       FROM {work_items} w LEFT JOIN (SELECT * FROM {saved_buckets} WHERE bucket = 'completed') s ON w.id = s.id"""
)
def reuse_completed(t):
    saved = C.merge_checkpoints([t["saved"]])
    return C.reuse_completed(t["work_items"], saved).select("id", "prompt", "response", "reused")


@query(
    """SELECT w.id, s.prompt, s.response, 'resume' AS status FROM {work_items} w JOIN {saved_buckets} s ON w.id = s.id WHERE s.bucket = 'processing'"""
)
def requeue_processing(t):
    saved = C.merge_checkpoints([t["saved"]])
    return C.requeue_processing(t["work_items"], saved).select("id", "prompt", "response", "status")


@query(
    """SELECT w.id, w.prompt FROM {work_items} w JOIN {saved_buckets} s ON w.id = s.id WHERE s.bucket NOT IN ('completed', 'processing')
       ORDER BY w.id LIMIT 20"""
)
def limit_inputs(t):
    """The first rows by id after the finished ones were skipped."""
    fresh = C.fresh_rows(t["work_items"], C.merge_checkpoints([t["saved"]]))
    return C.limit_inputs(fresh, 20, ["id"])
