"""Reply parsing and difficulty tagging."""

from pyspark.sql import functions as F

from replyforge.functions.replies import extract_json as extract
from replyforge.functions.replies import valid_prediction as valid
from replyforge.operators import tagging as G
from suite.base import query

KEYS = ["Difficulty", "Rationale"]


@query(
    """SELECT doc_id, CASE WHEN doc_id % 10 IN (0, 1, 2, 3, 7, 8) THEN 'object' WHEN doc_id % 10 = 6 THEN 'other' END AS kind,
              cast(CASE doc_id % 10 WHEN 0 THEN 0.5 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 8 THEN 8 END AS double) AS difficulty,
              CASE doc_id % 10 WHEN 1 THEN ' ' || source WHEN 7 THEN source WHEN 8 THEN lang END AS rationale,
              CASE WHEN doc_id % 10 = 0 THEN md5(reply) END AS whole
       FROM {replies} JOIN {documents} USING (doc_id, source)"""
)
def extract_json(t):
    found = t["replies"].withColumn("json", extract("reply", KEYS))
    value = F.try_parse_json("json")
    return found.select(
        "doc_id",
        F.when(F.col("json").startswith("["), F.lit("other")).when(F.col("json").isNotNull(), F.lit("object")).alias("kind"),
        F.try_variant_get(value, "$.Difficulty", "double").alias("difficulty"),
        F.when((F.col("doc_id") % 10).isin(1, 7, 8), F.try_variant_get(value, "$.Rationale", "string")).alias("rationale"),
        F.when(F.col("doc_id") % 10 == 0, F.md5("json")).alias("whole"),
    )


@query("SELECT doc_id % 10 AS shape, count(*) AS n FROM {replies} WHERE doc_id % 10 NOT IN (4, 9) GROUP BY 1")
def extract_json_any_keys(t):
    found = t["replies"].where(extract("reply").isNotNull())
    return found.groupBy((F.col("doc_id") % 10).alias("shape")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, doc_id % 5 <> 0 AND doc_id % 4 IN (2, 3) AS valid FROM {predictions}")
def valid_prediction(t):
    return t["predictions"].select("doc_id", valid().alias("valid"))


_GOOD = "status = 'success' AND doc_id % 4 IN (2, 3)"


@query(
    f"""SELECT uuid, CASE WHEN formal_statement = '   ' THEN '' ELSE formal_statement END AS formal_statement,
               CASE WHEN formal_statement <> '   ' THEN response END AS model_output,
               cast(CASE WHEN formal_statement <> '   ' AND {_GOOD} THEN quality * 3 + toxic + 0.5 END AS double) AS difficulty_score,
               coalesce(formal_statement <> '   ' AND {_GOOD}, false) AS success,
               CASE WHEN formal_statement = '   ' THEN 'Empty formal statement' WHEN coalesce({_GOOD}, false) THEN NULL ELSE coalesce(error, 'Prediction failed') END AS error
        FROM {{tag_asked}}"""
)
def tag_row(t):
    rows = G.prepare_statements(t["tag_asked"]).drop("doc_id")
    return G.tag_rows(rows)


@query(
    f"""SELECT i.doc_id, CASE WHEN {_GOOD.replace('doc_id', 'p.doc_id')} THEN quality * 3 + toxic + 0.5 ELSE i.difficulty END AS difficulty,
               CASE WHEN {_GOOD.replace('doc_id', 'p.doc_id')} THEN 'q' || cast(quality AS string) ELSE i.difficulty_rationale END AS difficulty_rationale,
               CASE WHEN {_GOOD.replace('doc_id', 'p.doc_id')} THEN response END AS difficulty_response
        FROM {{typed_items}} i LEFT JOIN {{predictions}} p ON i.doc_id = p.doc_id"""
)
def apply_predictions(t):
    out = G.apply_predictions(t["typed_items"], t["predictions"], ["doc_id"])
    return out.select("doc_id", "difficulty", "difficulty_rationale", "difficulty_response")


_KEYED = "SELECT *, trim(natural_language_statement, ' ' || chr(10)) AS k FROM {typed_items}"


@query(
    f"""SELECT o.doc_id, CASE WHEN p.k IS NOT NULL THEN p.d ELSE o.difficulty END AS difficulty,
               CASE WHEN p.k IS NOT NULL THEN p.r ELSE o.difficulty_rationale END AS difficulty_rationale
        FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS rn FROM ({_KEYED})) WHERE rn = 1) o
        LEFT JOIN (SELECT k, d, r FROM (SELECT k, difficulty + 1 AS d, CASE WHEN doc_id % 2 = 0 THEN difficulty_rationale END AS r,
                                               row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS rn FROM ({_KEYED}) WHERE doc_id % 3 <> 0) WHERE rn = 1) p
        ON o.k = p.k"""
)
def merge_results(t):
    items = t["typed_items"]
    processed = items.where("doc_id % 3 <> 0").withColumns(
        {
            "difficulty": F.col("difficulty") + 1,
            "difficulty_rationale": F.when(F.col("doc_id") % 2 == 0, F.col("difficulty_rationale")),
        }
    )
    merged = G.merge_results(items, processed, ["difficulty", "difficulty_rationale"])
    return merged.select("doc_id", "difficulty", "difficulty_rationale")


_DONE = "difficulty IS NOT NULL AND difficulty <> 0 AND coalesce(difficulty_rationale, '') <> ''"


@query(
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE {_DONE}) AS complete, count(*) - count(*) FILTER (WHERE {_DONE}) AS incomplete,
               count(*) FILTER (WHERE {_DONE}) / count(*) AS completion_rate, avg(difficulty) AS avg_difficulty FROM {{typed_items}}"""
)
def difficulty_stats(t):
    return G.difficulty_stats(t["typed_items"])


@query(
    """SELECT cast(cast(trunc(difficulty) AS bigint) AS string) || '-' || cast(cast(trunc(difficulty) AS bigint) + 1 AS string) AS bucket, count(*) AS items
       FROM {typed_items} WHERE difficulty IS NOT NULL GROUP BY 1"""
)
def difficulty_distribution(t):
    return G.difficulty_distribution(t["typed_items"])


@query(
    f"""SELECT (SELECT count(*) FROM {{tag_asked}}) AS total, count(*) AS processed,
               count(*) FILTER (WHERE formal_statement <> '   ' AND {_GOOD}) AS success,
               count(*) FILTER (WHERE formal_statement <> '   ' AND {_GOOD}) / count(*) AS success_rate
        FROM {{tag_asked}} WHERE status IS NOT NULL OR formal_statement = '   '"""
)
def tagging_stats(t):
    asked = t["tag_asked"]
    done = G.tag_rows(G.prepare_statements(asked.where("status IS NOT NULL OR formal_statement = '   '")).drop("doc_id"))
    return G.tagging_stats(asked.count(), done)


@query(
    """SELECT uuid, arg_max(seq, (success, seq)) AS seq, max(success) AS success
       FROM (SELECT cast(user_id AS string) AS uuid, event_id AS seq, coalesce(event_type = 'purchase' AND value > 50, false) AS success FROM {events}) GROUP BY uuid"""
)
def best_tag_per_uuid(t):
    rows = t["events"].select(
        F.col("user_id").cast("string").alias("uuid"),
        F.col("event_id").alias("seq"),
        F.coalesce((F.col("event_type") == "purchase") & (F.col("value") > 50), F.lit(False)).alias("success"),
    )
    return G.best_tag_per_uuid(rows).select("uuid", "seq", "success")
