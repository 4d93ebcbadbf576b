"""Text classification and retention figures."""

from pyspark.sql import functions as F

from replyforge.functions.text import round_even
from replyforge.operators import classify as K
from replyforge.plans.filtering import filter_lines
from replyforge.sources.storage import materialize, spread
from suite.base import query

# Scores of the documents named by ``src``: mean weight per label, softmax over the two labels.
_SCORED = """
    SELECT {key}, 1 / (1 + exp(z0 - z1)) AS p1 FROM (
      SELECT w.{key}, avg(CASE WHEN m.label = '__label__0' THEN m.weight END) AS z0, avg(CASE WHEN m.label = '__label__1' THEN m.weight END) AS z1
      FROM (SELECT {key}, unnest(string_split(translate(text, chr(10), ' '), ' ')) AS token FROM {src}) w
      JOIN {{class_model}} m ON w.token = m.token GROUP BY w.{key})"""
_DOCS = _SCORED.format(key="doc_id", src="{documents}")
_LINES = _SCORED.format(key="doc_id", src="(SELECT doc_id, text FROM {line_facts} WHERE text IS NOT NULL)")


def _model(t):
    """The weight table: the words of labelled texts are counted once, its weights follow from their counts."""
    docs = spread(t["documents"].select("doc_id", "text"), "doc_id")  # one row group as given, so one task
    words = F.explode(F.split(F.translate("text", "\n", " "), " "))
    tokens = docs.join(t["labels"], "doc_id").select("quality", words.alias("token")).where("token <> ''")
    counts = materialize(tokens.groupBy("token").agg(*[F.count_if(F.col("quality") == q).alias(f"n{q}") for q in (0, 1)]), "counts")
    sums = counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count("*").alias("v")).first()
    rows = [F.struct(F.lit(f"__label__{q}").alias("label"), F.ln((F.col(f"n{q}") + 1.0) / (sums[f"n{q}"] + sums["v"])).alias("weight")) for q in (0, 1)]
    return counts.select("token", F.inline(F.array(*rows)))


@query(f"SELECT doc_id, CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END AS label, cast(printf('%.4f', greatest(p1, 1 - p1)) AS double) AS confidence FROM ({_DOCS})")
def classify_text(t):
    out = K.classify_text(spread(t["documents"], "doc_id"), _model(t), ["doc_id"])
    return out.withColumn("confidence", round_even("confidence", 4))


@query(f"SELECT doc_id, CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END AS label, cast(printf('%.4f', greatest(p1, 1 - p1)) AS double) AS confidence FROM ({_DOCS})")
def classify_text_large_model(t):
    """The same scores when the weight table goes out in several blocks."""
    model = _model(t)
    size = model.agg(F.sum(F.octet_length("token") + 116)).first()[0] // 2
    out = K.classify_text(spread(t["documents"], "doc_id"), model, ["doc_id"], block_bytes=size // 3)
    return out.withColumn("confidence", round_even("confidence", 4))


@query(f"SELECT doc_id, lang, cast(printf('%.4f', p1) AS double) AS score FROM ({_DOCS}) JOIN {{documents}} USING (doc_id) WHERE p1 >= 0.5")
def keep_positive(t):
    docs = spread(t["documents"], "doc_id").withColumn("score", F.lit(9.0))
    return K.filter_documents(docs, _model(t)).select("doc_id", "lang", "score")


@query(f"SELECT doc_id, cast(printf('%.4f', p1) AS double) AS score FROM ({_DOCS}) WHERE p1 >= 0.6")
def keep_positive_min_confidence(t):
    return K.keep_positive(K.classify_text(spread(t["documents"], "doc_id"), _model(t), ["doc_id"]), 1, 0.6).select("doc_id", "score")


_PER_FILE = f"""
    SELECT source_file, count(*) AS total, count(*) FILTER (WHERE p1 >= 0.5) AS retained,
           CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE p1 >= 0.5) / count(*) * 100 ELSE 0 END AS retention_rate
    FROM {{line_facts}} LEFT JOIN ({_LINES}) USING (doc_id) GROUP BY source_file"""


def _failed(t):
    """Files nobody could read, one per region."""
    return t["region"].select(F.concat(F.lower("r_name"), F.lit(".jsonl")).alias("source_file"))


def _per_file(t):
    return filter_lines(spread(t["raw_lines"].select("value", "source_file")), _model(t))[1]


@query(f"SELECT source_file, md5(cast(doc_id AS string)) AS doc, cast(printf('%.4f', p1) AS double) AS score FROM {{line_facts}} JOIN ({_LINES}) USING (doc_id) WHERE p1 >= 0.5")
def filter_raw_lines(t):
    """Damaged lines in, lines with a score out."""
    kept, _ = filter_lines(t["raw_lines"].select("value", "source_file"), _model(t))
    row = F.from_json("value", "doc_id bigint, score double")
    return kept.select("source_file", F.md5(row["doc_id"].cast("string")).alias("doc"), row["score"].alias("score"))


@query(_PER_FILE)
def retention_by_file(t):
    return _per_file(t)


_SUMMARY = f"""
    SELECT count(*) + (SELECT count(*) FROM {{region}}) AS total_files, count(*) AS successful_files, (SELECT count(*) FROM {{region}}) AS failed_files, cast(sum(total) AS bigint) AS total_lines,
           cast(sum(retained) AS bigint) AS retained_lines, cast(printf('%.2f', sum(retained) / sum(total) * 100) AS double) AS overall_retention_rate
    FROM ({_PER_FILE})"""


@query(_SUMMARY)
def retention_summary(t):
    return K.retention_summary(_per_file(t), _failed(t))


_RUNNING = f"""
    SELECT source_file, cast(sum(total) OVER w AS bigint) AS processed, cast(sum(retained) OVER w AS bigint) AS kept,
           sum(retained) OVER w / sum(total) OVER w * 100 AS cumulative_rate
    FROM ({_PER_FILE}) WINDOW w AS (ORDER BY source_file ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query(_RUNNING)
def cumulative_retention(t):
    return K.cumulative_retention(materialize(_per_file(t), "retention"))


@query(
    f"""SELECT 'summary' AS section, NULL AS filename, total_lines AS total, retained_lines AS retained, overall_retention_rate AS retention_rate, total_files AS files
        FROM ({_SUMMARY}) UNION ALL SELECT 'file', source_file, total, retained, retention_rate, 1 FROM ({_PER_FILE})
        UNION ALL SELECT 'failed', lower(r_name) || '.jsonl', NULL, NULL, NULL, NULL FROM {{region}}"""
)
def filter_report(t):
    return K.filter_report(materialize(_per_file(t), "retention"), _failed(t))
