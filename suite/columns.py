"""Scalar helpers and row predicates."""

from pyspark.sql import functions as F

from replyforge.config import FieldNames
from replyforge.functions import flags, ids, names, text
from replyforge.operators.checkpoints import finalize_output as finalize
from replyforge.operators.checkpoints import missing_responses as missing
from replyforge.operators.checkpoints import shard as take_shard
from replyforge.operators.checkpoints import split_empty_prompts
from replyforge.sources.jsonl import parse_lines
from replyforge.sources.tables import with_position
from suite.base import query


@query("SELECT doc_id, text, n_chars AS n FROM {documents}")
def strip_whitespace(t):
    odd = F.concat(F.lit("\t  \n"), "text", F.lit("　\r "))
    # Texts have no outer whitespace of their own only if stripping them changes nothing.
    inner = text.strip("text")
    return t["documents"].select("doc_id", F.when(text.strip(odd) == inner, F.col("text")).alias("text"), F.col("n_chars").alias("n"))


@query("SELECT doc_id, md5(replace(text, chr(10), ' ')) AS line FROM {documents}")
def one_line(t):
    return t["documents"].select("doc_id", F.md5(text.one_line("text")).alias("line"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, cast(printf('%.2f', l_extendedprice / 8) AS double) AS r2, cast(printf('%.3f', l_quantity / 16) AS double) AS r3,
              cast(trunc(l_extendedprice / 3) AS bigint) AS cut, cast(ceil(l_extendedprice / 50) AS bigint) AS up
       FROM {lineitem}"""
)
def numbers(t):
    return t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        text.round_even(F.col("l_extendedprice") / 8, 2).alias("r2"),
        text.round_even(F.col("l_quantity") / 16, 3).alias("r3"),
        (F.col("l_extendedprice") / 3).cast("bigint").alias("cut"),
        F.ceil(F.col("l_extendedprice") / 50).alias("up"),
    )


@query(
    r"""SELECT page_id, split_part(file, '/', -1) AS base, regexp_replace(file, '/+[^/]*$', '') AS dir,
              regexp_replace(split_part(file, '/', -1), '([^.])\.[^.]*$', '\1') AS stem,
              CASE WHEN page_id < 10 THEN '0' ELSE '' END || cast(page_id AS string) AS part
       FROM {page_files}"""
)
def path_parts(t):
    return t["page_files"].select(
        "page_id",
        text.basename("file").alias("base"),
        text.dirname("file").alias("dir"),
        text.stem("file").alias("stem"),
        text.zero_padded("page_id").alias("part"),
    )


@query(
    """SELECT id, coalesce(nullif(lean_code, ''), nullif(statement, ''), 'nothing') AS picked FROM {statements}"""
)
def coalesce_falsy(t):
    return t["statements"].select("id", text.coalesce_falsy("lean_code", "statement", default="nothing").alias("picked"))


@query(
    """SELECT doc_id, concat_ws('_', cast(doc_id AS string), status, error) AS skipping,
              concat_ws('_', cast(doc_id AS string), coalesce(status, 'None'), coalesce(error, 'None')) AS printed
       FROM {records}"""
)
def composite_id(t):
    keys = ["doc_id", "status", "error"]
    return t["records"].select(
        "doc_id", ids.composite_id(keys).alias("skipping"), ids.composite_id(keys, "None").alias("printed")
    )


@query("SELECT id, split_part(id, '_', 1) AS base FROM {attempts}")
def base_id(t):
    return t["attempts"].select("id", ids.base_id("id").alias("base"))


@query("SELECT doc_id, coalesce(response, '') <> '' AND error IS NULL AS answered FROM {records}")
def is_answered(t):
    return t["records"].select("doc_id", flags.is_answered().alias("answered"))


@query(
    """SELECT doc_id, status IS NULL OR status = 'completed' AS to_skip,
              status IS NULL OR status IN ('processing', 'error', 'max_rounds', 'resume') AS to_resume,
              status IS NULL OR status IN ('completed', 'error', 'max_rounds') AS to_write FROM {records}"""
)
def has_status(t):
    s = flags.STATUSES
    return t["records"].select(
        "doc_id",
        flags.has_status("status", s.skip).alias("to_skip"),
        flags.has_status("status", s.resume).alias("to_resume"),
        flags.has_status("status", s.write).alias("to_write"),
    )


@query("SELECT id, round, l_partkey, l_suppkey, success FROM {verdicts} WHERE success IS NOT TRUE")
def unsolved(t):
    return flags.unsolved(t["verdicts"])


_COMPLETE = "difficulty IS NOT NULL AND difficulty <> 0 AND coalesce(difficulty_rationale, '') <> ''"


@query(f"SELECT doc_id, difficulty, difficulty_rationale FROM {{typed_items}} WHERE {_COMPLETE}")
def filter_complete(t):
    return flags.filter_complete(t["typed_items"]).select("doc_id", "difficulty", "difficulty_rationale")


@query(f"SELECT doc_id, difficulty, difficulty_rationale FROM {{typed_items}} WHERE NOT ({_COMPLETE})")
def filter_incomplete(t):
    return flags.filter_incomplete(t["typed_items"]).select("doc_id", "difficulty", "difficulty_rationale")


@query(
    """SELECT doc_id, id, response, error, coalesce(status, 'completed') AS status FROM {records}
       WHERE coalesce(status, 'completed') IN ('completed', 'error', 'max_rounds')"""
)
def finalize_output(t):
    return finalize(t["records"], True).select("doc_id", "id", "response", "error", "status")


@query("SELECT doc_id, status FROM {records} WHERE status IS NULL OR status IN ('completed', 'error', 'max_rounds')")
def finalize_output_without_processor(t):
    return finalize(t["records"], False).select("doc_id", "status")


@query("SELECT doc_id FROM {records} WHERE coalesce(response, '') = '' OR error IS NOT NULL")
def missing_responses(t):
    return missing(t["records"], "doc_id")


@query("SELECT id, CASE WHEN prompt = '' THEN '' END AS response FROM {work_items}")
def empty_prompt_passthrough(t):
    ask, answered = split_empty_prompts(t["work_items"])
    both = answered.unionByName(ask, allowMissingColumns=True)
    return both.select("id", "response")


@query("SELECT doc_id, lang FROM {documents} WHERE doc_id % 7 = 3")
def shard_by_position(t):
    return take_shard(with_position(t.spark.read.parquet(t.path("documents"))), 3, 7).select("doc_id", "lang")


@query("SELECT doc_id, lang, source FROM {documents}")
def shards_by_id(t):
    """All shards together are the table, whatever the hash does."""
    docs = t["documents"].select("doc_id", "lang", "source")
    out = take_shard(docs, 0, 3, "doc_id")
    for i in (1, 2):
        out = out.unionByName(take_shard(docs, i, 3, "doc_id"))
    return out


@query(
    """SELECT doc_id, source IS NOT NULL AS has_source, source AS as_string, CASE WHEN doc_id % 20 IN (2, 5) THEN 'other' WHEN text IS NULL THEN 'absent' ELSE 'text' END AS kind
       FROM {line_facts} WHERE is_object"""
)
def json_field_kinds(t):
    """Absent key, JSON null, number and text are told apart."""
    rows = parse_lines(t["raw_lines"]).where("is_object")
    value = flags.variant_string("record", "text")
    return rows.select(
        "doc_id",
        flags.variant_has("record", "source").alias("has_source"),
        flags.variant_string("record", "source").alias("as_string"),
        F.when(~flags.variant_has("record", "text"), F.lit("absent"))
        .when(value.isNull(), F.lit("other"))
        .otherwise(F.lit("text"))
        .alias("kind"),
    )


@query(
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN true WHEN 1 THEN false END AS success,
              CASE event_type WHEN 'view' THEN '' WHEN 'purchase' THEN 'r purchase' WHEN 'signup' THEN 'r signup' END AS response,
              CASE event_type WHEN 'error' THEN 'e' || cast(event_id % 7 AS string) END AS error,
              event_type IN ('purchase', 'signup') AS answered
       FROM {verdict_lines}"""
)
def union_response_and_truth(t):
    """A response that is text or an error object; only real booleans are verdicts."""
    rows = flags.split_response(parse_lines(t["verdict_lines"]))
    return rows.select(
        "event_id",
        flags.variant_boolean("record", "success").alias("success"),
        "response",
        "error",
        flags.is_answered().alias("answered"),
    )


@query(
    """SELECT cast(l_orderkey AS string) || '_' || cast(l_linenumber AS string) AS sample_id, l_comment AS response, l_partkey
       FROM (SELECT *, l_returnflag || l_linestatus AS l_comment FROM {lineitem})"""
)
def configured_names(t):
    config = FieldNames(response_key="answer", id_key=("l_orderkey", "l_linenumber"))
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", F.concat("l_returnflag", "l_linestatus").alias("answer"))
    return names.use_operator_names(lines, config).select("sample_id", "response", "l_partkey")
