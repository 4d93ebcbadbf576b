"""Readers, writers and streaming ingest, each as a round trip through the shared folder."""

import gzip
import time

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyforge.operators.profile import column_profile as profile
from replyforge.operators.profile import preview as first_few
from replyforge.sources import jsonl, sinks, tables
from replyforge.functions.text import basename, dirname
from replyforge.sources.files import open_folder
from replyforge.sources.snapshots import latest_snapshot as newest
from replyforge.sources.snapshots import snapshot_files
from replyforge.sources.storage import materialize, new_path
from replyforge.streaming.ingest import appended_lines, ingest_appended, ingest_stream, jsonl_stream, open_stream
from suite.base import query

LINE = "doc_id bigint, text string, source string"


def _raw_folder(t) -> str:
    """The damaged JSONL lines as text files."""
    path = new_path(t.spark, "raw")
    t["raw_lines"].select("value").write.text(path)
    return path


@query("SELECT doc_id, source, md5(text) AS text_md5 FROM {line_facts} WHERE is_object")
def read_jsonl(t):
    rows = jsonl.read_jsonl(t.spark, _raw_folder(t), LINE).rows
    return rows.select("doc_id", "source", F.md5("text").alias("text_md5"))


@query(
    """SELECT count(*) AS rejects, cast(sum(length(value)) AS bigint) AS chars FROM {raw_lines} WHERE doc_id % 20 IN (0, 4, 6)"""
)
def read_jsonl_rejects(t):
    rejects = jsonl.read_jsonl(t.spark, _raw_folder(t)).rejects
    return rejects.agg(F.count("*").alias("rejects"), F.sum(F.length("value")).alias("chars"))


@query("SELECT source, max(doc_id) AS doc_id, arg_max(lang, doc_id) AS lang FROM {documents} GROUP BY source")
def read_json_table(t):
    path = new_path(t.spark, "keyed") + ".jsonl"
    # Several files of unequal size, ordered by id from file to file and inside each.
    docs = t["documents"].select("source", "doc_id", "lang", "text")
    sinks.write_jsonl(docs.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id"), path)
    schema = "source string, doc_id bigint, lang string"
    return jsonl.read_json_table(t.spark, path.removesuffix(".jsonl"), "source", schema).select("source", "doc_id", "lang")


@query("SELECT doc_id, source AS dotted, lang AS quoted FROM {documents}")
def read_jsonl_dotted_names(t):
    """Field names with dots and quotes."""
    path = new_path(t.spark, "dotted")
    t["documents"].select("doc_id", F.col("source").alias("a.b"), F.col("lang").alias("it's")).write.json(path)
    rows = jsonl.read_jsonl(t.spark, path, T.StructType.fromDDL("doc_id bigint, `a.b` string, `it's` string")).rows
    return rows.select("doc_id", F.col("`a.b`").alias("dotted"), F.col("`it's`").alias("quoted"))


@query("SELECT idx, user_id, event_type FROM (SELECT *, event_id AS idx FROM {events}) WHERE idx = 7")
def lookup_idx(t):
    return jsonl.lookup_idx(t["events"].withColumnRenamed("event_id", "idx"), 7).select("idx", "user_id", "event_type")


@query("SELECT cast(doc_id AS string) AS uuid, text AS formal_statement FROM {documents}")
def read_statements(t):
    path = new_path(t.spark, "statements")
    t["documents"].select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("formal_statement"), "lang").write.parquet(path)
    return tables.read_statements(t.spark, path)


@query("SELECT repo, commit_id, rel_path FROM {manifest}")
def read_manifest(t):
    path = new_path(t.spark, "manifest")
    t["manifest"].write.parquet(path)
    return tables.read_manifest(t.spark, path).select("repo", "commit_id", "rel_path")


@query("SELECT doc_id, doc_id AS _rowid, 'documents.parquet' AS lance_dataset FROM {documents}")
def read_dataset(t):
    return tables.read_dataset(t.spark, t.path("documents")).select("doc_id", "_rowid", "lance_dataset")


@query("SELECT doc_id, (doc_id % 4) * 4294967296 + row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1 AS _rowid FROM {documents}")
def read_dataset_many_files(t):
    """Four files, in the order of their paths; every row's number is its file's place and its own in it."""
    path = new_path(t.spark, "dataset")
    docs = t["documents"].select("doc_id", (F.col("doc_id") % 4).alias("part"))
    docs.repartition(4, "part").sortWithinPartitions("part", "doc_id").write.partitionBy("part").parquet(path)
    return tables.read_dataset(t.spark, path).select("doc_id", "_rowid")


@query("SELECT md5(value) AS line, count(*) AS n FROM {raw_lines} GROUP BY 1")
def scan_dir(t):
    lines = jsonl.scan_dir(t.spark, _raw_folder(t), "*.txt")
    return lines.where(F.col("source_file").endswith(".txt")).groupBy(F.md5("value").alias("line")).agg(F.count("*").alias("n"))


def _torn(folder: str):
    """Task side: a packed file whose end is missing."""

    def run(batches):
        for batch in batches:
            files, place = open_folder(folder)
            whole = gzip.compress("\n".join(batch.column("value").to_pylist()).encode(), compresslevel=0)
            with files.open_output_stream(f"{place}/torn.txt.gz", compression=None) as out:
                out.write(whole[: len(whole) // 2])
            yield batch

    return run


@query(
    """SELECT md5(value) AS line, count(*) AS n, false AS failed FROM {raw_lines} WHERE value <> '' GROUP BY 1
       UNION ALL SELECT 'torn.txt.gz', 1, true"""
)
def scan_files(t):
    """Packed files, one of which cannot be read to its end: it gives no line, and is named."""
    path = new_path(t.spark, "packed")
    t["raw_lines"].select("value").write.option("compression", "gzip").text(path)
    t["region"].select(F.col("r_name").alias("value")).coalesce(1).mapInArrow(_torn(path), "value string").collect()
    good, failed = jsonl.part_failed(materialize(jsonl.scan_files(t.spark, path, "*.txt.gz"), "lines"))
    lines = good.where("value <> ''").groupBy(F.md5("value").alias("line")).agg(F.count("*").alias("n"))
    named = failed.groupBy(F.col("source_file").alias("line")).agg(F.count("*").alias("n"))
    return lines.withColumn("failed", F.lit(False)).unionByName(named.withColumn("failed", F.lit(True)))


@query(
    """SELECT doc_id, lang, md5(text) AS text_md5, CASE WHEN doc_id % 2 = 0 THEN source END AS maybe FROM {documents}"""
)
def write_jsonl(t):
    """Overwrite, then append; the prompt goes, nulls and non-ASCII text stay."""
    docs = t["documents"].select(
        "doc_id", "lang", "text", F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("maybe"), F.lit("p").alias("prompt")
    )
    path = new_path(t.spark, "out")
    sinks.write_jsonl(docs.where("doc_id % 3 = 0"), path, "overwrite", save_prompt=False)
    sinks.write_jsonl(docs.where("doc_id % 3 <> 0"), path, "append", save_prompt=False)
    lines = t.spark.read.text(path)
    keys = lines.select("*", F.json_object_keys("value").alias("keys"))
    whole = keys.where((F.size("keys") == 4) & ~F.array_contains("keys", "prompt"))
    back = whole.select(F.from_json("value", "doc_id bigint, lang string, text string, maybe string").alias("r")).select("r.*")
    return back.select("doc_id", "lang", F.md5("text").alias("text_md5"), "maybe")


@query("SELECT doc_id, source || '.jsonl' AS source_file, lang FROM {documents}")
def write_by_source(t):
    path = new_path(t.spark, "by_source")
    sinks.write_by_source(t["documents"].select("doc_id", "lang", F.concat("source", F.lit(".jsonl")).alias("source_file")), path)
    schema = "doc_id bigint, lang string, source_file string"
    return t.spark.read.schema(schema).json(path).select("doc_id", "source_file", "lang")


@query("SELECT event_id, user_id, event_type, value FROM {events}")
def ingest_stream_twice(t):
    """A second run over the same folder adds nothing."""
    base = new_path(t.spark, "stream")
    # A pattern that matches the table whether it is one file or a folder of files.
    src = f"{t.sf_dir}/events.parque[t]"
    for _ in range(2):
        rows = open_stream(t.spark, src, "parquet", t["events"].schema, "*.parquet")
        ingest_stream(rows, f"{base}/sink", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{base}/sink").select("event_id", "user_id", "event_type", "value")


def _append(folder: str):
    """Task side: put each group's lines behind what its file holds."""

    def run(table: pa.Table) -> pa.Table:
        name = table.column("file")[0].as_py()
        files, place = open_folder(folder)
        files.create_dir(place, recursive=True)
        with files.open_append_stream(f"{place}/{name}") as out:
            out.write("".join(f"{v}\n" for v in table.sort_by("event_id").column("value").to_pylist()).encode())
        return table.select(["file"]).slice(0, 1)

    return run


@query("SELECT cast(user_id % 4 AS string) || '.jsonl' AS source_file, count(*) AS lines, cast(sum(event_id) AS bigint) AS ids FROM {events} GROUP BY 1")
def ingest_growing_files(t):
    """Four files in two helpings, looked at after each and once more."""
    base = new_path(t.spark, "growing")
    row = F.to_json(F.struct("event_id", "event_type"))
    lines = t["events"].select("event_id", row.alias("value"), F.concat((F.col("user_id") % 4).cast("string"), F.lit(".jsonl")).alias("file"))
    for part in (F.col("event_id") % 1000 < 400, F.col("event_id") % 1000 >= 400):
        lines.where(part).groupBy("file").applyInArrow(_append(f"{base}/src"), "file string").collect()
        ingest_appended(t.spark, f"{base}/src", f"{base}/sink")
    ingest_appended(t.spark, f"{base}/src", f"{base}/sink")
    ids = appended_lines(t.spark, f"{base}/sink").select("source_file", F.from_json("value", "event_id bigint")["event_id"].alias("id"))
    return ids.groupBy("source_file").agg(F.count("*").alias("lines"), F.sum("id").alias("ids"))


@query("SELECT doc_id, source, md5(text) AS text_md5 FROM {line_facts} WHERE is_object")
def ingest_jsonl_stream(t):
    """Damaged lines through the tolerant parser on a stream."""
    base = new_path(t.spark, "stream")
    rows = jsonl_stream(t.spark, _raw_folder(t), LINE, pattern="*.txt")
    ingest_stream(rows, f"{base}/sink", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{base}/sink").select("doc_id", "source", F.md5("text").alias("text_md5"))


def _snapshots(folder: str):
    """Task side: a file per row, its line in it."""

    def run(batches):
        for batch in batches:
            files, place = open_folder(folder)
            for name, line in zip(batch.column("name").to_pylist(), batch.column("line").to_pylist()):
                files.create_dir(f"{place}/{name.rsplit('/', 1)[0]}", recursive=True)
                with files.open_output_stream(f"{place}/{name}") as out:
                    out.write(f"{line}\n".encode())
            yield batch

    return run


@query(
    """SELECT 'part' || cast(user_id % 8 AS string) AS part, 'snapshot_' || cast(min(event_id) AS string) || '.jsonl' AS name, min(event_id) AS event_id
       FROM {events} GROUP BY 1"""
)
def latest_snapshot(t):
    """Two snapshots of each part, the later one with the smaller number; their folders are listed, the newest are read."""
    base = new_path(t.spark, "snapshots")
    part = F.concat(F.lit("part"), (F.col("user_id") % 8).cast("string")).alias("part")
    ends = t["events"].groupBy(part).agg(F.max("event_id").alias("first"), F.min("event_id").alias("second"))
    for wave in ("first", "second"):
        rows = ends.select(
            F.concat("part", F.lit("/snapshot_"), F.col(wave).cast("string"), F.lit(".jsonl")).alias("name"),
            F.to_json(F.struct(F.col(wave).alias("event_id"))).alias("line"),
        )
        rows.mapInArrow(_snapshots(base), "name string, line string").collect()
        time.sleep(0.05)  # file times of the two waves must differ
    found = newest(snapshot_files(t.spark, base)).select(basename("part").alias("part"), basename("path").alias("name"), "path")
    lines = t.spark.read.option("recursiveFileLookup", "true").text(base).select(
        F.concat_ws("/", basename(dirname("_metadata.file_path")), basename("_metadata.file_path")).alias("at"), F.from_json("value", "event_id bigint")["event_id"].alias("event_id")
    )
    return found.join(lines, F.concat_ws("/", "part", "name") == F.col("at")).select("part", "name", "event_id")


@query(
    """SELECT 'doc_id' AS column_name, count(doc_id) AS non_null, count(*) AS total FROM {documents}
       UNION ALL SELECT 'text', count(text), count(*) FROM {documents}
       UNION ALL SELECT 'lang', count(lang), count(*) FROM {documents}
       UNION ALL SELECT 'source', count(source), count(*) FROM {documents}
       UNION ALL SELECT 'n_chars', count(n_chars), count(*) FROM {documents}
       UNION ALL SELECT 'quality', count(quality), count(*) FROM {documents} LEFT JOIN {labels} USING (doc_id)
       UNION ALL SELECT 'toxic', count(toxic), count(*) FROM {documents} LEFT JOIN {labels} USING (doc_id)"""
)
def column_profile(t):
    wide = t["documents"].join(t["labels"].select("doc_id", "quality", "toxic"), "doc_id", "left")
    return profile(wide)


@query("SELECT doc_id, lang, source FROM {documents} ORDER BY doc_id LIMIT 5")
def preview(t):
    return first_few(t["documents"].select("doc_id", "lang", "source"), 5, ["doc_id"])


@query("SELECT conv_id, turn, role, text FROM {turns}")
def materialize_table(t):
    """A written intermediate table gives back what went in."""
    return materialize(t["turns"], "turns")


_VERDICT = "event_id % 6 IN (0, 1)"


@query(f"SELECT split_part(id, '_', 1) AS query_id, event_id AS response_idx, event_id % 6 = 0 AS success FROM {{verdict_lines}} JOIN {{attempts}} ON event_id = response_idx WHERE {_VERDICT}")
def read_verdicts(t):
    path = new_path(t.spark, "verdicts")
    t["verdict_lines"].select("value").write.text(path)
    return jsonl.read_verdicts(t.spark, path).rows


@query(f"SELECT count(*) AS rejects FROM {{verdict_lines}} WHERE NOT ({_VERDICT})")
def read_verdicts_rejects(t):
    return jsonl.verdict_rows(jsonl.parse_lines(t["verdict_lines"])).rejects.agg(F.count("*").alias("rejects"))
