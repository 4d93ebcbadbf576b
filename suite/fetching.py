"""Fetch plans, ledgers and outcome figures."""

from pyspark.sql import functions as F

from replyforge.operators import fetching as X
from suite.base import query


@query("SELECT file, cast((row_number() OVER (ORDER BY file) - 1) // 50 AS bigint) AS group_id FROM (SELECT DISTINCT file FROM {page_files})")
def file_groups(t):
    return X.file_groups(t["page_files"])


@query("SELECT file, cast((row_number() OVER (ORDER BY file) - 1) // 50 AS bigint) AS group_id FROM (SELECT DISTINCT file FROM {page_files})")
def file_groups_of_long_lists(t):
    """Same numbers when the list is cut into ranges."""
    return X.file_groups(t["page_files"])


@query(
    """SELECT page_id, 'https://raw.githubusercontent.com/' || repo || '/' || commit_id || '/' || rel_path AS url,
              'store/part_' || cast(page_id % 30 AS string) || '.v1/' || repo || '/' || commit_id || '/' || rel_path AS target,
              CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'src/a b' ELSE 'x/y.z' END AS dir_name, split_part(rel_path, '/', -1) AS file_name
       FROM {manifest}"""
)
def fetch_plan(t):
    plan = X.fetch_plan(t["manifest"], "store/")
    keyed = t["manifest"].select("page_id", "repo", "commit_id", "rel_path")
    return plan.join(keyed, ["repo", "commit_id", "rel_path"]).select("page_id", "url", "target", "dir_name", "file_name")


@query("SELECT DISTINCT 'in/' || manifest AS file FROM {manifest} WHERE manifest NOT IN (SELECT parquet_filename FROM {ledger})")
def remaining_files(t):
    files = t["manifest"].select(F.concat(F.lit("in/"), "manifest").alias("file")).distinct()
    return X.remaining_files(files, t["ledger"])


@query("SELECT manifest, repo, commit_id, rel_path FROM {manifest} WHERE page_id % 4 <> 0")
def fetches_left(t):
    todo, _ = X.skip_fetched(X.fetch_plan(t["manifest"], "store"), t["existing_files"])
    return todo.select("manifest", "repo", "commit_id", "rel_path")


@query("SELECT manifest, repo, commit_id, rel_path, true AS success, true AS skipped, n_bytes AS size FROM {manifest} WHERE page_id % 4 = 0")
def skip_fetched(t):
    _, there = X.skip_fetched(X.fetch_plan(t["manifest"], "store"), t["existing_files"])
    return there.select("manifest", "repo", "commit_id", "rel_path", "success", "skipped", "size")


_STATS = """
    SELECT manifest, count(*) AS total_files, count(*) FILTER (WHERE success) AS successful, count(*) FILTER (WHERE success AND NOT skipped) AS new_files,
           count(*) FILTER (WHERE success AND skipped) AS skipped_files, count(*) FILTER (WHERE NOT success) AS failed,
           cast(coalesce(sum(size) FILTER (WHERE success), 0) AS bigint) AS total_size, count(*) FILTER (WHERE NOT success) = 0 AS success
    FROM {outcomes} GROUP BY manifest"""


@query(_STATS)
def fetch_stats(t):
    return X.fetch_stats(t["outcomes"])


@query(f"SELECT manifest AS parquet_filename FROM ({_STATS}) WHERE success")
def ledger_entries(t):
    return X.ledger_entries(X.fetch_stats(t["outcomes"]))
