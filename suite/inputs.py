"""Inputs derived from the given tables. Every row of a table is used; damage and gaps go by its keys."""

# Text as the inside of a JSON string, in SQL that both engines read.
_ESCAPED = (
    "replace(replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'),"
    " chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"
)
_ID = "cast(doc_id AS string)"

INPUTS: dict[str, str | tuple[str, str]] = {
    # ---- attempts and verdicts
    "attempts": """
        SELECT cast(user_id AS string) || '_' || cast(event_id AS string) AS id,
               cast(user_id AS string) AS query_id, event_id AS response_idx,
               event_type = 'purchase' AS success
        FROM {events}""",
    "line_attempts": """
        SELECT l_orderkey AS query_id, l_linenumber AS response_idx, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
               l_returnflag = 'R' AS success
        FROM {lineitem}""",
    "bad_ids": """
        SELECT event_id, event_type = 'purchase' AS success,
               CASE event_id % 10
                    WHEN 0 THEN cast(user_id AS string)
                    WHEN 1 THEN cast(user_id AS string) || '_1_' || cast(event_id AS string)
                    WHEN 2 THEN cast(user_id AS string) || '_x' || cast(event_id AS string)
                    WHEN 3 THEN NULL
                    WHEN 4 THEN cast(user_id AS string) || '_ +' || cast(event_id AS string)
                    WHEN 5 THEN cast(user_id AS string) || '_' || cast(event_id AS string) || '.0'
                    ELSE cast(user_id AS string) || '_' || cast(event_id AS string) END AS id
        FROM {events}""",
    "bon_attempts": """
        SELECT user_id AS id, event_id AS attempt, event_type = 'error' AS err,
               event_type || ':' || cast(event_id AS string) AS response
        FROM {events}""",
    "verdicts": """
        SELECT l_orderkey AS id, l_linenumber AS round, l_partkey, l_suppkey,
               CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag = 'R' END AS success
        FROM {lineitem}""",
    "feedback_rows": """
        SELECT cast(doc_id AS string) || '_' || cast(doc_id % 4 AS string) AS id,
               CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS success,
               CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS lean_code,
               CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE source || ' {{}} proof' END AS proof_of_last_round,
               CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'line ' || cast(n_chars AS string) END AS error_messages
        FROM {documents}""",
    # ---- raw JSONL lines, some of them damaged
    "raw_lines": f"""
        SELECT doc_id, source || '.jsonl' AS source_file,
               CASE doc_id % 20
                    WHEN 0 THEN '{{{{"doc_id": ' || {_ID} || ', "text": "' || {_ESCAPED}
                    WHEN 1 THEN '{{{{"doc_id": ' || {_ID} || ', "source": "' || source || '"}}}}'
                    WHEN 2 THEN '{{{{"doc_id": ' || {_ID} || ', "text": null}}}}'
                    WHEN 3 THEN '  ' || chr(9) || ' '
                    WHEN 4 THEN '[' || {_ID} || ']'
                    WHEN 5 THEN '{{{{"doc_id": ' || {_ID} || ', "text": 5, "source": "' || source || '"}}}}'
                    WHEN 6 THEN '{{{{"doc_id": ' || {_ID} || ', "text": "' || {_ESCAPED} || '"}}}} and more'
                    ELSE '{{{{"doc_id": ' || {_ID} || ', "text": "' || {_ESCAPED} || '", "source": "' || source || '"}}}}' END AS value
        FROM {{documents}}""",
    # What a reader of raw_lines should find, stated without any JSON.
    "line_facts": """
        SELECT doc_id, source || '.jsonl' AS source_file, doc_id % 20 NOT IN (0, 4, 6) AS is_object,
               CASE WHEN doc_id % 20 NOT IN (0, 1, 2, 4, 5, 6) THEN text END AS text,
               CASE WHEN doc_id % 20 NOT IN (0, 2, 4, 6) THEN source END AS source
        FROM {documents} WHERE doc_id % 20 <> 3""",
    # ---- the union field and the truth values of verdict lines
    "verdict_lines": """
        SELECT event_id, '{{"id": "' || cast(user_id AS string) || '_' || cast(event_id AS string) || '", "response": ' ||
               CASE event_type WHEN 'error' THEN '{{"error": "e' || cast(event_id % 7 AS string) || '"}}' WHEN 'view' THEN '""' WHEN 'click' THEN 'null' ELSE '"r ' || event_type || '"' END ||
               CASE event_id % 6 WHEN 0 THEN ', "success": true' WHEN 1 THEN ', "success": false' WHEN 2 THEN ', "success": "false"' WHEN 3 THEN ', "success": 1' WHEN 4 THEN ', "success": null' ELSE '' END || '}}' AS value,
               event_type
        FROM {events}""",
    # ---- classifier: smoothed log-odds counted from labelled documents
    "token_counts": (
        """SELECT quality, token, count(*) AS n
           FROM (SELECT quality, explode(split(translate(text, chr(10), ' '), ' ')) AS token
                 FROM {documents} JOIN {labels} USING (doc_id))
           WHERE token <> '' GROUP BY quality, token""",
        """SELECT quality, token, count(*) AS n
           FROM (SELECT quality, unnest(string_split(translate(text, chr(10), ' '), ' ')) AS token
                 FROM {documents} JOIN {labels} USING (doc_id))
           WHERE token <> '' GROUP BY quality, token""",
    ),
    "class_totals": """
        SELECT quality, cast(sum(n) AS bigint) AS total FROM {token_counts} GROUP BY quality""",
    "vocabulary": "SELECT token FROM {token_counts} GROUP BY token",
    "vocabulary_size": "SELECT count(*) AS v FROM {vocabulary}",
    # Every word gets a weight for both labels; the sizes are one row, attached as scalars.
    "class_model": """
        SELECT '__label__' || cast(o.quality AS string) AS label, o.token,
               ln((o.n + 1.0) / (t.total + (SELECT v FROM {vocabulary_size}))) AS weight
        FROM (SELECT 0 AS quality, token, cast(sum(CASE WHEN quality = 0 THEN n ELSE 0 END) AS bigint) AS n FROM {token_counts} GROUP BY token
              UNION ALL
              SELECT 1 AS quality, token, cast(sum(CASE WHEN quality = 1 THEN n ELSE 0 END) AS bigint) AS n FROM {token_counts} GROUP BY token) o
        JOIN {class_totals} t ON o.quality = t.quality""",
    # ---- statements and prompts
    "statements": """
        SELECT doc_id AS id,
               CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS lean_code,
               CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE source || ' {{0}} problem' END AS statement,
               CASE doc_id % 7 WHEN 0 THEN NULL ELSE 'gen ' || lang END AS g_code, 'gen ' || source AS g_statement
        FROM {documents}""",
    "nested_statements": (
        "SELECT id, lean_code, statement, named_struct('lean_code', g_code, 'statement', g_statement) AS generated FROM {statements}",
        "SELECT * FROM {statements}",
    ),
    # The nations of a region are the options of every question put to it.
    "choices": (
        """SELECT doc_id, text AS question, source AS subfield, options
           FROM {documents} JOIN (SELECT n_regionkey, array_sort(collect_list(n_name)) AS options FROM {nation} GROUP BY n_regionkey) o ON o.n_regionkey = doc_id % 5""",
        """SELECT doc_id, text AS question, source AS subfield, options
           FROM {documents} JOIN (SELECT n_regionkey, list(n_name ORDER BY n_name) AS options FROM {nation} GROUP BY n_regionkey) o ON o.n_regionkey = doc_id % 5""",
    ),
    # ---- model replies in every shape the extractor knows
    "replies": f"""
        SELECT doc_id, source,
               CASE doc_id % 10
                    WHEN 0 THEN '{{{{"Difficulty": ' || cast(doc_id % 10 AS string) || '.5, "Rationale": "' || {_ESCAPED} || '"}}}}'
                    WHEN 1 THEN text || ' ```json' || chr(10) || '{{{{"Difficulty": ' || cast(doc_id % 10 AS string) || ', "Rationale": "é ' || source || '"}}}}' || chr(10) || '```'
                    WHEN 2 THEN '```' || chr(10) || ' {{{{"Difficulty": ' || cast(doc_id % 10 AS string) || ', "Rationale": "' || lang || '"}}}} ```'
                    WHEN 3 THEN text || ' {{{{"Difficulty": ' || cast(doc_id % 10 AS string) || ', "Rationale": "r"}}}} ' || source
                    WHEN 4 THEN text
                    WHEN 5 THEN '{{{{"Rationale": "' || source || '"}}}}'
                    WHEN 6 THEN '[' || cast(doc_id AS string) || ']'
                    WHEN 7 THEN 'so {{{{"Rationale": "' || source || '"}}}} it is'
                    WHEN 8 THEN '{{{{"Difficulty": ' || cast(doc_id % 10 AS string) || ', "Rationale": "' || lang || '"}}}} and more'
                    ELSE 'broken {{{{"Difficulty": ' || cast(doc_id AS string) || ' ' END AS reply
        FROM {{documents}}""",
    # ---- checkpoint records
    "records": """
        SELECT doc_id, cast(doc_id % 100 AS string) AS id, doc_id AS seq,
               CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE source || ' says' END AS response,
               CASE doc_id % 7 WHEN 0 THEN 'call failed' END AS error,
               CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'completed' WHEN 2 THEN 'processing' WHEN 3 THEN 'max_rounds' ELSE 'odd' END AS status
        FROM {documents}""",
    "saved": """
        SELECT doc_id, lang, cast(doc_id AS string) AS id, doc_id AS seq, 'saved ' || source AS prompt,
               CASE doc_id % 4 WHEN 0 THEN NULL ELSE lang || ' reply' END AS response,
               CASE doc_id % 11 WHEN 0 THEN 'call failed' END AS error,
               CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'completed' WHEN 2 THEN 'processing' WHEN 3 THEN 'max_rounds' ELSE 'odd' END AS status
        FROM {documents}""",
    "saved_buckets": """
        SELECT *, CASE WHEN coalesce(response, '') = '' OR error IS NOT NULL THEN 'no_response'
                       WHEN status IS NULL OR status = 'completed' THEN 'completed'
                       WHEN status IN ('processing', 'error', 'max_rounds', 'resume') THEN 'processing'
                       ELSE 'ignored' END AS bucket
        FROM {saved}""",
    "work_items": """
        SELECT cast(doc_id AS string) AS id, CASE WHEN doc_id % 13 = 0 THEN '' ELSE 'ask ' || source END AS prompt
        FROM {documents}""",
    "done_events": """
        SELECT CASE WHEN event_id % 17 = 0 THEN NULL ELSE cast(user_id AS string) END AS uuid,
               CASE event_type WHEN 'purchase' THEN value > 20 WHEN 'view' THEN NULL ELSE false END AS success
        FROM {events}""",
    # ---- difficulty tagging
    "tag_items": """
        SELECT doc_id, doc_id AS seq, '  ' || text || chr(10) AS natural_language_statement,
               CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE (doc_id % 21) / 2.0 - 0.5 END AS difficulty,
               CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE source END AS difficulty_rationale
        FROM {documents}""",
    "typed_items": """
        SELECT doc_id, seq, natural_language_statement, cast(difficulty AS double) AS difficulty, difficulty_rationale FROM {tag_items}""",
    "predictions": """
        SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'failed' ELSE 'success' END AS status,
               CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '{{}}'
                    ELSE '{{"Difficulty": ' || cast(quality * 3 + toxic AS string) || '.5, "Rationale": "q' || cast(quality AS string) || '"}}' END AS data,
               'reply ' || cast(doc_id AS string) AS response,
               CASE WHEN doc_id % 10 = 0 THEN 'no answer' END AS error,
               quality, toxic
        FROM {labels}""",
    "tag_asked": """
        SELECT cast(d.doc_id AS string) AS uuid, CASE WHEN d.doc_id % 8 = 0 THEN '   ' ELSE d.text END AS formal_statement,
               p.status, p.data, p.response, p.error, p.quality, p.toxic, d.doc_id
        FROM {documents} d LEFT JOIN {predictions} p ON d.doc_id = p.doc_id""",
    # ---- manifests of files to fetch
    "manifest": """
        SELECT page_id, 'part_' || cast(page_id % 30 AS string) || '.v1.parquet' AS manifest,
               'org/repo' || cast(page_id % 17 AS string) AS repo, md5(url) AS commit_id,
               CASE page_id % 3 WHEN 0 THEN 'README.md' WHEN 1 THEN 'src/a b/file' || cast(page_id AS string) || '.lean' ELSE 'x/y.z/' || cast(page_id AS string) END AS rel_path,
               cast(length(html) AS bigint) AS n_bytes
        FROM {pages}""",
    "existing_files": """
        SELECT repo, commit_id, rel_path, n_bytes AS size FROM {manifest} WHERE page_id % 4 = 0""",
    "outcomes": """
        SELECT manifest, repo, rel_path, page_id % 7 <> 3 OR page_id % 30 < 10 AS success, page_id % 4 = 0 AS skipped,
               CASE WHEN page_id % 7 <> 3 OR page_id % 30 < 10 THEN n_bytes ELSE 0 END AS size
        FROM {manifest}""",
    "page_files": "SELECT 'store/' || replace(url, '?', '/') || '_' || cast(page_id AS string) AS file, page_id FROM {pages}",
    "ledger": """
        SELECT 'part_' || cast(page_id % 30 AS string) || '.v1.parquet' AS parquet_filename FROM {pages} WHERE page_id % 30 < 12""",
    # ---- conversations
    "turns": "SELECT conv_id, turn, role, text FROM {conversations}",
}
