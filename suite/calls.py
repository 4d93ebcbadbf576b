"""Operators that call user code, with test callables whose answers SQL can repeat."""

from functools import partial

from pyspark.sql import functions as F

from replyforge.operators import calls
from replyforge.operators.checkpoints import split_empty_prompts
from replyforge.operators.multimodal import build_multimodal as multimodal
from replyforge.operators.multimodal import image_prompt as with_images
from replyforge.plans.acquire import acquire as run_acquire
from replyforge.plans.collect import best_of_n_loop as collect
from replyforge.plans.feedback import feedback_rounds as run_feedback
from replyforge.plans.inference import run_inference as infer_run
from replyforge.plans.tagging import tag_statements as run_tagging
from replyforge.sources.storage import materialize, new_path
from replyforge.streaming.calls import answered, call_stream
from replyforge.streaming.ingest import open_stream
from suite.base import query


def echo_model():
    """Answers with the prompt's length; refuses some prompts."""

    def call(prompts, histories):
        answers = [{"error": f"refused {len(p)}"} if len(p) % 10 == 3 else f"{len(p)} chars" for p in prompts]
        return answers, [f"m{len(h)}" if len(p) % 2 else None for p, h in zip(prompts, histories)]

    return call


_ECHOED = """SELECT doc_id, CASE WHEN length(text) % 10 <> 3 THEN cast(length(text) AS string) || ' chars' END AS response,
              CASE WHEN length(text) % 10 = 3 THEN 'refused ' || cast(length(text) AS string) END AS error,
              CASE WHEN length(text) % 2 = 1 THEN 'm0' END AS meta_response FROM {documents}"""


@query(_ECHOED)
def infer_batch(t):
    asked = t["documents"].select("doc_id", F.col("text").alias("prompt"))
    return calls.infer_batch(asked, echo_model, 64).select("doc_id", "response", "error", "meta_response")


@query(_ECHOED)
def infer_with_time_limit(t):
    """The model in a process of its own."""
    asked = t["documents"].select("doc_id", F.col("text").alias("prompt"))
    return calls.infer_batch(asked, echo_model, 64, timeout=300.0).select("doc_id", "response", "error", "meta_response")


@query(_ECHOED)
def infer_on_a_stream(t):
    """Prompts in three files that follow each other, a third of them in two: each is asked for once."""
    base = new_path(t.spark, "prompts")
    asked = t["documents"].select("doc_id", F.col("text").alias("prompt"))
    for part in range(3):
        asked.where((F.col("doc_id") % 3 == part) | (F.lit(part == 2) & (F.col("doc_id") % 3 == 1))).write.mode("append").parquet(f"{base}/src")
        rows = open_stream(t.spark, f"{base}/src", "parquet", asked.schema, "*.parquet")
        call_stream(rows, partial(calls.infer_batch, predictor=echo_model, batch_size=64), f"{base}/sink", ["doc_id"]).awaitTermination()
    return answered(t.spark, f"{base}/sink", asked.schema).select("doc_id", "response", "error", "meta_response")


@query("""SELECT id, CASE WHEN prompt = '' THEN '' ELSE cast(length(prompt) AS string) || ' chars' END AS response FROM {work_items}""")
def infer_in_chunks(t):
    """A run in pieces that are committed one by one, taken up a second time."""
    path = new_path(t.spark, "run")
    for _ in range(2):
        out = infer_run(t["work_items"], steady_model, "proof", run_path=path, chunks=3, batch_size=64)
    return out.select("id", "response")


@query(
    """SELECT id, CASE WHEN prompt = '' THEN '' WHEN length(prompt) % 10 <> 3 THEN cast(length(prompt) AS string) || ' chars' END AS response FROM {work_items}"""
)
def infer_with_empty_prompts(t):
    ask, answered = split_empty_prompts(t["work_items"])
    out = calls.infer_batch(ask, echo_model).unionByName(answered, allowMissingColumns=True)
    return out.select("id", "response")


def difficulty_model():
    """Replies in the shapes of a chatty model, by the length of the prompt."""

    def call(prompt):
        n = len(prompt)
        body = f'{{"Difficulty": {n % 10}.5, "Rationale": "n{n}"}}'
        return [body, f"Sure.\n```json\n{body}\n```", f"I say {body} .", "no idea", '{"Rationale": "x"}'][n % 5]

    return call


_TAGGED = """SELECT uuid, formal_statement, cast(CASE WHEN n % 5 < 3 THEN n % 10 + 0.5 END AS double) AS difficulty_score, coalesce(n % 5 < 3, false) AS success,
              CASE WHEN n IS NULL THEN 'Empty formal statement' WHEN n % 5 = 3 THEN 'No valid JSON found in response' WHEN n % 5 = 4 THEN 'Missing expected key: Difficulty' END AS error
       FROM (SELECT cast(doc_id AS string) AS uuid, CASE WHEN doc_id % 9 = 0 THEN '' ELSE trim(text, ' ' || chr(10)) END AS formal_statement,
                    CASE WHEN doc_id % 9 <> 0 THEN length('Rate: ' || trim(text, ' ' || chr(10))) END AS n FROM {documents})"""


@query(_TAGGED)
def tag_with_model(t):
    statements = t["documents"].select(
        F.col("doc_id").cast("string").alias("uuid"),
        F.when(F.col("doc_id") % 9 == 0, F.lit(" \n")).otherwise(F.col("text")).alias("formal_statement"),
    )
    tagged = run_tagging(statements, difficulty_model, "Rate: {}", tries=2, delay=0.0)
    return tagged.select("uuid", "formal_statement", "difficulty_score", "success", "error")


@query(_TAGGED)
def tag_in_chunks(t):
    """The same in pieces that are committed one by one, taken up a second time."""
    statements = t["documents"].select(
        F.col("doc_id").cast("string").alias("uuid"),
        F.when(F.col("doc_id") % 9 == 0, F.lit(" \n")).otherwise(F.col("text")).alias("formal_statement"),
    )
    path = new_path(t.spark, "run")
    for _ in range(2):
        tagged = run_tagging(statements, difficulty_model, "Rate: {}", tries=2, delay=0.0, run_path=path, chunks=3)
    return tagged.select("uuid", "formal_statement", "difficulty_score", "success", "error")


def size_fetcher():
    """A stand-in for a download: the size is the length of the target, some hosts are down."""

    def call(url, target):
        if len(url) % 7 == 2:
            raise OSError(f"gone {len(url)}")
        return len(target)

    return call


_FETCHED = """
    SELECT manifest, repo, commit_id, rel_path, page_id % 4 = 0 OR length(url) % 7 <> 2 AS success, page_id % 4 = 0 AS skipped,
           CASE WHEN page_id % 4 = 0 THEN n_bytes WHEN length(url) % 7 <> 2 THEN length(target) ELSE 0 END AS size,
           CASE WHEN page_id % 4 <> 0 AND length(url) % 7 = 2 THEN 'gone ' || cast(length(url) AS string) END AS error
    FROM (SELECT *, 'https://raw.githubusercontent.com/' || repo || '/' || commit_id || '/' || rel_path AS url,
                 'store/part_' || cast(page_id % 30 AS string) || '.v1/' || repo || '/' || commit_id || '/' || rel_path AS target FROM {manifest})"""


@query(_FETCHED)
def fetch(t):
    outcomes, _, _ = run_acquire(t["manifest"], "store", size_fetcher, t["existing_files"])
    return outcomes.select("manifest", "repo", "commit_id", "rel_path", "success", "skipped", "size", "error")


@query(_FETCHED)
def fetch_in_chunks(t):
    path = new_path(t.spark, "run")
    for _ in range(2):
        outcomes, _, _ = run_acquire(t["manifest"], "store", size_fetcher, t["existing_files"], run_path=path, chunks=3)
    return outcomes.select("manifest", "repo", "commit_id", "rel_path", "success", "skipped", "size", "error")


@query(f"SELECT manifest AS parquet_filename FROM ({_FETCHED}) GROUP BY manifest HAVING count(*) FILTER (WHERE NOT success) = 0")
def acquire(t):
    return run_acquire(t["manifest"], "store", size_fetcher, t["existing_files"])[2]


def length_verifier():
    def call(codes, proofs):
        good = [(len(c) + len(p)) % 3 == 0 for c, p in zip(codes, proofs)]
        return [(g, None if g else f"bad {len(p)}") for g, p in zip(good, proofs)]

    return call


@query(
    """SELECT doc_id, (length(text) + length(source)) % 3 = 0 AS success,
              CASE WHEN (length(text) + length(source)) % 3 <> 0 THEN 'bad ' || cast(length(source) AS string) END AS error_messages FROM {documents}"""
)
def verify(t):
    rows = t["documents"].select("doc_id", F.col("text").alias("lean_code"), F.col("source").alias("response"))
    return calls.verify(rows, length_verifier).select("doc_id", "success", "error_messages")


def moody_model():
    """Refuses every prompt of one length class, else answers with the length."""

    def call(prompts, histories):
        return [{"error": "no"} if len(p) % 4 == 0 else f"r{len(p)}" for p in prompts], [None] * len(prompts)

    return call


@query(
    """SELECT doc_id, CASE WHEN length(text) % 4 = 0 THEN 0 ELSE 3 END AS accepted, CASE WHEN length(text) % 4 = 0 THEN 2 ELSE 0 END AS round,
              CASE WHEN length(text) % 4 = 0 THEN 'max_rounds' ELSE 'completed' END AS status,
              CASE WHEN length(text) % 4 = 0 THEN '' ELSE repeat('r' || cast(length(text) AS string) || ' ', 3) END AS joined FROM {documents}"""
)
def best_of_n_loop(t):
    samples = t["documents"].select("doc_id", F.col("text").alias("prompt"))
    out = collect(samples, moody_model, 3, 2)
    return out.select(
        "doc_id",
        F.size("response_n").alias("accepted"),
        "round",
        "status",
        F.array_join(F.transform("response_n", lambda r: F.concat(r, F.lit(" "))), "").alias("joined"),
    )


# Round r: the prompt's length gives the proof, code and proof lengths give the verdict.
_FIRST = """r1 AS (SELECT doc_id, text AS code, 'r' || cast(length('P:No previous attempt E:No error messages C:' || text) AS string) AS proof FROM {documents}),
    v1 AS (SELECT *, (length(code) + length(proof)) % 3 = 0 AS success, 'bad ' || cast(length(proof) AS string) AS msg FROM r1)"""
_NEXT = """r{b} AS (SELECT doc_id, code, 'r' || cast(length('P:' || proof || ' E:' || msg || ' C:' || code) AS string) AS proof FROM v{a} WHERE NOT success),
    v{b} AS (SELECT *, (length(code) + length(proof)) % 3 = 0 AS success, 'bad ' || cast(length(proof) AS string) AS msg FROM r{b})"""
_ROUNDS = f"WITH {_FIRST}, {_NEXT.format(a=1, b=2)}, {_NEXT.format(a=2, b=3)} "


def all_lengths_model():
    return lambda prompts, histories: ([f"r{len(p)}" for p in prompts], [None] * len(prompts))


@query(
    _ROUNDS
    + " UNION ALL ".join(
        f"SELECT {r} AS round, cast(doc_id AS string) || '_0' AS id, proof AS proof_of_last_round, success, CASE WHEN NOT success THEN msg END AS error_messages FROM v{r}"
        for r in (1, 2, 3)
    )
)
def feedback_rounds(t):
    statements = t["documents"].select(F.col("doc_id").alias("id"), F.col("text").alias("lean_code"))
    verdicts, _ = run_feedback(statements, all_lengths_model, length_verifier, "P:{} E:{} C:{}", max_rounds=3)
    return verdicts.select("round", "id", "proof_of_last_round", "success", "error_messages")


@query(
    _ROUNDS
    + " UNION ALL ".join(
        f"""SELECT {r} AS round, count(*) FILTER (WHERE success) AS success, count(*) FILTER (WHERE NOT success) AS failed, count(*) AS total,
                   count(*) FILTER (WHERE success) / count(*) * 100 AS accuracy FROM v{r}"""
        for r in (1, 2, 3)
    )
)
def feedback_summary(t):
    statements = t["documents"].select(F.col("doc_id").alias("id"), F.col("text").alias("lean_code"))
    return run_feedback(statements, all_lengths_model, length_verifier, "P:{} E:{} C:{}", max_rounds=3)[1]


@query(
    """SELECT w.id, CASE WHEN s.bucket = 'completed' THEN s.prompt WHEN w.prompt = '' THEN '' WHEN s.bucket = 'processing' THEN s.prompt ELSE w.prompt END AS prompt,
              CASE WHEN s.bucket = 'completed' THEN s.response
                   WHEN w.prompt = '' THEN ''
                   ELSE cast(length(CASE WHEN s.bucket = 'processing' THEN s.prompt ELSE w.prompt END) AS string) || ' chars' END AS response
       FROM {work_items} w LEFT JOIN (SELECT * FROM {saved_buckets} WHERE bucket IN ('completed', 'processing')) s ON w.id = s.id"""
)
def run_inference(t):
    """Reuse, requeue, empty prompts and fresh rows in one resumable run."""
    saved = t["saved"].withColumn("response_n", F.array().cast("array<string>"))
    out = infer_run(t["work_items"], steady_model, "proof-bon", [saved], n=1, max_rounds=3)
    got = F.coalesce(F.try_element_at("response_n", F.lit(1)), F.col("response"))
    return out.select("id", "prompt", got.alias("response"))


@query(
    """SELECT w.id, w.prompt, CASE WHEN s.bucket = 'completed' THEN s.response WHEN w.prompt = '' THEN '' ELSE cast(length(w.prompt) AS string) || ' chars' END AS response
       FROM {work_items} w LEFT JOIN (SELECT * FROM {saved_buckets} WHERE bucket IN ('completed', 'processing')) s ON w.id = s.id"""
)
def run_inference_without_saved_prompts(t):
    """A checkpoint written without its prompt column: rows go on with the prompt of the input."""
    saved = t["saved"].withColumn("response_n", F.array().cast("array<string>")).drop("prompt")
    out = infer_run(t["work_items"], steady_model, "proof-bon", [saved], n=1, max_rounds=3)
    got = F.coalesce(F.try_element_at("response_n", F.lit(1)), F.col("response"))
    return out.select("id", "prompt", got.alias("response"))


def steady_model():
    return lambda prompts, histories: ([f"{len(p)} chars" for p in prompts], [None] * len(prompts))


@query(
    """SELECT page_id, pos, kind, md5(content) AS content_md5 FROM (
         SELECT page_id, 0 AS pos, 'text' AS kind, url AS content FROM {pages}
         UNION ALL SELECT page_id, 1, 'image_url', 'data:image/jpeg;base64,' || base64(encode(html)) FROM {pages}
         UNION ALL SELECT page_id, 2, 'text', 'end' FROM {pages})"""
)
def build_multimodal(t):
    """The page source stands in for an image file."""
    pages = materialize(t["pages"], "pages")
    name = F.concat(F.lit("/img/"), F.col("page_id").cast("string"))
    prompts = pages.select("page_id", F.array("url", F.concat(F.lit("<image> "), name), F.lit("end")).alias("parts"))
    images = pages.select(name.alias("path"), F.encode("html", "UTF-8").alias("content"))
    items = multimodal(prompts, images).select("page_id", F.posexplode("items").alias("pos", "i"))
    return items.select(
        "page_id", "pos", F.col("i.type").alias("kind"), F.md5(F.coalesce("i.text", "i.image")).alias("content_md5")
    )


@query(
    """SELECT page_id, pos, kind, content FROM (
         SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END AS pos, 'text' AS kind, 'see  ' || url AS content FROM {pages}
         UNION ALL SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 0 ELSE 1 END, 'image', 'file://a' || cast(page_id AS string) FROM {pages} WHERE page_id % 3 <> 2)"""
)
def image_prompt(t):
    prompt = F.concat(F.lit("see <image>  "), "url")
    images = F.array(F.concat(F.lit("a"), F.col("page_id").cast("string")))
    items = (
        F.when(F.col("page_id") % 3 == 0, with_images(prompt, images, "before"))
        .when(F.col("page_id") % 3 == 1, with_images(prompt, images, "after"))
        .otherwise(with_images(prompt, images, "none"))
    )
    rows = t["pages"].select("page_id", F.posexplode(items).alias("pos", "i"))
    return rows.select("page_id", "pos", F.col("i.type").alias("kind"), F.coalesce("i.text", "i.image").alias("content"))
