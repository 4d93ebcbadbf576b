"""Attempts, pass@k, best-of-N, rounds."""

from pyspark.sql import functions as F

from replyforge.functions.ids import attempt_rows, rejected_attempt_ids
from replyforge.operators import attempts as A
from replyforge.operators.bestofn import accepted_attempts, best_of_n
from suite.base import query

LINE_ORDER = ["response_idx", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
_LINE_SQL = "response_idx, l_partkey, l_suppkey, l_extendedprice, l_shipdate"

_RANKED = "SELECT query_id, success, row_number() OVER (PARTITION BY query_id ORDER BY response_idx) AS rn FROM {attempts}"
_RATES = f"""
    SELECT k, count(*) AS total, count(*) FILTER (WHERE solved_at <= k) AS successful,
           count(*) FILTER (WHERE solved_at <= k) / count(*) * 100.0 AS pass_rate
    FROM (SELECT query_id, min(CASE WHEN success THEN rn END) AS solved_at FROM ({_RANKED}) GROUP BY query_id)
    CROSS JOIN (VALUES (1), (2), (4), (8), (16), (32)) AS ks(k) GROUP BY k"""
_GAINS = f"""
    SELECT a.k AS k0, b.k AS k, (b.pass_rate - a.pass_rate) / (b.k - a.k) AS gain
    FROM ({_RATES}) a JOIN ({_RATES}) b ON b.k = a.k * 2"""


def _attempts(t):
    return attempt_rows(t["attempts"].select("id", "success"))


@query(
    """SELECT event_id, CASE WHEN event_id % 10 = 4 OR event_id % 10 > 5 THEN split_part(id, '_', 1) END AS query_id,
              CASE WHEN event_id % 10 = 4 OR event_id % 10 > 5 THEN event_id END AS response_idx, success
       FROM {bad_ids} WHERE event_id % 10 = 4 OR event_id % 10 > 5"""
)
def parse_attempt_id(t):
    return attempt_rows(t["bad_ids"]).select("event_id", "query_id", "response_idx", "success")


@query("SELECT event_id % 10 AS kind, count(*) AS n FROM {bad_ids} WHERE event_id % 10 IN (0, 1, 2, 3, 5) GROUP BY 1")
def rejected_ids(t):
    return rejected_attempt_ids(t["bad_ids"]).groupBy((F.col("event_id") % 10).alias("kind")).agg(F.count("*").alias("n"))


@query(
    f"""SELECT query_id, response_idx, l_partkey, l_suppkey, success,
               row_number() OVER (PARTITION BY query_id ORDER BY {_LINE_SQL}) AS rank
        FROM {{line_attempts}}"""
)
def rank_attempts(t):
    return A.rank_attempts(t["line_attempts"], "query_id", LINE_ORDER).select(
        "query_id", "response_idx", "l_partkey", "l_suppkey", "success", "rank"
    )


@query("""
    SELECT query_id, response_idx, row_number() OVER (PARTITION BY query_id ORDER BY response_idx) AS rank FROM {attempts}""")
def rank_attempts_of_hot_queries(t):
    """Same figures through the range-cut path that large groups take."""
    ranked = A.rank_attempts(_attempts(t), "query_id", ["response_idx"], max_group=20)
    return ranked.select("query_id", "response_idx", "rank")


@query(f"SELECT k, total, successful, pass_rate FROM ({_RATES})")
def pass_at_k(t):
    return A.pass_at_k(_attempts(t), order=["response_idx"])


@query(
    f"""SELECT k, count(*) AS total, count(*) FILTER (WHERE solved_at <= k) AS successful,
               count(*) FILTER (WHERE solved_at <= k) / count(*) * 100.0 AS pass_rate
        FROM (SELECT query_id, min(CASE WHEN success THEN rn END) AS solved_at
              FROM (SELECT query_id, success, row_number() OVER (PARTITION BY query_id ORDER BY {_LINE_SQL}) AS rn FROM {{line_attempts}})
              GROUP BY query_id)
        CROSS JOIN (VALUES (1), (2), (4), (8), (16), (32)) AS ks(k) GROUP BY k"""
)
def pass_at_k_repeated_indexes(t):
    """Queries with fewer than k attempts and several attempts of one index."""
    return A.pass_at_k(t["line_attempts"], order=LINE_ORDER)


@query(f"SELECT cast(k0 AS string) || '→' || cast(k AS string) AS transition, k, round(gain, 9) AS gain FROM ({_GAINS})")
def pass_at_k_gain(t):
    gains = A.pass_at_k_gain(A.pass_at_k(_attempts(t), order=["response_idx"]))
    return gains.withColumn("gain", F.round("gain", 9))


@query(f"SELECT round(avg(gain), 9) AS average_improvement FROM ({_GAINS})")
def average_gain(t):
    gains = A.pass_at_k_gain(A.pass_at_k(_attempts(t), order=["response_idx"]))
    return A.average_gain(gains).select(F.round("average_improvement", 9).alias("average_improvement"))


@query(f"""
    SELECT 'result' AS section, cast(k AS string) AS name, total AS total_queries, successful AS successful_queries, cast(printf('%.2f', pass_rate) AS double) AS figure FROM ({_RATES})
    UNION ALL
    SELECT 'improvement', cast(k0 AS string) || '→' || cast(k AS string), NULL, NULL, cast(printf('%.2f', gain) AS double) FROM ({_GAINS})
    UNION ALL
    SELECT 'summary', 'average_improvement', (SELECT count(DISTINCT query_id) FROM {{attempts}}), NULL, cast(printf('%.2f', sum(gain) / 5) AS double) FROM ({_GAINS})""")
def pass_at_k_report(t):
    report = A.pass_at_k_report(_attempts(t), order=["response_idx"])
    none = F.lit(None).cast("bigint")
    rows = F.concat(
        F.transform(
            "results",
            lambda r: F.struct(
                F.lit("result").alias("section"),
                r["k"].cast("string").alias("name"),
                r["total_queries"].alias("total_queries"),
                r["successful_queries"].alias("successful_queries"),
                r["pass_rate"].alias("figure"),
            ),
        ),
        F.transform(
            "improvements",
            lambda r: F.struct(
                F.lit("improvement").alias("section"),
                r["transition"].alias("name"),
                none.alias("total_queries"),
                none.alias("successful_queries"),
                r["gain"].alias("figure"),
            ),
        ),
        F.array(
            F.struct(
                F.lit("summary").alias("section"),
                F.lit("average_improvement").alias("name"),
                F.col("summary.total_unique_queries").alias("total_queries"),
                none.alias("successful_queries"),
                F.col("summary.average_improvement").alias("figure"),
            )
        ),
    )
    return report.select(F.inline(rows))


_PER_QUERY = "SELECT query_id, count(*) AS responses, count(*) FILTER (WHERE success) AS successes FROM {attempts} GROUP BY query_id"


@query(f"SELECT responses, count(*) AS queries FROM ({_PER_QUERY}) GROUP BY responses")
def response_count_distribution(t):
    return A.response_count_distribution(_attempts(t))


@query(f"SELECT successes, count(*) AS queries FROM ({_PER_QUERY}) GROUP BY successes")
def success_count_distribution(t):
    return A.success_count_distribution(_attempts(t))


@query(
    f"""SELECT count(*) AS queries, count(*) FILTER (WHERE successes > 0) AS solved,
               count(*) FILTER (WHERE successes > 0) / count(*) * 100 AS success_rate FROM ({_PER_QUERY})"""
)
def overall_success(t):
    return A.overall_success(_attempts(t))


_STEPS = """
    SELECT *, coalesce(count(*) FILTER (WHERE NOT err) OVER w, 0) AS ok, coalesce(count(*) FILTER (WHERE err) OVER w, 0) AS bad
    FROM {bon_attempts}
    WINDOW w AS (PARTITION BY id ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@query(
    f"""SELECT id, least(count(*) FILTER (WHERE NOT err AND ok < 8 AND bad < 3), 8) AS accepted,
               count(*) FILTER (WHERE err AND ok < 8 AND bad < 3) AS round,
               CASE WHEN count(*) FILTER (WHERE NOT err AND ok < 8 AND bad < 3) >= 8 THEN 'completed'
                    WHEN count(*) FILTER (WHERE bad >= 3) > 0 THEN 'max_rounds' ELSE 'processing' END AS status
        FROM ({_STEPS}) GROUP BY id"""
)
def best_of_n_recorded(t):
    return best_of_n(t["bon_attempts"], 8, 3)


@query(
    f"""SELECT id, attempt, response FROM ({_STEPS}) WHERE NOT err AND ok < 8 AND bad < 3"""
)
def best_of_n_accepted(t):
    return accepted_attempts(t["bon_attempts"], 8, 3).select("id", "attempt", "response")


@query(
    f"""SELECT id, count(*) FILTER (WHERE NOT err AND ok < 16) AS accepted, count(*) FILTER (WHERE err AND ok < 16) AS round,
               CASE WHEN count(*) FILTER (WHERE NOT err AND ok < 16) >= 16 THEN 'completed' ELSE 'processing' END AS status
        FROM ({_STEPS}) GROUP BY id"""
)
def best_of_n_no_error_limit(t):
    return best_of_n(t["bon_attempts"], 16, -1)


@query(
    f"""SELECT id || '_' || cast(row_number() OVER (PARTITION BY id ORDER BY attempt) - 1 AS string) AS id, response
        FROM (SELECT cast(id AS string) AS id, attempt, response FROM ({_STEPS}) WHERE NOT err AND ok < 8 AND bad < 3)"""
)
def explode_attempts(t):
    collected = best_of_n(t["bon_attempts"], 8, 3, response="response")
    return A.explode_attempts(collected).select("id", "response")


@query(
    f"""SELECT count(*) AS records, cast(sum(n) AS bigint) AS elements, avg(n) AS average
        FROM (SELECT id, count(*) FILTER (WHERE NOT err AND ok < 8 AND bad < 3) AS n FROM ({_STEPS}) GROUP BY id) WHERE id % 3 <> 0"""
)
def avg_responses(t):
    collected = best_of_n(t["bon_attempts"], 8, 3, response="response")
    return A.avg_responses(collected.withColumn("response_n", F.when(F.col("id") % 3 != 0, F.col("response_n"))))


_OPEN = """
    SELECT v.id, v.round, v.l_partkey, v.l_suppkey, v.success FROM {verdicts} v
    LEFT JOIN (SELECT id, min(round) AS first_ok FROM {verdicts} WHERE success GROUP BY id) s ON v.id = s.id
    WHERE first_ok IS NULL OR v.round <= first_ok"""


@query(_OPEN)
def still_open(t):
    return A.still_open(t["verdicts"])


@query(
    f"""SELECT round, count(*) FILTER (WHERE success) AS success, count(*) FILTER (WHERE success IS NOT TRUE) AS failed,
               count(*) AS total, count(*) FILTER (WHERE success) / count(*) * 100 AS accuracy
        FROM ({_OPEN}) GROUP BY round"""
)
def round_summary(t):
    return A.round_summary(A.still_open(t["verdicts"]))
