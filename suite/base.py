"""Registry of queries and the input tables they share.

An input is a SQL text over the given tables and other inputs, written so that Spark and DuckDB read it alike;
where they cannot, it is a pair (Spark text, DuckDB text). Spark gets it as a DataFrame, DuckDB as a
common table expression in front of the oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from suite.inputs import INPUTS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _text(name: str, engine: int) -> str:
    value = INPUTS[name]
    return value if isinstance(value, str) else value[engine]


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(f for _, f, _, _ in Formatter().parse(sql) if f))


class Inputs:
    """``inputs["name"]`` is a given table or a derived input as a DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.written: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.sf_dir}/{table}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(self.path(name))
        if name in self.written:
            return self.written[name]
        sql = _text(name, 0)
        return self.spark.sql(sql, **{n: self[n] for n in _names(sql)})


def _needed(sql: str, found: dict[str, str]) -> None:
    for name in _names(sql):
        if name in INPUTS and name not in found:
            text = _text(name, 1)
            _needed(text, found)
            found[name] = text


def duckdb_sql(body: str) -> str:
    """The oracle with the inputs it names in front."""
    needed: dict[str, str] = {}
    _needed(body, needed)
    plain = {n: n for n in [*TABLES, *INPUTS]}
    ctes = ", ".join(f"{name} AS ({text.format(**plain)})" for name, text in needed.items())
    main = body.format(**plain).strip()
    if not ctes:
        return main
    if main[:5].upper() == "WITH ":
        return f"WITH {ctes}, {main[5:]}"
    return f"WITH {ctes} {main}"


def query(oracle: str | None = None):
    """Register a function ``inputs -> DataFrame`` under its own name."""

    def register(fn: Callable[[Inputs], DataFrame]):
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if oracle:
            ORACLES[name] = duckdb_sql(oracle)
        return fn

    return register
