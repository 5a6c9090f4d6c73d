"""Queries over the given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from querybook.tables import Tables, duck
from swathmatch.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# how a column leaves a query, in both engines: i whole number, d number with six
# decimals (halves always up: the engines differ there), s text, b boolean, t time
# as microseconds
_SPARK = {"i": "CAST({c} AS BIGINT)", "d": "round(CAST({c} AS DOUBLE) + 1e-10, 6) + 0e0", "s": "CAST({c} AS STRING)",
          "b": "CAST({c} AS BOOLEAN)", "t": "unix_micros(CAST({c} AS TIMESTAMP))"}
_DUCK = {"i": "CAST({c} AS BIGINT)", "d": "round(CAST({c} AS DOUBLE) + 1e-10, 6) + 0e0", "s": "CAST({c} AS VARCHAR)",
         "b": "CAST({c} AS BOOLEAN)", "t": "epoch_us({c})"}


def query(name: str, cols: str, sql: str | None = None, using: str = ""):
    """Register a query: its output columns (``name:type ...``) and its SQL.

    *using* names the derived tables the SQL reads.
    """
    spec = [c.split(":") for c in cols.split()]

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Tables(tune(spark), sf_dir))
            return df.selectExpr(*[f"{_SPARK[t].format(c=c)} AS {c}" for c, t in spec])

        QUERIES[name] = run
        if sql is not None:
            out = ", ".join(f"{_DUCK[t].format(c=c)} AS {c}" for c, t in spec)
            SQL[name] = duck(sql, using.split(), out)
        return fn

    return wrap
