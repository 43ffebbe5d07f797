"""A table of queries: each has a name, a function of the session and the data folder, and SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from loamline.plans import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: The columns that the log lines are made of, for DuckDB; `good` rows are those whose line is well-formed.
LOG_T = fixtures.in_sql(fixtures.LOG).split("select i, src,\n")[0].strip()
GOOD = LOG_T + "\n{} where i % 97 <> 0"


def query(name: str, sql: str | None = None):
    """Registers a function; sql is what DuckDB is given."""

    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def columns(name: str, source: str, out: Callable[[], dict[str, Column]], expected: str, tables: tuple[str, ...], keep: tuple[str, ...] = ("i",)) -> None:
    """A query of expressions over rows that `source`, SQL for both engines, gives, made when it runs, as Columns need a session; expected: what DuckDB selects from the same rows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.sql(source, **{t: fixtures.table(spark, sf_dir, t) for t in tables})
        return rows.select(*keep, *[c.alias(n) for n, c in out().items()])

    QUERIES[name] = run
    SQL[name] = f"with s as ({source.format(**{t: t for t in tables})}) select {', '.join(keep)}, {expected} from s"
