"""Registry of the queries and of the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from exposura import rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under the operator's name, with its SQL where SQL can say it."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, folder.rstrip("/"))

        run.__doc__ = fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


def sql_in(items) -> str:
    return "(" + ", ".join(q(i) for i in items) + ")"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def like_any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w.lower())})" for w in words) + ")"


def case_first(tests, default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {t} THEN {v}" for t, v in tests) + f" ELSE {default} END"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def sql_redacted(x: str) -> str:
    for kind, pattern in rules.SENSITIVE:
        x = f"regexp_replace({x}, {q(pattern)}, '[{kind}]', 'g')"
    return x
