"""Registry of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.views import VIEWS, Tables

PLACES = 6
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, views: str = "", rounded: str = ""):
    """Register a function of ``Tables`` under its name, with its SQL if any.

    ``views`` names the shared views the SQL reads, in dependency order.  Columns
    that are ``rounded`` are means, whose last bits depend on the order of addition;
    both sides give them to six places.
    """

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        means = rounded.split()

        def run(spark, sf_dir):
            found = build(Tables(spark, sf_dir))
            return found.withColumns({c: F.round(c, PLACES) for c in means}) if means else found

        QUERIES[name] = run
        if sql is not None:
            text = with_views(sql, views.split())
            shown = ", ".join(f"round({c}, {PLACES}) as {c}" for c in means)
            ORACLE[name] = f"select * replace ({shown}) from ({text}) found" if means else text
        return build

    return register


def with_views(sql: str, names: list[str]) -> str:
    parts = [f"{name} as ({VIEWS[name].strip()})" for name in names]
    body = sql.strip()
    if body.startswith("with "):
        parts.append(body[len("with "):])
        return "with " + ",\n".join(parts)
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body
