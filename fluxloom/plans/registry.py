"""Query registry: each entry pairs a Spark query with its SQL equivalent.

A result is declared by a spec such as ``"sensor:s ts:t v:6 n:i day:d"``:
``s`` text, ``t`` timestamp, ``i`` integer, ``b`` boolean, ``d`` date shown as
text, a digit a number rounded to that many decimals. The same spec shapes
both sides. Before rounding both sides add 3 % of the last digit: values lying
exactly half-way would otherwise be decided by the order of summation.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxloom.plans.inputs import CTES, Tables
from fluxloom.session import shared_dir


@dataclass(frozen=True)
class Query:
    name: str
    spec: str
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return shape(self.run(Tables(spark, sf_dir)), self.spec)


QUERIES: dict[str, Query] = {}


def _fields(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.rsplit(":", 1)) for part in spec.split()]


def shape(df: DataFrame, spec: str) -> DataFrame:
    out = []
    for name, kind in _fields(spec):
        c = F.col(f"`{name}`")
        if kind in ("s", "d"):
            c = c.cast("string")
        elif kind == "i":
            c = c.cast("bigint")
        elif kind == "b":
            c = c.cast("boolean")
        elif kind != "t":
            c = F.round(c.cast("double") + F.lit(0.031 * 10.0 ** -int(kind)), int(kind)) + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


def shape_sql(inner: str, spec: str) -> str:
    out = []
    for name, kind in _fields(spec):
        c = f'"{name}"'
        if kind == "s":
            c = f"CAST({c} AS VARCHAR)"
        elif kind == "d":
            c = f"CAST(CAST({c} AS DATE) AS VARCHAR)"
        elif kind == "i":
            c = f"CAST({c} AS BIGINT)"
        elif kind == "b":
            c = f"CAST({c} AS BOOLEAN)"
        elif kind == "t":
            c = f"CAST({c} AS TIMESTAMP)"
        else:
            c = f"round(CAST({c} AS DOUBLE) + CAST({0.031 * 10.0 ** -int(kind)!r} AS DOUBLE), {kind}) + 0e0"
        out.append(f'{c} AS "{name}"')
    return f"SELECT {', '.join(out)} FROM ({inner}) AS shaped"


def with_ctes(sql: str, names: tuple[str, ...]) -> str:
    """Prefix the common table expressions a query names, with those they need."""
    wanted: list[str] = []

    def add(name: str) -> None:
        needs, _ = CTES[name]
        for n in needs:
            add(n)
        if name not in wanted:
            wanted.append(name)

    for n in names:
        add(n)
    if not wanted:
        return sql
    return "WITH " + ", ".join(f"{n} AS ({CTES[n][1]})" for n in wanted) + " " + sql


def query(name: str, spec: str, sql: str | None, uses: str = ""):
    """Register a query; ``uses`` names the common table expressions of its SQL."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        text = None if sql is None else with_ctes(shape_sql(sql, spec), tuple(uses.split()))
        QUERIES[name] = Query(name, spec, fn, text)
        return fn

    return register


def scratch(t: Tables, label: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(t.spark)}/fluxloom/{label}-{uuid.uuid4().hex[:12]}"
