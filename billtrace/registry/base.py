"""Named queries over the driver tables, each with an equivalent SQL text where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path, tune
from .roles import ROLE_SQL, spark_role


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[["Tables"], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(tune(spark), sf_dir))


REGISTRY: dict[str, Query] = {}


class Tables:
    """The driver tables, and the roles they play for the operators."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def role(self, name: str) -> DataFrame:
        return spark_role(self, name)

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(text, **frames)

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    @cached_property
    def documents(self) -> DataFrame:
        return self("documents")


def query(name: str, sql: str | None = None, roles: str = ""):
    """Register a query. ``roles`` names the role views that the SQL text needs."""

    def add(build):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(name, build, None if sql is None else with_roles(roles.split(), sql))
        return build

    return add


def with_roles(roles: list[str], body: str) -> str:
    if not roles:
        return body
    views = ",\n".join(f"{r} AS (\n{ROLE_SQL[r]}\n)" for r in roles)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def pct(part: str, whole: str, digits: int = 1) -> str:
    """SQL twin of ``operators.coverage.percent``."""
    return (
        f"round_even(coalesce(CAST({part} AS DOUBLE) * 100.0 / nullif(CAST({whole} AS DOUBLE), 0), 0), {digits})"
    )
