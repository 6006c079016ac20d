"""Registry of queries: a Spark plan and, where SQL can express it, the SQL that must agree."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lectern.plans.bindings import SQL_INPUTS, Inputs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SURVEY_IDS: dict[str, str] = {}


def expand(sql: str) -> str:
    """Prefix ``sql`` with the input definitions it names, each after those it uses itself."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bb_\w+", text):
            if name in SQL_INPUTS and name not in ordered:
                visit(SQL_INPUTS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    body = sql.strip()
    if not ordered:
        return body
    inputs = ",\n".join(f"{name} AS ({SQL_INPUTS[name].strip()})" for name in ordered)
    if body[:5].upper() == "WITH ":
        return f"WITH {inputs},\n{body[5:]}"
    return f"WITH {inputs}\n{body}"


def comparable(df: DataFrame) -> DataFrame:
    """Dates as text and bigint counts, the forms both engines hand back alike."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(field.dataType, T.FloatType):
            col = col.cast("double")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(name: str, survey: str, sql: str | None = None):
    """Register a plan that takes the :class:`Inputs` of a data folder."""

    def register(plan: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(plan(Inputs(spark, sf_dir)))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        SURVEY_IDS[name] = survey
        if sql is not None:
            ORACLES[name] = expand(sql)
        return plan

    return register
