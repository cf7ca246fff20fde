"""Runs operators over a data directory, and writes the same plans for the other engine."""

from __future__ import annotations

import importlib
import pkgutil
import re
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from . import operators as _operators
from .plans.dialect import DUCKDB, OPERATORS, SPARK
from .plans.shape import SHAPES

NATIVE: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
NATIVE_SQL: dict[str, str] = {}


def _load() -> None:
    for package in (_operators,):
        for m in pkgutil.iter_modules(package.__path__):
            found = importlib.import_module(f"{package.__name__}.{m.name}")
            NATIVE.update(getattr(found, "QUERIES", {}))
            NATIVE_SQL.update(getattr(found, "ORACLE", {}))
    for name in ("fernwell.streaming.events", "fernwell.functions.text_columns", "fernwell.functions.markup", "fernwell.sources.registry"):
        m = importlib.import_module(name)
        NATIVE.update(getattr(m, "QUERIES", {}))
        NATIVE_SQL.update(getattr(m, "ORACLE", {}))


_load()


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, or a shaped relation over tables."""
    if name in SHAPES:
        needs, select = SHAPES[name]
        return bind(spark, select, {n: relation(spark, sf_dir, n) for n in needs})
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(spark: SparkSession, select: str, frames: dict[str, DataFrame]) -> DataFrame:
    """Runs a SELECT in which the names of frames stand for these frames. They are common table
    expressions over views of this call, so that sessions and directories do not meet."""
    if not frames:
        return spark.sql(select)
    marked = ", ".join(f"{n} AS (SELECT * FROM {{{n}}})" for n in frames)
    body = select.strip().replace("{", "{{").replace("}", "}}")
    if body[:15].upper() == "WITH RECURSIVE ":
        return spark.sql(f"WITH RECURSIVE {marked}, {body[15:]}", **frames)
    if body[:5].upper() == "WITH ":
        return spark.sql(f"WITH {marked}, {body[5:]}", **frames)
    return spark.sql(f"WITH {marked} {body}", **frames)


def run(spark: SparkSession, sf_dir: str, key: str, **params) -> DataFrame:  # noqa: ANN003
    return run_on(spark, key, {n: relation(spark, sf_dir, n) for n in OPERATORS[key].relations}, **params)


def run_on(spark: SparkSession, key: str, frames: dict[str, DataFrame], **params) -> DataFrame:  # noqa: ANN003
    """An operator on relations of the caller (protocols, reagents, ...)."""
    op = OPERATORS[key]
    frames = dict(frames)
    for name, plan in op.steps.items():
        frames[name] = bind(spark, plan(SPARK, **(op.params | params)), frames).persist(StorageLevel.MEMORY_AND_DISK)
    if op.steps:  # a kept result reads its relations by itself
        used = op.sql(SPARK, **params)
        frames = {n: f for n, f in frames.items() if re.search(rf"\b{n}\b", used)}
    return bind(spark, op.sql(SPARK, **params), frames)


def oracle(key: str) -> str:
    op = OPERATORS[key]
    shaped = [f"{n} AS ({SHAPES[n][1].strip()})" for n in op.relations if n in SHAPES]
    shaped += [f"{n} AS ({plan(DUCKDB, **op.params).strip()})" for n, plan in op.steps.items()]
    body = op.sql(DUCKDB).strip()
    if body[:5].upper() == "WITH ":
        recursive = body[5:].lstrip().upper().startswith("RECURSIVE")
        rest = body[5:].lstrip()[9:] if recursive else body[5:]
        return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join([*shaped, rest])}"
    return f"WITH {', '.join(shaped)} {body}" if shaped else body


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: (lambda spark, sf_dir, k=k: run(spark, sf_dir, k)) for k in OPERATORS}
    return dict(sorted((found | NATIVE).items()))


def oracle_sql() -> dict[str, str]:
    found = {k: oracle(k) for k, op in OPERATORS.items() if op.oracle}
    return dict(sorted((found | NATIVE_SQL).items()))
