"""JDBC input. Address, driver and credentials come from the caller."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerflow.schemas import require_schema


@dataclass(frozen=True)
class Split:
    """How to read a table in ``parts`` ranges of a number or date column.

    The bounds only place the cuts; rows outside them and NULLs are read too. Choose a column
    whose values are spread evenly, such as a generated id; for others there is
    ``even_predicates``.
    """

    column: str
    lower: str | int
    upper: str | int
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def _literal(value: object) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    return str(value)


def _cuts(known: DataFrame, column: str, parts: int) -> list:
    """The values at the ends of ``parts`` equal shares, from a sketch; a value that fills several
    shares occurs as often."""
    shares = F.array(*(F.lit(i / parts) for i in range(1, parts)))
    sketch = F.percentile_approx(column, shares, F.lit(max(10_000, 100 * parts)))
    return known.agg(sketch.alias("cuts")).first()["cuts"] or [] if parts > 1 else []


def _between(name: str, low: str | None, high: str | None, nulls: bool) -> str:
    tests = [t for t in (low and f"{name} {low}", high and f"{name} {high}") if t]
    test = " AND ".join(tests) or f"{name} IS NOT NULL"
    return f"({test}) OR {name} IS NULL" if nulls else test


def even_predicates(
    known: DataFrame, column: str, parts: int, then_by: str | None = None
) -> list[str]:
    """Conditions that divide a table into about ``parts`` equal shares, however uneven its key,
    a number, date or time.

    ``known`` has the key as the table does: a copy from an earlier load, or a sample. Cuts are
    quantiles of it. A value that fills more than a share gets a condition of its own, divided
    further by ``then_by`` if that is given. Each row meets exactly one condition, also rows that
    ``known`` lacks; NULLs meet the first. The conditions are at most some more than ``parts``.
    """
    cuts = Counter(_cuts(known, column, parts))
    out: list[str] = []
    low = None
    for value in sorted(cuts):
        text = _literal(value)
        out.append(_between(column, low, f"< {text}", not out))
        low = f">= {text}"
        if cuts[value] > 1:  # at least a whole share
            own = f"{column} = {text}"
            again = known.filter(F.col(column) == F.lit(value))
            inner = even_predicates(again, then_by, cuts[value]) if then_by else ["1 = 1"]
            out += [own if i == "1 = 1" else f"{own} AND ({i})" for i in inner]
            low = f"> {text}"
    if not out:
        return ["1 = 1"]
    return [*out, _between(column, low, None, False)]


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    split: Split | None = None,
    schema: str | T.StructType | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Scan one table; without ``split`` or ``predicates`` through one connection.

    ``predicates``, such as those of ``even_predicates``, are one connection each; together they
    must hold for every row once. ``schema`` is a contract: the job fails if the table's columns
    or types differ from it.
    """
    if predicates is not None:
        if split is not None:
            raise ValueError("give split or predicates")
        rest = {k: v for k, v in connection.items() if k != "url"}
        df = spark.read.jdbc(connection["url"], table, predicates=list(predicates), properties=rest)
        return require_schema(df, schema) if schema is not None else df
    options = {**connection, "dbtable": table, **(split.options() if split else {})}
    df = spark.read.format("jdbc").options(**options).load()
    return require_schema(df, schema) if schema is not None else df
