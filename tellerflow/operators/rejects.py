"""Cells that reading or cleaning turned into NULL, with the text they had."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerflow.functions import parse_date, parse_money
from tellerflow.schemas import as_struct

#: Added by ``sources.read_csv_traced``: the file of a row, and its line if a cell did not fit.
FILE, LINE = "_file", "_line"


def cleaning_rules(entity: str) -> dict[str, tuple[Column, str]]:
    """The rules of an entity that can give NULL for a text: by column, the cleaned cell and the
    rule's name. The other rules map every text to some text."""
    date, money = "day/month/year", "amount of money"
    return {
        "accounts": {
            "Balance": (parse_money(F.col("Balance")), money),
            "Open_Date": (parse_date(F.col("Open_Date")), date),
            "Last_Activity_Date": (parse_date(F.col("Last_Activity_Date")), date),
        },
        "customers": {},
        "transactions": {
            "Amount": (parse_money(F.col("Amount")), money),
            "Transaction_Date": (parse_date(F.col("Transaction_Date")), date),
        },
    }[entity]


def _cell(column: str, raw: Column, rule: str, lost: Column) -> Column:
    name = F.lit(column).alias("column_name")
    return F.when(lost, F.struct(name, raw.alias("raw_text"), F.lit(rule).alias("rule")))


def rejected_by_rules(
    df: DataFrame, rules: Mapping[str, tuple[Column, str]], row: Column
) -> DataFrame:
    """``row, column_name, raw_text, rule`` for each text that a rule turns into NULL."""
    cells = [_cell(c, F.col(c), name, F.col(c).isNotNull() & made.isNull())
             for c, (made, name) in rules.items()]
    return df.select(row.alias("row"), F.inline(F.array_compact(F.array(*cells))))


def rejected_cells(
    traced: DataFrame, schema: str | T.StructType, rules: Mapping[str, tuple[Column, str]]
) -> DataFrame:
    """``file, row, column_name, raw_text, rule`` for each cell of a traced read that is NULL in the
    clean table though it had a text; ``row`` is the line, or the cells as CSV if all did fit.

    Cells that do not fit the declared type are found in the line the reader kept; the rule is then
    "type", with the type's name. Empty cells have no text and are not reported, nor are cells
    beyond the declared columns, which no table has. One pass, row by row.
    """
    fields = as_struct(schema)
    texts = ", ".join(f"`{f.name}` STRING" for f in fields)
    parsed = F.from_csv(F.col(LINE), texts)
    cells = []
    for f in fields:
        raw = F.col(f"_parsed.{f.name}")
        if not isinstance(f.dataType, T.StringType):
            lost = F.col(f.name).isNull() & raw.isNotNull()
            cells.append(_cell(f.name, raw, f"type {f.dataType.simpleString()}", lost))
        if f.name in rules:
            made, name = rules[f.name]
            cells.append(_cell(f.name, F.col(f.name), name, F.col(f.name).isNotNull() & made.isNull()))
    row = F.coalesce(F.col(LINE), F.to_csv(F.struct(*fields.names)))
    return traced.withColumn("_parsed", parsed).select(
        F.col(FILE).alias("file"), row.alias("row"), F.inline(F.array_compact(F.array(*cells)))
    )
