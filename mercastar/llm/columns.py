"""Column helpers shared by the operators of this package."""

from __future__ import annotations

import importlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "_mx_row"


def quoted(name: str) -> str:
    """A column name as an expression, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, **derived: Column) -> DataFrame:
    """All columns of `df` as one struct `_mx_row`, beside `derived` columns.

    Operators work on the derived columns, so no column of the input can clash
    with their own names.
    """
    row = F.struct(*[F.col(quoted(c)) for c in df.columns]).alias(ROW)
    return df.select(row, *[value.alias(name) for name, value in derived.items()])


def unpacked(df: DataFrame, columns: list[str], **results: Column) -> DataFrame:
    """The input columns again, then `results`, which replace input columns they name."""
    kept = [F.col(ROW)[c].alias(c) for c in columns if c not in results]
    return df.select(*kept, *[value.alias(name) for name, value in results.items()])


def utf8_size(text: Column) -> Column:
    """Bytes of the text; NULL has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    return importlib.import_module("public_tokenizers").path(name)
