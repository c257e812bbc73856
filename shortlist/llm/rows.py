"""Carrying a table's other columns through an operator, whatever their names are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = "_rest"


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def pack(df: DataFrame, *used: str) -> DataFrame:
    """The columns ``used`` and one struct of all others, so that no name can clash."""
    others = [column(c) for c in df.columns if c not in used]
    return df.select(*used, (F.struct(*others) if others else F.lit(0)).alias(REST))


def unpack(df: DataFrame, columns: Sequence[str], used: Sequence[str], added: Sequence[str] = ()) -> DataFrame:
    """The original ``columns`` in their order, then ``added``; an added column replaces one of its name."""
    kept = [c for c in columns if c not in added]
    return df.select(*[F.col(c) if c in used else F.col(REST).getField(c).alias(c) for c in kept], *added)
