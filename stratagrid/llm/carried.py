"""The caller's columns as one struct, so that no name of theirs meets one of an operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def carry(docs: DataFrame, **named: Column) -> DataFrame:
    """``own``, all columns of ``docs``, and the ``named`` expressions over them."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    return docs.select(own, *[column.alias(name) for name, column in named.items()])


def given_back(rows: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    """The caller's columns again, but those to leave out."""
    return [F.col(f"own.`{f.name}`").alias(f.name) for f in rows.schema["own"].dataType if f.name not in without]
