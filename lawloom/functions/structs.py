"""Flattening of nested objects, decided from the schema alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, parent: Column | None, prefix: str, sep: str) -> list[Column]:
    out: list[Column] = []
    for field in schema.fields:
        here = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, here, f"{name}{sep}", sep)
        else:
            out.append(here.alias(name))
    return out


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Turn every nested object into columns named by its path; arrays stay as they are."""
    return df.select(*_leaves(df.schema, None, "", sep))
