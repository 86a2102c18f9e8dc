"""Field mapping, field types and the one-field join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratagrid.scratch import lookup

SUPPORTED_TYPES = (T.LongType, T.IntegerType, T.ShortType, T.DoubleType, T.FloatType,
                   T.StringType, T.DateType, T.TimestampType)


def map_fields(df: DataFrame, spec: str) -> DataFrame:
    """Keep, rename and order fields by a ``"FROM TO;FROM TO"`` list; an unknown field raises."""
    picked = []
    for entry in spec.split(";"):
        source, target = entry.split()
        if source not in df.columns:
            raise ValueError(f"cannot map field {source!r}: not in {df.columns}")
        picked.append(F.col(source).alias(target))
    return df.select(*picked)


def field_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a field, found without regard to case; an unsupported type raises."""
    for field in df.schema.fields:
        if field.name.upper() == name.upper():
            if not isinstance(field.dataType, SUPPORTED_TYPES):
                raise ValueError(f"{field.name}: type {field.dataType.simpleString()} not supported")
            return field.dataType
    raise ValueError(f"field {name!r} not found")


def join_one_field(df: DataFrame, key: str, source: DataFrame, source_key: str, field: str,
                   name: str | None = None, as_type: T.DataType | None = None,
                   salt_by: str | None = None) -> DataFrame:
    """Copy ``field`` from ``source`` to rows with the same key; others keep their old value.

    Adds ``matched``.  ``source_key`` must be unique in ``source``: a repeated key fails the query.
    """
    name = name or field
    kind = as_type or field_type(source, field)
    unique = source.groupBy(F.col(source_key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), F.first(field).alias("_value")
    ).select(
        "_key",
        F.when(F.col("_n") > 1, F.raise_error(F.concat(
            F.lit(f"key {source_key} is not unique: "), F.col("_key").cast("string")
        )).cast(kind)).otherwise(F.col("_value").cast(kind)).alias("_value"),
        F.lit(True).alias("_hit"),
    )
    old = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
    joined = lookup(
        df.withColumn("_key", F.col(key)), unique, "_key", salt_by or key, "left"
    )
    return joined.withColumn(
        name, F.when(F.col("_hit"), F.col("_value")).otherwise(old)
    ).withColumn("matched", F.coalesce("_hit", F.lit(False))).drop("_key", "_value", "_hit")


def match_counts(joined: DataFrame) -> DataFrame:
    """Number of matched and unmatched rows of a one-field join."""
    return joined.agg(
        F.count_if("matched").alias("matches"), F.count_if(~F.col("matched")).alias("no_matches")
    )
