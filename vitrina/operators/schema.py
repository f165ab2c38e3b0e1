"""Schema operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parse_ddl(ddl: str) -> StructType:
    """Parse a DDL column list (``a BIGINT NOT NULL, b STRING``) to a schema."""
    return StructType.fromDDL(" ".join(ddl.split()))


def enforce_schema(df: DataFrame, ddl: str | StructType, check_not_null: bool = True) -> DataFrame:
    """Project ``df`` onto a declared target schema.

    Columns are selected in target order and converted with ``try_cast``
    (a bad value becomes NULL instead of aborting the job); missing
    nullable columns become typed NULLs; extra columns are dropped. A NULL
    in a NOT NULL column raises; the check is a filter, so it runs whatever
    columns are read afterwards.
    """
    schema = parse_ddl(ddl) if isinstance(ddl, str) else ddl
    have = set(df.columns)
    cols, whole = [], F.lit(True)
    for field in schema.fields:
        if field.name in have:
            c = F.col(field.name).try_cast(field.dataType)
        elif field.nullable:
            c = F.lit(None).cast(field.dataType)
        else:
            raise ValueError(f"NOT NULL column {field.name!r} is missing from the input")
        if check_not_null and not field.nullable:
            msg = f"NULL in NOT NULL column {field.name}"
            whole = F.when(c.isNotNull(), whole).otherwise(F.raise_error(F.lit(msg)).cast("boolean"))
        cols.append(c.alias(field.name))
    checked = df.filter(whole) if check_not_null and any(not f.nullable for f in schema.fields) else df
    return checked.select(*cols)


def align_to_target(df: DataFrame, target: list[str] | str) -> DataFrame:
    """Add missing columns as NULL, keep target order, drop extras,
    and cast every column to STRING. ``target`` is a column list or the name
    of a table."""
    target_columns = df.sparkSession.read.table(target).columns if isinstance(target, str) else target
    have = set(df.columns)
    return df.select(*[
        (F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c)
        for c in target_columns
    ])
