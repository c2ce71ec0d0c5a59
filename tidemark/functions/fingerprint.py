"""Order-independent identity of rows and of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def record_id(source_table: str | Column, columns: list[str]) -> Column:
    """sha256 of the table name and every source column, sorted by name.

    Nulls are written out: without that (1, null) and (null, 1) would collide.
    """
    table = F.lit(source_table) if isinstance(source_table, str) else source_table
    packed = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.sha2(F.concat(table, F.lit("|"), packed), 256)


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """64-bit hash of a row's typed values and of which of them are null.

    A hash skips nulls, so the map of nulls is what tells (1, null) from (null, 1). Only columns
    that contain arrays, maps or structs, where nulls can hide inside, are hashed as text.
    """
    plain = {f.name for f in df.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType))}
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns]) if columns else F.lit("")
    values = [
        F.col(f"`{c}`") if c in plain
        else F.to_json(F.struct(F.col(f"`{c}`").alias("v")), {"ignoreNullFields": "false"})
        for c in columns
    ]
    return F.xxhash64(nulls, *values)


def identity(h: str = "h") -> list[Column]:
    """Aggregates (row_count, hash_sum, hash_xor) of a column of row hashes."""
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.col(h).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
        .cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor(h), F.lit(0)).cast("string").alias("hash_xor"),
    ]


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row (row_count, hash_sum, hash_xor): equal for equal multisets of rows.

    The three aggregates combine map-side, so only one small row per task is shuffled.
    """
    hashed = df.select(row_hash(df, sorted(columns or df.columns)).alias("h"))
    return hashed.agg(*identity())
