"""Equi-joins to a one-row-per-key table, whatever its size and the spread of the keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A table is broadcast only after its measured size is found below this.
BROADCAST_BYTES = 64 << 20


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def salt_counts(dim: DataFrame, key: str, weight: str, partitions: int) -> DataFrame:
    """``(__key_hash, __salts)`` for the keys too frequent for one shuffle partition.

    A key is hot when it holds more than ``1/partitions`` of the total weight,
    so there are fewer than ``partitions`` rows of two numbers each, whatever
    the data: small enough to broadcast. Hot keys get as many salts as the
    partitions their rows would fill.
    """
    total = dim.agg(F.sum(weight)).scalar()
    return (
        dim.select(
            F.xxhash64(key).alias("__key_hash"),
            F.ceil(F.col(weight) * F.lit(float(partitions)) / total).cast("int").alias("__salts"),
        )
        .where("__salts > 1")
        .groupBy("__key_hash")
        .agg(F.max("__salts").alias("__salts"))
    )


def salted_join(
    rows: DataFrame, dim: DataFrame, key: str, weight: str, spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """Join ``rows`` to ``dim`` on ``key``, splitting the rows of hot keys.

    ``dim`` has one row per key, and ``weight`` in it tells how many rows the
    key has (or ranks them alike). Rows of a hot key are dealt over its salts
    by a hash of ``spread_by``, and the key's ``dim`` row is repeated once per
    salt. Two keys sharing a hash are merely salted alike, so the result is
    that of the plain join. ``weight`` is kept in the result. Columns that come
    and go here begin with two underscores, apart from those of ``rows``.
    """
    hot = F.broadcast(salt_counts(dim, key, weight, shuffle_partitions(rows)))
    n = F.coalesce("__salts", F.lit(1))
    salted_rows = (
        rows.withColumn("__key_hash", F.xxhash64(key))
        .join(hot, "__key_hash", "left")
        .withColumn("__salt", F.pmod(F.xxhash64(*spread_by), n).cast("int"))
        .drop("__key_hash", "__salts")
    )
    salted_dim = (
        dim.withColumn("__key_hash", F.xxhash64(key))
        .join(hot, "__key_hash", "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), n - 1)))
        .drop("__key_hash", "__salts")
    )
    return salted_rows.join(salted_dim, [key, "__salt"], how).drop("__salt")


def text_bytes(column: str) -> Column:
    """Aggregate that measures a table for ``sized_join``: its text, and 32 bytes a row."""
    return F.coalesce(F.sum(F.octet_length(F.col(column).cast("string")) + 32), F.lit(0))


def sized_join(
    rows: DataFrame, dim: DataFrame, dim_bytes: int, key: str, weight: str, spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """Broadcast ``dim`` where its measured size allows, else ``salted_join``."""
    if dim_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(dim), key, how)
    return salted_join(rows, dim, key, weight, spread_by, how)
