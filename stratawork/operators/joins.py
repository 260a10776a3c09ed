"""Join helpers with checked broadcasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as Spark would hold them: fixed slots plus variable-length bytes.

    One distributed aggregate; a single number reaches the driver.
    """
    widths = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(F.struct(column))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        widths.append(F.coalesce(F.octet_length(column), F.lit(0)))
    fixed = F.lit(16 + 8 * len(df.columns))
    total = F.sum(reduce(lambda a, b: a + b, widths, fixed).cast("long"))
    return df.agg(F.coalesce(total, F.lit(0).cast("long"))).first()[0]


def broadcast_when_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring that the rows fit the limit.

    A larger side is returned without a hint, and Spark shuffles both sides (with adaptive
    skew splitting) instead.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    how: str = "left",
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Join facts to a dimension under differently named keys; the dimension's key is dropped.

    With few distinct keys a shuffle of the facts would end in few huge tasks; a dimension
    that measures small is therefore broadcast.
    """
    side = broadcast_when_small(dimension, max_broadcast_bytes)
    return facts.join(side, facts[fact_key] == side[dimension_key], how).drop(side[dimension_key])


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", broadcast: bool = False
) -> DataFrame:
    """Equi-join in which NULL keys match; the keys appear once.

    ``broadcast`` is for a right side whose size the caller has bounded.
    """
    names = [f"__right_{c}" if c in keys else c for c in right.columns]
    side = right.toDF(*names)
    same = [left[f"`{k}`"].eqNullSafe(side[f"`__right_{k}`"]) for k in keys]
    match = reduce(lambda a, b: a & b, same)
    joined = left.join(F.broadcast(side) if broadcast else side, match, how)
    return joined.drop(*[f"__right_{k}" for k in keys])


def having_key_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``other``; a semi join, so no row is multiplied.

    The keys are made distinct first, which folds repeated keys on the map side.
    """
    return df.join(other.select(key).distinct(), key, "left_semi")
