"""Left and inner joins to a small-per-key side that survive a hot key on the big side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks over which the rows of one hot key are spread; a power of two.
SALTS = 16


def splittable_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Join ``right``, an aggregate with one row per key, to ``left``, with possibly a hot key.

    ``right`` is dealt out anew, so that both sides reach the join straight from a shuffle on the key;
    adaptive execution then splits a hot key of ``left``, and no row is replicated for a cold one.
    """
    payload = [c for c in right.columns if c not in on]
    parts = int(right.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = right.select(*[F.col(k).alias(f"_key_{k}") for k in on], *payload).repartition(parts)
    condition = F.lit(True)
    for key in on:
        mine, theirs = F.col(key), F.col(f"_key_{key}")
        condition &= mine.eqNullSafe(theirs) if key in null_safe else mine == theirs
    return left.join(dealt, condition, how).select(*left.columns, *payload)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    null_safe: Sequence[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Join ``right`` (few rows per key) to ``left`` (possibly a third of its rows on one key).

    The rows of a key are spread over ``salts`` tasks by a hash of ``spread_by``, and ``right`` is
    replicated once per salt. The hash depends on the row alone, so a task re-run after a lost
    executor puts every row where it was. No side is broadcast by hint: Spark does so by itself
    where the replicated side is measured to be small. Both sides reach the join straight from a
    shuffle, so adaptive execution can split what is left of a hot key. Columns in ``null_safe``
    match NULL to NULL.
    """
    if salts & (salts - 1):
        raise ValueError("salts must be a power of two")
    payload = [c for c in right.columns if c not in on]
    salted_left = left.withColumn("_salt", F.xxhash64(*spread_by).bitwiseAND(salts - 1))
    salted_right = right.select(
        *[F.col(k).alias(f"_key_{k}") for k in on],
        *payload,
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1))).alias("_right_salt"),
    )
    condition = F.col("_salt") == F.col("_right_salt")
    for key in on:
        mine, theirs = F.col(key), F.col(f"_key_{key}")
        condition &= mine.eqNullSafe(theirs) if key in null_safe else mine == theirs
    joined = salted_left.join(salted_right, condition, how)
    return joined.select(*left.columns, *payload)
