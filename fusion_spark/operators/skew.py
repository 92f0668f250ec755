"""Joins that stay balanced when single keys hold a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SALT = 1_000_000


def hot_keys(df: DataFrame, keys: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Every key with more than ``rows_per_salt`` rows, and the number of salts it needs.

    A salt of a key never holds more than about ``rows_per_salt`` rows, whatever the size of
    the table; there is at most one such key per ``rows_per_salt`` rows.
    """
    return (
        df.filter(_all_set(keys)).groupBy(*keys).count()
        .filter(F.col("count") > rows_per_salt)
        .select(*keys, F.ceil(F.col("count") / rows_per_salt).cast("int").alias("_salts"))
    )


def shuffled(df: DataFrame) -> DataFrame:
    """Marks a side of a join that must not be broadcast on a guess.

    The planner guesses exploded, gathered or stored rows at the size of their compressed
    file, a small part of what they take as rows, and would send them through the driver.
    """
    return df.hint("merge")


def _all_set(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join of a large ``left`` with a keyed ``right`` (inner, left or left_semi).

    The plan reads either side once. A hot key of ``left`` is split by adaptive execution
    when its partition turns out large. Where the hot keys are known beforehand (``hot``,
    from ``hot_keys`` over a stored table), their rows are spread over salts by the
    ``spread`` columns, which should tell rows apart, and the matching rows of ``right`` are
    repeated once per salt; this also holds where a later operator pins the partitions.
    ``hot`` is broadcast, so that no row moves by its bare key: it has one row per
    ``rows_per_salt`` rows of the table at most.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"skew_join cannot repeat the right side of a {how} join")
    if hot is None:
        return left.join(right, on, how)
    columns = spread or [c for c in left.columns if c not in on]
    hot = F.broadcast(hot)
    salted_left = left.join(hot, on, "left").withColumn(
        "_salt",
        F.when(F.col("_salts").isNull(), F.lit(0))
        .otherwise(F.pmod(F.xxhash64(*columns), F.col("_salts")))
        .cast("int"),
    ).drop("_salts")
    salted_right = right.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0))))
    ).drop("_salts")
    return salted_left.join(shuffled(salted_right), [*on, "_salt"], how).drop("_salt")
