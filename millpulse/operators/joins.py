"""A join that stays balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_SALTS = 32


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    spread_by: list[str],
    how: str = "left",
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Join many `rows` to a small `lookup`, spreading each key over `salts` tasks.

    The salt is a hash of columns of the row and of the number of the task that reads it, so that
    copies of one row are spread as well; a retried task has the same number and computes the same
    salt. The lookup is repeated once per salt. Every row and every match is kept. When the lookup
    turns out to be small, adaptive execution still replaces the shuffle by a broadcast.
    """
    if salts <= 1:
        return rows.join(lookup, on, how)
    salt = F.pmod(F.xxhash64(*spread_by, F.spark_partition_id()), F.lit(salts)).cast("int")
    salted_rows = rows.withColumn("_salt", salt)
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(salted_lookup, [on, "_salt"], how).drop("_salt")
