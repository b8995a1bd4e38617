"""A left join that stays balanced when one key holds much of the right side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """All rows of ``left`` with their matches; the sides share no column name.

    Adaptive execution can split large partitions of an inner join, but not the right side
    of a left join. So matches come from an inner join, and left rows without one from an
    anti join with the distinct keys of the right side, which are made before the
    shuffle. Left rows without a key match nothing and are not shuffled.
    """
    same = F.col(left_key) == F.col(right_key)
    keyed = left.filter(F.col(left_key).isNotNull())
    present = right.filter(F.col(right_key).isNotNull())
    matched = keyed.join(present, same)
    keys = present.select(F.col(right_key).alias("_key")).distinct()
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    lonely = keyed.join(keys, F.col(left_key) == F.col("_key"), "left_anti")
    keyless = left.filter(F.col(left_key).isNull())
    return matched.unionByName(lonely.select("*", *nothing)).unionByName(keyless.select("*", *nothing))
