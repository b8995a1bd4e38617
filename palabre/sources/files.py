"""Records kept as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_json_records(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """JSON records with a declared schema, so the files are read once.

    One record per line by default: such files are split between tasks. A file
    that holds one pretty-printed document needs ``multi_line``.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def spread(df: DataFrame) -> DataFrame:
    """The scan of a few files, with its rows handed to all cores.

    For costly work per row on files that Spark cannot split into enough tasks. A
    scan with at least one task per core is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
