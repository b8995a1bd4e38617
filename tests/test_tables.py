from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from palabre import schemas
from palabre.session import shared_dir
from palabre.sources import (
    KafkaTopics,
    append_partitioned_by_date,
    append_table,
    ensure_table,
    overwrite_table,
    quarantine,
    read_table,
    table_exists,
)
from palabre.sources.tables import DATE_COLUMNS


def test_append_matches_columns_by_name(spark, name):
    ensure_table(spark, name, schemas.PRODUIT)
    rows = spark.createDataFrame(
        [(19.99, "Culture", "Livre", 4, "extra")],
        "prix double, categorie string, nom string, produit_id int, more string",
    )
    append_table(rows, name)
    append_table(rows, name)
    assert [tuple(r) for r in read_table(spark, name).collect()] == [
        (4, "Livre", "Culture", 19.99)
    ] * 2


def test_table_is_created_once(spark, name):
    assert not table_exists(spark, name)
    ensure_table(spark, name, schemas.PRODUIT)
    append_table(spark.createDataFrame([(1, "a", "b", 1.0)], schemas.PRODUIT), name)
    ensure_table(spark, name, schemas.PRODUIT)
    assert table_exists(spark, name) and read_table(spark, name).count() == 1


def test_bucketed_table_layout(spark, name):
    ensure_table(spark, name, schemas.stored(schemas.USER), bucket_by="id", buckets=4)
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert rows["Num Buckets"] == "4" and rows["Bucket Columns"] == "[`id`]"
    assert rows["Provider"].lower() == "orc"


def test_external_table_keeps_its_files(spark, name, scratch):
    ensure_table(spark, name, schemas.ROBUST_TEST, file_format="parquet", location=f"{scratch}/t")
    append_table(spark.createDataFrame([(1, "v", None)], schemas.ROBUST_TEST), name)
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(f"{scratch}/t").count() == 1


def test_overwrite_replaces_rows_and_schema(spark, name):
    people = [
        ("Dupont", "Jean", 35, 50000.0),
        ("Martin", "Marie", 28, 65000.0),
    ]
    for _ in range(2):
        overwrite_table(spark.createDataFrame(people, schemas.NEW_USER), name)
    assert sorted(map(tuple, read_table(spark, name).collect())) == people


def test_quarantine_without_batches(spark, name):
    bad = spark.createDataFrame([("x", None)], schemas.QUARANTINE)
    quarantine(bad, name)
    quarantine(bad, name)
    assert read_table(spark, name).count() == 2


def test_date_partitions_are_pruned(spark, name):
    ensure_table(
        spark, name, schemas.RETAIL_USER, file_format="parquet", partition_by=DATE_COLUMNS
    )
    rows = spark.createDataFrame(
        [(1, "a", "e", None, "2024-02-03 04:05:06"), (2, "b", "e", None, "2023-12-31 23:59:59")],
        "user_id int, nom string, email string, date_inscription timestamp, processed_time string",
    ).withColumn("processed_time", F.col("processed_time").cast("timestamp"))
    append_partitioned_by_date(rows, name)
    got = sorted(
        (r["user_id"], r["year"], r["month"], r["day"]) for r in read_table(spark, name).collect()
    )
    assert got == [(1, 2024, 2, 3), (2, 2023, 12, 31)]
    plan = read_table(spark, name).filter("year = 2024")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_kafka_source_options(spark):
    topics = KafkaTopics("broker:9092", options={"maxOffsetsPerTrigger": "1000"})
    options = topics.source_options(spark, "register", startingOffsets="earliest")
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "register",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "minPartitions": str(spark.sparkContext.defaultParallelism),
        "maxOffsetsPerTrigger": "1000",
    }
    strict = KafkaTopics("broker:9092", fail_on_data_loss=True, min_partitions=3)
    options = strict.source_options(spark, "t")
    assert options["failOnDataLoss"] == "true" and options["minPartitions"] == "3"
    assert options["startingOffsets"] == "latest"


def test_shared_dir_follows_the_session(spark):
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("table_format", ["orc", "parquet"])
def test_formats(spark, name, table_format):
    ensure_table(spark, name, schemas.ROBUST_TEST, file_format=table_format)
    append_table(spark.createDataFrame([(1, "é", None)], schemas.ROBUST_TEST), name)
    assert read_table(spark, name).first()["value"] == "é"


def test_kafka_sink_options():
    topics = KafkaTopics("k:1", options={"kafka.security.protocol": "SSL", "maxOffsetsPerTrigger": "5"})
    assert topics.sink_options() == {"kafka.bootstrap.servers": "k:1", "kafka.security.protocol": "SSL"}
