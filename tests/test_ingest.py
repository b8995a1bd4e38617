from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from palabre import schemas
from palabre.functions import assign_id, decode_value, to_envelope
from palabre.operators import ingest_json
from palabre.sources import read_json_records

FULL = '{"message":"a","Created_At":"2024-01-01 10:00:00","user_id":"u","chat_id":"c","type":"t"}'
TIME = datetime(2024, 1, 1, 10)


def raw(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "raw_data string")


def parse(spark, value, schema=schemas.MESSAGE, **options):
    ingested = ingest_json(raw(spark, value), schema, with_id=False, **options)
    valid = [tuple(r)[:-1] for r in ingested.valid.collect()]
    invalid = [r["corrupt_record"] for r in ingested.invalid.collect()]
    return valid, invalid


@pytest.mark.parametrize(
    "value, expected",
    [
        (FULL, ("a", TIME, "u", "c", "t")),
        (FULL.replace("Created_At", "created_at"), ("a", None, "u", "c", "t")),
        (FULL.replace("2024-01-01 10:00:00", "nope"), ("a", None, "u", "c", "t")),
        (
            FULL.replace("2024-01-01 10:00:00", "2024-01-01T12:00:00+02:00"),
            ("a", TIME, "u", "c", "t"),
        ),
        (FULL.replace('"2024-01-01 10:00:00"', "1704103200"), ("a", TIME, "u", "c", "t")),
        ('{"message":5}', ("5", None, None, None, None)),
        ('{"message":true}', ("true", None, None, None, None)),
        ('{"message":{"x":1}}', ('{"x":1}', None, None, None, None)),
        ('{"message":[1]}', ("[1]", None, None, None, None)),
        ('{"message":"a","id":"7","other":1}', ("a", None, None, None, None)),
        ('{"message":"a","message":"b"}', ("b", None, None, None, None)),
        ('{"message":""}', ("", None, None, None, None)),
    ],
)
def test_valid_records(spark, value, expected):
    assert parse(spark, value) == ([expected], [])


@pytest.mark.parametrize(
    "value",
    [
        '"{\\"message\\":\\"a\\"}"',
        '{"user_id":"u"}',
        '{"message":"a"',
        "not json",
        "",
        '[{"message":"a"}]',
        '[{"message":"a"},{"message":"b"}]',
    ],
)
def test_invalid_records_keep_their_text(spark, value):
    assert parse(spark, value) == ([], [value])


def test_record_without_value_is_only_counted(spark):
    ingested = ingest_json(raw(spark, None, FULL, "x"), schemas.MESSAGE, with_id=False)
    assert ingested.valid.count() == 1 and ingested.invalid.count() == 1
    assert tuple(ingested.stats().first()) == (1, 1, 1, 3)


@pytest.mark.parametrize(
    "key, valid",
    [("1", True), ('"1"', False), ("1.0", False), ("1.7", False), ("3000000000", False)],
)
def test_integer_key(spark, key, valid):
    record = f'{{"produit_id":{key},"nom":"Livre","categorie":"Culture","prix":19.99}}'
    rows, bad = parse(spark, record, schemas.PRODUIT, key="produit_id")
    assert (len(rows), len(bad)) == ((1, 0) if valid else (0, 1))


def test_price_of_another_type_is_null(spark):
    rows, _ = parse(spark, '{"produit_id":1,"prix":"599.99"}', schemas.PRODUIT)
    assert rows == [(1, None, None, None)]


def test_key_other_than_the_first_field(spark):
    record = '{"produit_id":1,"nom":"Livre"}'
    assert parse(spark, record, schemas.ACHAT, key="achat_id")[1] == [record]
    assert parse(spark, record, schemas.ACHAT, key="produit_id")[1] == []


def test_required_fields_and_aliases(spark):
    lower = FULL.replace("Created_At", "created_at")
    assert parse(spark, lower, required=["Created_At"]) == ([], [lower])
    rows, _ = parse(
        spark, lower, required=["Created_At"], aliases={"Created_At": ["created_at"]}
    )
    assert rows == [("a", TIME, "u", "c", "t")]


def test_record_encoded_twice(spark):
    twice = spark.createDataFrame(
        [(None, b'"{\\"message\\":\\"\\u00e9\\"}"'), (None, b'{"message":"plain"}')],
        "key binary, value binary",
    )
    rows = ingest_json(decode_value(twice, unwrap=True), schemas.MESSAGE, with_id=False)
    assert sorted(r["message"] for r in rows.valid.collect()) == ["plain", "é"]


def test_own_id_comes_before_the_derived_one(spark):
    records = spark.createDataFrame(
        [('{"message":"a","id":"7"}', "t", 0, 1), ('{"message":"b"}', "t", 0, 2)],
        "raw_data string, topic string, partition int, offset long",
    )
    names = list(schemas.MESSAGE.names)
    kept = ingest_json(records, schemas.MESSAGE, keep_id=True).valid
    assert kept.columns == ["id", *names, "processed_time"]
    assert {r["message"]: r["id"] for r in kept.collect()}["a"] == "7"
    derived = ingest_json(records, schemas.MESSAGE).valid
    ids = {r["message"]: r["id"] for r in derived.collect()}
    assert ids["a"] != "7" and len(set(ids.values())) == 2
    assert ids["b"] == {r["message"]: r["id"] for r in kept.collect()}["b"]
    assert schemas.MESSAGE.names == names


def test_ids_are_stable_and_random_ones_distinct(spark):
    df = spark.range(100).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset")
    )
    first = {r["id"] for r in assign_id(df).collect()}
    assert first == {r["id"] for r in assign_id(df.repartition(7)).collect()} and len(first) == 100
    assert len({r["id"] for r in assign_id(df, random=True).collect()}) == 100


def test_decode_keeps_position_and_optionally_the_key(spark):
    df = spark.createDataFrame(
        [(b"k", b"v", "t", 0, 1)],
        "key binary, value binary, topic string, partition int, offset long",
    )
    assert decode_value(df).columns == ["raw_data", "topic", "partition", "offset"]
    assert tuple(decode_value(df, keep_key=True).first()) == ("k", "v", "t", 0, 1)


def test_envelope_leaves_out_null_fields(spark):
    df = spark.createDataFrame([(1, None, "é")], "a int, b string, c string")
    assert tuple(to_envelope(df).first()) == (None, '{"a":1,"c":"é"}')
    assert to_envelope(df, F.col("a")).first()["key"] == "1"


def test_pretty_printed_document(spark, scratch):
    path = f"{scratch}/message.json"
    with open(path, "w") as file:
        file.write('{\n  "message": "bonjour",\n  "Created_At": "2021-07-07 14:00:00"\n}')
    row = read_json_records(spark, path, schemas.MESSAGE, multi_line=True).first()
    assert (row["message"], row["Created_At"]) == ("bonjour", datetime(2021, 7, 7, 14))
