from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from palabre import schemas
from palabre.operators import classify_messages
from palabre.sources import FileTopics, compact_batches, read_table, write_batch
from palabre.streaming import (
    IngestJob,
    ingest_batch,
    messages_reply,
    start_classifier,
    start_ingest,
    start_registration,
    start_responder,
    start_router,
    table_reply,
    users_reply,
)

MESSAGES = [
    '{"message":"bonjour","Created_At":"2024-01-01 10:00:00","user_id":"u1","chat_id":"c1","type":"text"}',
    '{"message":"salut","Created_At":"2024-01-01 11:00:00","user_id":"u2","chat_id":"c1","type":"text"}',
    '{"user_id":"u3"}',
    "not json",
    None,
]


def send(spark, topics, topic, values, key=None):
    rows = spark.createDataFrame([(key, v) for v in values], schemas.REPLY)
    topics.publish(rows, topic)


def replies(spark, topics, topic):
    rows = topics.read(spark, topic)
    return [
        (r["key"], r["value"])
        for r in rows.select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
        ).collect()
    ]


def message_job(name):
    return IngestJob(
        "ia_message", schemas.MESSAGE, name, f"{name}_errors", save_topic=f"{name}_save"
    )


def test_ingest_stores_publishes_and_quarantines(spark, scratch, name):
    topics = FileTopics(f"{scratch}/topics")
    send(spark, topics, "ia_message", MESSAGES)
    start_ingest(
        spark, topics, message_job(name), f"{scratch}/ckpt", available_now=True
    ).awaitTermination()
    stored = read_table(spark, name)
    assert stored.columns == ["id", *schemas.MESSAGE.names]
    rows = {r["message"]: r for r in stored.collect()}
    assert set(rows) == {"bonjour", "salut"}
    assert rows["bonjour"]["Created_At"] == datetime(2024, 1, 1, 10)
    bad = read_table(spark, f"{name}_errors").collect()
    assert sorted(r["corrupt_record"] for r in bad) == ["not json", '{"user_id":"u3"}']
    assert all(r["processed_time"] is not None for r in bad)
    saved = [json.loads(v) for _, v in replies(spark, topics, f"{name}_save")]
    assert {s["id"] for s in saved} == {r["id"] for r in rows.values()}
    assert "corrupt_record" not in saved[0]


def test_ingest_restart_reads_only_new_records(spark, scratch, name):
    topics, job = FileTopics(f"{scratch}/topics"), message_job(name)
    for expected in (2, 4):
        send(spark, topics, "ia_message", MESSAGES)
        start_ingest(
            spark, topics, job, f"{scratch}/ckpt", available_now=True
        ).awaitTermination()
        assert read_table(spark, name).count() == expected
    assert read_table(spark, name).select("id").distinct().count() == 4


def test_replayed_batch_changes_nothing(spark, scratch, name):
    topics, job = FileTopics(f"{scratch}/topics"), message_job(name)
    send(spark, topics, "ia_message", MESSAGES)
    batch = topics.read(spark, "ia_message")
    counts = ingest_batch(batch, 7, job, topics)
    assert counts == {"valid": 2, "invalid": 2, "tombstones": 1, "total": 5}
    before = sorted(read_table(spark, name).collect())
    ingest_batch(batch, 7, job, topics)
    assert sorted(read_table(spark, name).collect()) == before
    assert read_table(spark, f"{name}_errors").count() == 2
    ids = [json.loads(v)["id"] for _, v in replies(spark, topics, f"{name}_save")]
    assert len(ids) == 4 and len(set(ids)) == 2


def test_ingest_partitioned_by_arrival_date(spark, scratch, name):
    topics = FileTopics(f"{scratch}/topics")
    job = IngestJob(
        "topic2",
        schemas.RETAIL_USER,
        name,
        f"{name}_errors",
        key="user_id",
        with_id=False,
        by_date=True,
        file_format="parquet",
    )
    send(spark, topics, "topic2", ['{"user_id":1,"nom":"Alice"}', '{"nom":"Bob"}'])
    start_ingest(spark, topics, job, f"{scratch}/ckpt", available_now=True).awaitTermination()
    rows = read_table(spark, name).collect()
    arrived = topics.read(spark, "topic2").first()["timestamp"]
    assert [(r["user_id"], r["year"], r["month"], r["day"]) for r in rows] == [
        (1, arrived.year, arrived.month, arrived.day)
    ]
    assert read_table(spark, f"{name}_errors").count() == 1


def test_failed_batch_is_not_lost(spark, scratch, name):
    topics, job = FileTopics(f"{scratch}/topics"), message_job(name)
    send(spark, topics, "ia_message", MESSAGES)
    spark.sql(f"CREATE TABLE {name} (other INT) USING orc")
    query = start_ingest(spark, topics, job, f"{scratch}/ckpt", available_now=True)
    with pytest.raises(Exception):
        query.awaitTermination()
    spark.sql(f"DROP TABLE {name}")
    start_ingest(spark, topics, job, f"{scratch}/ckpt", available_now=True).awaitTermination()
    assert read_table(spark, name).count() == 2


def user_table(spark, name):
    spark.createDataFrame(
        [("1", "Alice", "a@x.com", "pw1", None), ("2", "Bob", "b@x.com", "pw2", None)],
        schemas.stored(schemas.USER),
    ).write.format("orc").saveAsTable(name)


@pytest.mark.parametrize(
    "requests, expected",
    [
        (['{"email":"a@x.com","password":"pw1"}'], {"Alice", "Bob"}),
        (['{"email":"a@x.com","password":"no"}', '{"email":"b@x.com","password":"pw2"}'], {"Alice", "Bob"}),
        (['{"email":"a@x.com","password":"no"}', "not json", None], None),
        (['{"email":"a@x.com"}'], None),
    ],
)
def test_users_reply(spark, scratch, name, requests, expected):
    topics = FileTopics(f"{scratch}/topics")
    user_table(spark, name)
    send(spark, topics, "send_users", requests, key="r1")
    start_responder(
        spark, topics, "send_users", "get_users", users_reply(name), f"{scratch}/ckpt",
        available_now=True,
    ).awaitTermination()
    [(key, value)] = replies(spark, topics, "get_users")
    assert key == "r1"
    if expected is None:
        assert json.loads(value) == {"error": "Utilisateur non trouvé"}
    else:
        answer = json.loads(value)
        assert {u["nom"] for u in answer} == expected
        assert "password" not in answer[0]


def test_messages_reply_and_missing_table(spark, scratch, name):
    topics = FileTopics(f"{scratch}/topics")
    build = messages_reply(f"{name}_m", f"{name}_md")

    def ask():
        send(spark, topics, "send_all_messages", ['{"any":1}', '{"any":2}'])
        start_responder(
            spark, topics, "send_all_messages", "get_all_messages", build, f"{scratch}/ckpt",
            available_now=True,
        ).awaitTermination()
        return replies(spark, topics, "get_all_messages")

    assert ask() == [(None, "[]")]
    spark.createDataFrame(
        [("1", "a", None, "u", "c", "")], schemas.stored(schemas.MESSAGE)
    ).write.format("orc").saveAsTable(f"{name}_m")
    spark.createDataFrame(
        [("1", "true", None), ("1", "false", None)], schemas.MESSAGE_METADATA
    ).write.format("orc").saveAsTable(f"{name}_md")
    answers = [json.loads(v) for _, v in ask()]
    [full] = [a for a in answers if a]
    assert len(answers) == 2
    assert sorted(m["valide"] for m in full) == ["false", "true"]
    assert "message_id" not in full[0]


def test_table_reply(spark, scratch, name):
    user_table(spark, name)
    requests = spark.createDataFrame([(None, "x")], schemas.REPLY)
    [row] = table_reply(name)(requests, None).collect()
    texts = json.loads(row["value"])
    assert sorted(json.loads(t)["nom"] for t in texts) == ["Alice", "Bob"]
    [row] = table_reply(f"{name}_none")(requests, None).collect()
    assert row["value"] == "[]"


def test_registration_stream(spark, scratch, name):
    topics = FileTopics(f"{scratch}/topics")

    def register(*records):
        if records:
            send(spark, topics, "register", [json.dumps(r) for r in records])
        start_registration(
            spark, topics, "register", name, f"{scratch}/ckpt", available_now=True
        ).awaitTermination()
        return sorted(r["nom"] for r in read_table(spark, name).collect())

    late = {"nom": "late", "email": "a@x", "date_inscription": "2024-01-02 00:00:00"}
    early = {"nom": "early", "email": "a@x", "date_inscription": "2024-01-01 00:00:00"}
    other = {"nom": "other", "email": "b@x", "date_inscription": "2024-01-01 00:00:00"}
    assert register(late, early) == ["early"]
    assert register(late, other) == ["early", "other"]
    send(spark, topics, "register", ["not json"])
    assert register() == ["early", "other"]
    assert [r["corrupt_record"] for r in read_table(spark, f"{name}_errors").collect()] == ["not json"]


def test_classifier_stream(spark, scratch, name):
    topics = FileTopics(f"{scratch}/topics")
    send(
        spark, topics, "send_message",
        ['{"id":"1","message":"t\'es moche","type":"","Created_At":"2021-07-07 14:00:00"}',
         '{"id":"2","message":"bonjour","type":""}'],
    )

    def scorer(text):
        return F.array(text.contains("moche").cast("double"), F.lit(0.5))

    start_classifier(
        spark, topics, lambda df: classify_messages(df, scorer), f"{scratch}/ckpt",
        available_now=True,
    ).awaitTermination()
    sent = {json.loads(v)["id"]: json.loads(v) for _, v in replies(spark, topics, "ia_message")}
    assert sent["1"]["type"] == "inapproprié" and sent["2"]["type"] == "approprié"
    assert sent["1"]["Created_At"] == "2021-07-07 14:00:00"
    # Malformed records are kept as they came; the key stays, a doubled encoding doesn't.
    send(spark, topics, "send_message", ["not json", '{"id":"3"}', None], key="chat")
    send(spark, topics, "send_message", ['"{\\"id\\":\\"4\\",\\"message\\":\\"moche\\"}"'], key="chat")
    start_classifier(
        spark, topics, lambda df: classify_messages(df, scorer), f"{scratch}/ckpt", available_now=True,
        error_table=name,
    ).awaitTermination()
    after = replies(spark, topics, "ia_message")
    assert len(after) == 3
    assert [json.loads(v)["type"] for k, v in after if k == "chat"] == ["inapproprié"]
    assert sorted(r[0] for r in read_table(spark, name).select("corrupt_record").collect()) == ["not json", '{"id":"3"}']


def test_router_stream(spark, scratch):
    topics = FileTopics(f"{scratch}/topics")
    send(spark, topics, "ia_message", ["a", "b"])
    start_router(spark, topics, "ia_message", f"{scratch}/ckpt", available_now=True).awaitTermination()
    for reader in ("spark", "backend"):
        assert sorted(v for _, v in replies(spark, topics, reader)) == ["a", "b"]


def test_batch_write_replaces_only_its_own_batch(spark, name):
    schema = StructType().add("id", StringType()).add("_own", "integer")
    spark.sql(
        f"CREATE TABLE {name} (id STRING, _own INT, _batch_run STRING, _batch_id BIGINT) USING orc "
        "PARTITIONED BY (_batch_run, _batch_id)"
    )
    first = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    second = spark.createDataFrame([("c", 3)], schema)
    write_batch(first, name, 1)
    write_batch(second, name, 2)
    write_batch(first, name, 1)
    rows = read_table(spark, name)
    assert rows.columns == ["id", "_own"]
    assert sorted(r["id"] for r in rows.collect()) == ["a", "b", "c"]
    write_batch(second, name, 1, run="another")
    assert sorted(r["id"] for r in read_table(spark, name).collect()) == ["a", "b", "c", "c"]
    compact_batches(spark, name, "main", 3)
    assert sorted(r["id"] for r in read_table(spark, name).collect()) == ["a", "b", "c", "c"]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    write_batch(second, name, 3)
    compact_batches(spark, name, "main", 4)
    assert read_table(spark, name).count() == 5


def test_publications_may_run_at_once(spark, scratch):
    topics = FileTopics(f"{scratch}/topics")
    values = [[f"{n}-{i}" for i in range(50)] for n in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda v: send(spark, topics, "busy", v), values))
    got = sorted(v for _, v in replies(spark, topics, "busy"))
    assert got == sorted(v for group in values for v in group)


def test_mixed_requests_point_to_one_reply(spark, scratch, name):
    topics = FileTopics(f"{scratch}/topics")
    user_table(spark, name)
    for key in ("a", "b", None):
        send(spark, topics, "send_users", ['{"email":"a@x.com","password":"pw1"}'], key=key)
    start_responder(
        spark, topics, "send_users", "get_users", users_reply(name), f"{scratch}/ckpt", available_now=True
    ).awaitTermination()
    got = dict(replies(spark, topics, "get_users"))
    assert len(got) == 3 and got["a"] == got["b"]
    assert {u["nom"] for u in json.loads(got[json.loads(got["a"])["reply"]])} == {"Alice", "Bob"}
