from __future__ import annotations

import json

from pyspark.sql import functions as F

from palabre import schemas
from palabre.plans import platform
from palabre.sources import FileTopics, read_table
from palabre.streaming import run_all
from tests.test_streaming import replies, send


def drop(spark, *jobs):
    for job in jobs:
        spark.sql(f"DROP TABLE IF EXISTS {job.table}")
        spark.sql(f"DROP TABLE IF EXISTS {job.error_table}")


def test_chat_from_topic_to_reply(spark, scratch):
    topics = FileTopics(f"{scratch}/topics")
    drop(spark, platform.USERS, platform.MESSAGES, platform.METADATA)
    send(
        spark, topics, schemas.REGISTER,
        ['{"nom":"Alice","email":"alice1@gmail.com","password":"pass1234","date_inscription":"2024-01-01 00:00:00"}',
         '{"email":"x"}'],
    )
    send(
        spark, topics, schemas.IA_MESSAGE,
        ['{"id":"m1","message":"bonjour","created_at":"2024-01-01 00:00:00","user_id":"u1","chat_id":"c1","type":"text"}',
         '{"id":"m2","message":"salut","user_id":"u2","chat_id":"c1","type":"text"}',
         '"{\\"id\\":\\"m3\\",\\"message\\":\\"twice\\"}"'],
    )
    send(
        spark, topics, schemas.CHECK_MESSAGE,
        ['{"id_message":"m1","valide":"true","date":"2024-01-02 00:00:00"}'],
    )
    send(spark, topics, schemas.SEND_USERS, ['{"email":"alice1@gmail.com","password":"pass1234"}'])
    send(spark, topics, schemas.SEND_ALL_MESSAGES, ["{}"])

    def run():
        queries = platform.start_chat(
            spark, topics, f"{scratch}/ckpt", f"{scratch}/tables", available_now=True
        )
        for query in queries:
            query.awaitTermination()

    run()
    assert read_table(spark, "users").count() == 1
    assert read_table(spark, "users_errors").count() == 1
    # The first requests may have come before the tables; ask again.
    send(spark, topics, schemas.SEND_USERS, ['{"email":"alice1@gmail.com","password":"pass1234"}'])
    send(spark, topics, schemas.SEND_ALL_MESSAGES, ["{}"])
    run()
    users = [json.loads(v) for _, v in replies(spark, topics, schemas.GET_USERS)]
    assert any(isinstance(u, list) and u and u[0]["nom"] == "Alice" for u in users)
    answers = [json.loads(v) for _, v in replies(spark, topics, schemas.GET_ALL_MESSAGES)]
    full = max(answers, key=len)
    assert {(m["message"], m["valide"]) for m in full} == {
        ("bonjour", "true"), ("salut", "false"), ("twice", "false"),
    }
    saved = [json.loads(v)["id"] for _, v in replies(spark, topics, "messages_save")]
    assert sorted(saved) == ["m1", "m2", "m3"]
    stored = read_table(spark, "messages").filter("id = 'm1'").first()
    assert stored["Created_At"] is not None
    drop(spark, platform.USERS, platform.MESSAGES, platform.METADATA)


def test_retail(spark, scratch):
    topics = FileTopics(f"{scratch}/topics")
    jobs = (platform.PRODUCTS, platform.PURCHASES, platform.RETAIL_USERS)
    drop(spark, *jobs)
    send(
        spark, topics, schemas.PRODUCTS_TOPIC,
        ['{"produit_id":4,"nom":"Livre","categorie":"Culture","prix":19.99}', '{"produit_id":"x"}'],
    )
    send(
        spark, topics, schemas.PURCHASES_TOPIC,
        ['{"achat_id":10001,"produit_id":4,"date_achat":"2024-01-01 00:00:00","client_id":7,'
         '"quantite":2,"montant_total":39.98,"produit_details":{"produit_id":4}}',
         '{"user_id":1,"nom":"Bob"}'],
    )
    for query in platform.start_retail(
        spark, topics, f"{scratch}/ckpt", f"{scratch}/tables", jobs=jobs, available_now=True
    ):
        query.awaitTermination()
    assert read_table(spark, "produits2").count() == 1
    assert read_table(spark, "produits_errors").count() == 1
    purchase = read_table(spark, "achats").first()
    assert purchase.asDict() == {
        "achat_id": 10001, "produit_id": 4, "date_achat": "2024-01-01 00:00:00",
        "client_id": 7, "quantite": 2, "montant_total": 39.98,
    }
    user = read_table(spark, "retail_users").select("user_id", F.col("year") > 2000).first()
    assert tuple(user) == (1, True)
    drop(spark, *jobs)


def test_run_all_stops_the_others(spark, scratch):
    topics = FileTopics(f"{scratch}/topics")
    drop(spark, platform.PRODUCTS, platform.PURCHASES)
    send(spark, topics, schemas.PRODUCTS_TOPIC, ['{"produit_id":4}'])
    send(spark, topics, schemas.PURCHASES_TOPIC, ['{"achat_id":1}'])
    spark.streams.resetTerminated()
    running = platform.start_retail(
        spark, topics, f"{scratch}/a", f"{scratch}/tables", jobs=(platform.PRODUCTS,),
        interval="1 second",
    )
    ending = platform.start_retail(
        spark, topics, f"{scratch}/b", f"{scratch}/tables", jobs=(platform.PURCHASES,),
        available_now=True,
    )
    run_all(spark, running + ending)
    assert not any(q.isActive for q in running + ending)
    drop(spark, platform.PRODUCTS, platform.PURCHASES)
