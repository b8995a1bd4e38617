from __future__ import annotations

import json
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palabre import operators as ops
from palabre import schemas


def test_small_table_is_one_message(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    [row] = ops.json_reply(df).collect()
    assert row["key"] is None
    assert json.loads(row["value"]) == [{"n": 1, "t": "a"}, {"n": 2}]
    [row] = ops.json_reply(df, request_key="r").collect()
    assert row["key"] == "r"


def test_string_encoding(spark):
    df = spark.createDataFrame([(1, 'a"b')], "n int, t string")
    [row] = ops.table_as_json(df).collect()
    assert [json.loads(t) for t in json.loads(row["value"])] == [{"n": 1, "t": 'a"b'}]
    with pytest.raises(ValueError):
        ops.json_reply(df, encoding="xml")


def test_empty_table(spark):
    empty = spark.createDataFrame([], "n int")
    assert [tuple(r) for r in ops.table_as_json(empty, request_key="r").collect()] == [("r", "[]")]


def elements_of(reply):
    return [item for row in reply if row["value"].startswith("[") for item in json.loads(row["value"])]


@pytest.mark.parametrize("encoding", ["object", "string"])
def test_messages_are_bounded_and_whole(spark, encoding):
    df = spark.range(1000).select(F.col("id").alias("n"), F.repeat(F.lit("x"), 50).alias("t"))
    reply = ops.json_reply(df, encoding=encoding, max_rows=30, max_bytes=1000).collect()
    [closing] = [r for r in reply if r["key"] == "parts"]
    messages = [r for r in reply if r["key"] != "parts"]
    assert json.loads(closing["value"]) == {"parts": len(messages)}
    assert max(len(json.loads(r["value"])) for r in messages) <= 30
    assert max(len(r["value"]) for r in messages) <= 1000
    texts = elements_of(messages)
    items = [json.loads(t) for t in texts] if encoding == "string" else texts
    assert sorted(e["n"] for e in items) == list(range(1000))
    keys = [r["key"] for r in reply]
    assert len(set(keys)) == len(keys) and None not in keys


def test_a_large_result_has_no_bare_key(spark):
    """Few rows, but many bytes; one record is longer than a message."""
    df = spark.range(40).select("id", F.repeat(F.lit('"'), F.when(F.col("id") == 3, 9000).otherwise(300).cast("int")).alias("t"))
    for encoding in ("object", "string"):
        reply = ops.json_reply(df, encoding=encoding, request_key="r", max_bytes=4000).collect()
        assert "r" not in {r["key"] for r in reply} and "r/parts" in {r["key"] for r in reply}
        long = [r for r in reply if len(r["value"]) > 4000]
        assert len(long) == 1 and len(json.loads(long[0]["value"])) == 1


def test_records_without_names_are_spread(spark):
    df = spark.range(5000).select(F.lit(None).cast("string").alias("id"), (F.col("id") % 2500).alias("n"))
    reply = ops.json_reply(df, max_rows=50).collect()
    buckets = {r["key"].split("-")[0] for r in reply if r["key"] != "parts"}
    assert len(buckets) > 50 and len(elements_of(reply)) == 5000


def test_same_cut_on_every_layout(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("n"))
    first = Counter(map(tuple, ops.json_reply(df, max_rows=20).collect()))
    again = Counter(map(tuple, ops.json_reply(df.repartition(5), max_rows=20).collect()))
    assert first == again


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(st.integers(0, 3), min_size=1, max_size=60),
    st.integers(1, 9),
    st.integers(1, 60),
)
def test_copies_are_kept(spark, values, max_rows, max_bytes):
    df = spark.createDataFrame([(v,) for v in values], "n int")
    reply = ops.json_reply(df, max_rows=max_rows, max_bytes=max_bytes).collect()
    assert all(len(json.loads(r["value"])) <= max_rows for r in reply if r["value"].startswith("["))
    assert Counter(e["n"] for e in elements_of(reply)) == Counter(values)


def test_one_record_in_most_rows(spark):
    """Copies of one record are spread over messages and buckets."""
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, -1).otherwise(F.col("id")).alias("n")
    )
    reply = ops.json_reply(df, max_rows=50)
    rows = reply.collect()
    assert Counter(e["n"] for e in elements_of(rows))[-1] == 2500
    per_bucket = Counter()
    for r in rows:
        if r["key"] == "parts":
            continue
        per_bucket[r["key"].split("-")[0]] += len(json.loads(r["value"]))
    assert len(per_bucket) > 20 and max(per_bucket.values()) < 500


def test_many_copies_are_made_by_several_tasks(spark, monkeypatch):
    """A few records with many copies are as much work as the messages that they become."""
    monkeypatch.setattr("palabre.operators.replies.TASK_BYTES", 200_000)
    df = spark.createDataFrame([("a", 150_000), ("b", 49_000), ("c" * 600, 900)], "t string, n long")
    reply = ops.json_reply(df, copies="n", max_rows=1000, max_bytes=1000)
    assert len(reply.inputFiles()) > 5
    rows = reply.collect()
    assert max(len(r["value"]) for r in rows) <= 1000
    assert Counter(e["t"][0] for e in elements_of(rows)) == {"a": 150_000, "b": 49_000, "c": 900}


def test_reply_users(spark):
    users = spark.createDataFrame([("A", "a@x", "p", None)], schemas.USER)
    right = spark.createDataFrame([("a@x", "p")], schemas.USER_LOGIN)
    wrong = spark.createDataFrame([("a@x", "q")], schemas.USER_LOGIN)
    [row] = ops.reply_users(users, right).collect()
    assert json.loads(row["value"]) == [{"nom": "A", "email": "a@x"}]
    [row] = ops.reply_users(users, wrong).collect()
    assert json.loads(row["value"]) == {"error": "Utilisateur non trouvé"}


def test_reply_messages(spark):
    messages = spark.createDataFrame(
        [("1", "a", None, "u", "c", ""), (None, "b", None, "u", "c", "")],
        schemas.stored(schemas.MESSAGE),
    )
    verdicts = spark.createDataFrame([("1", "true", None)] * 3, schemas.MESSAGE_METADATA)
    [row] = ops.reply_messages(messages, verdicts).collect()
    got = Counter((m["message"], m["valide"]) for m in json.loads(row["value"]))
    assert got == {("a", "true"): 3, ("b", "false"): 1}
    assert "message_id" not in json.loads(row["value"])[0]
    none = ops.reply_messages(messages.limit(0), verdicts).collect()
    assert [r["value"] for r in none] == ["[]"]
