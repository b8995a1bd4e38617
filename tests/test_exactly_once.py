"""Runs that break off between two steps, and readers between them."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from palabre import operators as ops
from palabre import schemas
from palabre.operators.status import KEPT, merge_status
from palabre.sources import (
    FileTopics,
    Manifest,
    ManifestConflict,
    compact_batches,
    compaction,
    ensure_table,
    read_table,
    write_batch,
)
from palabre.sources.tables import BATCH_PARTITIONS
from palabre.streaming import (
    Outbox,
    RouteTable,
    ingest_batch,
    kept_messages_reply,
    route_batch,
    start_responder,
    start_stateful_registration,
    users_reply,
)
from palabre.streaming import ingest as ingest_module
from palabre.streaming.queries import run_name
from palabre.streaming.registration import FirstOfEmail
from tests.test_streaming import MESSAGES, message_job, replies, send, user_table


def test_manifest_is_replaced_in_one_step(spark, scratch):
    manifest = Manifest(spark, f"{scratch}/m")
    assert manifest.read() == (0, {})
    version = 0
    for n in range(6):
        version = manifest.replace({"n": n, "é": None}, version)
        assert Manifest(spark, f"{scratch}/m").read() == (n + 1, {"n": n, "é": None})
    with pytest.raises(ManifestConflict):
        manifest.replace({"n": -1}, 5)
    assert manifest.read() == (6, {"n": 5, "é": None}) and len(manifest._versions()) == 3
    # A writer that broke off leaves a file that is no version.
    manifest._files.create(manifest._file(".half"), True).close()
    assert manifest.read()[0] == 6


def test_a_run_keeps_its_name(spark, scratch):
    # What a start that broke off left behind doesn't matter.
    manifest = Manifest(spark, f"{scratch}/ckpt/run_name")
    manifest._files.create(manifest._file(".half"), True).close()
    name = run_name(spark, f"{scratch}/ckpt")
    assert name and run_name(spark, f"{scratch}/ckpt/") == name != run_name(spark, f"{scratch}/other")


@pytest.fixture
def batches(spark, name, scratch):
    ensure_table(spark, name, schemas.REPLY, partition_by=BATCH_PARTITIONS, location=f"{scratch}/t")
    for n in range(5):
        write_batch(spark.createDataFrame([(f"k{n}", f"v{n}"), (f"k{n}", f"v{n}")], schemas.REPLY), name, n)
    return name


def rows_of(spark, table):
    return sorted(r["value"] for r in read_table(spark, table).collect())


def test_a_compaction_may_break_off_after_any_step(spark, batches):
    want = rows_of(spark, batches)
    steps = list(compaction(spark, batches, "main", 2))
    assert steps[-1] == "old batches dropped" and rows_of(spark, batches) == want
    for n in range(1, 4):
        broken = compaction(spark, batches, "main", 4)
        for _ in range(n):
            next(broken)
            assert rows_of(spark, batches) == want
        broken.close()
        write_batch(spark.createDataFrame([("k", "v4")], schemas.REPLY), batches, 5 + n)
        want = sorted([*want, "v4"])
        assert rows_of(spark, batches) == want
    compact_batches(spark, batches, "main", 4)
    assert rows_of(spark, batches) == want
    # One compacted partition, the batch that wasn't closed and three later ones.
    assert spark.sql(f"SHOW PARTITIONS {batches}").count() == 5
    compact_batches(spark, batches, "main", 100, drop=False)
    assert rows_of(spark, batches) == want and spark.sql(f"SHOW PARTITIONS {batches}").count() == 6
    compact_batches(spark, batches, "main", 100)
    assert rows_of(spark, batches) == want and spark.sql(f"SHOW PARTITIONS {batches}").count() == 1


def test_two_compactions_at_once(spark, batches):
    want = rows_of(spark, batches)
    first, second = (compaction(spark, batches, "main", 4) for _ in range(2))
    next(first), next(second)
    next(first)
    with pytest.raises(ManifestConflict):
        next(second)
    list(first)
    assert rows_of(spark, batches) == want


class Breaking(FileTopics):
    """Breaks off before, in the middle of, or after the publication."""

    def __init__(self, root, part):
        super().__init__(root)
        object.__setattr__(self, "part", part)

    def publish(self, df, topic=None):
        super().publish(df.filter(F.pmod(F.xxhash64("value"), F.lit(4)) < self.part), topic)
        raise ConnectionError


@pytest.mark.parametrize("part", [0, 2, 4])
@pytest.mark.parametrize("repeatable", [False, True])
def test_outbox_sends_each_message_once(spark, scratch, part, repeatable):
    topics = FileTopics(f"{scratch}/topics")
    values = [f"v{i % 7}" for i in range(20)] + [None]

    def rows(salt=""):
        return spark.createDataFrame([("k", v and v + salt) for v in values], schemas.REPLY)

    def publish(place, batch_id, salt=""):
        Outbox(spark, place, f"{scratch}/outbox").publish(batch_id, lambda: rows(salt), "t", repeatable)

    with pytest.raises(ConnectionError):
        publish(Breaking(topics.root, part), 3)
    publish(topics, 3, "" if repeatable else " other")  # what was stored is sent, not this
    publish(topics, 3)
    publish(topics, 2)
    assert sorted(v or "" for _, v in replies(spark, topics, "t")) == sorted(v or "" for v in values)
    publish(topics, 4)
    assert len(replies(spark, topics, "t")) == 2 * len(values)


def test_replayed_copies_come_once(spark, scratch, name):
    topics, job = FileTopics(f"{scratch}/topics"), message_job(name)
    send(spark, topics, "ia_message", MESSAGES * 3)
    batch = topics.read(spark, "ia_message")
    with pytest.raises(ConnectionError):
        ingest_batch(batch, 7, job, Breaking(topics.root, 2), outbox=Outbox(spark, Breaking(topics.root, 2), f"{scratch}/o"))
    for _ in range(2):
        ingest_batch(batch, 7, job, topics, outbox=Outbox(spark, topics, f"{scratch}/o"))
    ids = [json.loads(v)["id"] for _, v in replies(spark, topics, f"{name}_save")]
    assert len(ids) == len(set(ids)) == 6 == read_table(spark, name).count()


def test_counts_are_those_of_what_is_stored(spark, scratch, name, monkeypatch):
    """As if tasks had run twice: what they saw is twice as much."""
    topics, job = FileTopics(f"{scratch}/topics"), message_job(name)
    send(spark, topics, "ia_message", MESSAGES)

    class Twice(ingest_module.Observation):
        @property
        def get(self):
            return {k: 2 * v for k, v in super().get.items()}

    monkeypatch.setattr(ingest_module, "Observation", Twice)
    counts = ingest_batch(topics.read(spark, "ia_message"), 0, job, topics)
    assert counts == {"valid": 2, "invalid": 2, "tombstones": 1, "total": 5}


def test_each_requester_gets_its_own_answer(spark, scratch, name):
    topics = FileTopics(f"{scratch}/topics")
    user_table(spark, name)
    right, wrong = '{"email":"a@x.com","password":"pw1"}', '{"email":"a@x.com","password":"no"}'
    for key, value in (("a", right), ("b", wrong), ("c", "not json"), ("d", wrong), ("d", right), (None, wrong), ("e", None)):
        send(spark, topics, "send_users", [value], key=key)

    def ask(checkpoint):
        start_responder(spark, topics, "send_users", "get_users", users_reply(name), checkpoint, available_now=True).awaitTermination()
        return dict(replies(spark, topics, "get_users"))

    got = ask(f"{scratch}/ckpt")
    error = {"error": "Utilisateur non trouvé"}
    assert all(json.loads(got[k]) == error for k in ("b", "c", "e", None))
    place = json.loads(got["a"])["reply"]
    assert json.loads(got["d"]) == {"reply": place}
    assert {u["nom"] for u in json.loads(got[place])} == {"Alice", "Bob"}
    assert "password" not in got[place] and len(got) == 7
    # One right requester gets the users under its own key, the others still their errors.
    send(spark, topics, "send_users", [wrong], key="f")
    send(spark, topics, "send_users", [right], key="g")
    got = ask(f"{scratch}/ckpt")
    assert json.loads(got["f"]) == error and {u["nom"] for u in json.loads(got["g"])} == {"Alice", "Bob"}


def message(n, text="t"):
    return (str(n) if n is not None else None, text, None, "u", "c", "")


def test_kept_status_is_the_full_join(spark, scratch):
    rnd = random.Random(2)
    sent = [message(rnd.randrange(40), rnd.choice("ab")) for _ in range(60)] + [message(None), message(None)]
    checked = [(str(rnd.randrange(50)), rnd.choice(["true", "false", None]), None) for _ in range(90)] + [(None, "true", None)]
    kept = ops.KeptStatus(spark, f"{scratch}/status", buckets=4)
    assert not kept.exists() and kept.read().count() == 0

    def frames(a, b):
        return (
            spark.createDataFrame(a, schemas.stored(schemas.MESSAGE)),
            spark.createDataFrame(b, schemas.MESSAGE_METADATA),
        )

    parts = [(sent[:0], checked[:20]), (sent[:50], checked[20:25]), (sent[50:], []), ([], checked[25:]), ([], [])]
    for n, (a, b) in enumerate(parts):
        kept.merge(*frames(a, b), run="r", batch_id=n)
        assert kept.merge(*frames(a, b), run="r", batch_id=n) == []

    def listed(df):
        one = df.groupBy(*[c for c in df.columns if c != "copies"]).agg(F.sum("copies").alias("copies"))
        return sorted(map(str, one.collect()))

    assert listed(ops.kept_status_counts(kept.read())) == listed(ops.status_counts(*frames(sent, checked)))


def test_status_is_merged_in_as_many_tasks_as_its_rows_need(spark, scratch, monkeypatch):
    """One task has some rows, however many there are and however small they are."""
    monkeypatch.setattr("palabre.operators.status.TASK_ROWS", 100)
    sent = [message(n % 300, "ab"[n % 2]) for n in range(900)] + [message(None, str(n)) for n in range(50)]
    checked = [(str(n % 350), ["true", "false", None][n % 3], None) for n in range(1400)]
    messages = spark.createDataFrame(sent, schemas.stored(schemas.MESSAGE))
    verdicts = spark.createDataFrame(checked, schemas.MESSAGE_METADATA)
    old = merge_status(spark.createDataFrame([], KEPT), messages, verdicts, tasks=23)
    assert old.rdd.getNumPartitions() >= 23
    kept = ops.KeptStatus(spark, f"{scratch}/status", buckets=3)
    for m, v in ((messages.limit(0), verdicts), (messages, verdicts.limit(0)), (messages, verdicts)):
        kept.merge(m, v)
    twice = ops.kept_status_counts(merge_status(old, messages, verdicts, tasks=7))

    def listed(df):
        return sorted(map(str, df.collect()))

    assert listed(ops.kept_status_counts(kept.read())) == listed(twice)
    both = messages.unionByName(messages), verdicts.unionByName(verdicts)
    whole = ops.status_counts(*both)
    one = whole.groupBy(*[c for c in whole.columns if c != "copies"]).agg(F.sum("copies").alias("copies"))
    assert listed(twice.select(*one.columns)) == listed(one)


def test_kept_status_writes_only_changed_buckets(spark, scratch):
    kept = ops.KeptStatus(spark, f"{scratch}/status", buckets=32)
    none = spark.createDataFrame([], schemas.MESSAGE_METADATA)
    many = spark.createDataFrame([message(i) for i in range(400)], schemas.stored(schemas.MESSAGE))
    assert len(kept.merge(many, none)) == 32
    before = kept._manifest.read()[1]["valid"]
    one = spark.createDataFrame([("7", "true", None)], schemas.MESSAGE_METADATA)
    [bucket] = kept.merge(many.limit(0), one)
    after = kept._manifest.read()[1]["valid"]
    assert {b for b in after if after[b] != before[b]} == {str(bucket)}
    rows = spark.read.parquet(f"{scratch}/status/version=2")
    assert rows.count() < 40 and {f.name for f in rows.schema} >= {"bucket", "verdicts"}
    # A merge that broke off before the manifest was replaced is not seen, and is made again.
    spark.createDataFrame([], f"{KEPT}, bucket int").write.partitionBy("bucket").parquet(f"{scratch}/status/version=3")
    assert kept.read().count() == 400
    kept.merge(many.limit(0), one)
    [row] = ops.kept_status_counts(kept.read()).filter("valide = 'true'").collect()
    assert (row.message_id, row.copies) == ("7", 2)
    with pytest.raises(ValueError):
        ops.KeptStatus(spark, f"{scratch}/status", buckets=8).merge(many, none)
    build = kept_messages_reply(kept, include_id=True, max_rows=1000)
    request = spark.createDataFrame([("r", "{}")], schemas.REPLY)
    [answer] = build(request, "r").collect()
    assert len(json.loads(answer.value)) == 401 and answer.key == "r"  # two verdicts on one
    plan = kept.read()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_a_reply_makes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(5000).repartition(3).mapInArrow(count, "id long")
    reply = ops.table_as_json(df, request_key="r", max_rows=100)
    assert reply.count() > 50 and reply.count() > 50
    assert seen.value == 5000


def test_stateful_registration(spark, scratch, name):
    topics = FileTopics(f"{scratch}/topics")
    spark.createDataFrame([("k@x",), (None,)], "email string").write.saveAsTable(f"{name}_known")

    def register(known, *records):
        send(spark, topics, "register", [json.dumps(r) if isinstance(r, dict) else r for r in records])
        start_stateful_registration(
            spark, topics, "register", name, f"{scratch}/ckpt", known=known, available_now=True, buckets=2
        ).awaitTermination()
        return sorted(r["nom"] for r in read_table(spark, name).collect())

    late = {"nom": "late", "email": "a@x", "date_inscription": "2024-01-02 00:00:00"}
    early = {"nom": "early", "email": "a@x", "date_inscription": "2024-01-01 00:00:00"}
    taken, nameless = {"nom": "taken", "email": "k@x"}, {"nom": "nameless"}
    assert register([f"{name}_known"], late, early, taken, nameless, "not json") == ["early"]
    # The state has the known e-mails: their table is needed no more, nor is the own one read.
    spark.sql(f"DROP TABLE {name}_known")
    other = {"nom": "other", "email": "b@x"}
    assert register([], late, taken, nameless, other, None) == ["early", "other"]
    assert [r["corrupt_record"] for r in read_table(spark, f"{name}_errors").collect()] == ["not json"]


def test_a_state_is_asked_once_for_many_emails():
    """All e-mails of a share are judged by one state, with two calls."""

    class Taken(list):
        calls = 0

        def get(self):
            Taken.calls += 1
            return iter(self)

        def appendValue(self, value):
            Taken.calls += 1
            self.append(value)

    class Handle:
        def getListState(self, name, schema):
            return taken

    taken, first = Taken(), FirstOfEmail(["n"])
    first.init(Handle())
    first.handleInitialState((1,), Row(_share=1, emails=["e0", "e1"]), None)
    rows = [Row(_email=f"e{i}", n=n) for n in (2, None, 1) for i in range(500)]
    assert {(r._email, r.n) for r in first.handleInputRows((1,), iter(rows), None)} == {(f"e{i}", None) for i in range(2, 500)}
    assert Taken.calls == 3
    assert list(first.handleInputRows((1,), iter(rows), None)) == []
    assert [r._email for r in first.handleInputRows((1,), iter([Row(_email="x", n=1)]), None)] == ["x"]


def test_models_are_promoted_by_held_out_messages(spark, scratch):
    words = [("urgent now", "inapproprié"), ("all calm", "approprié")]
    rows = [(str(i), words[i % 2][0] + f" {i}", words[i % 2][1]) for i in range(200)]
    labelled = spark.createDataFrame(rows, "id string, message string, type string")
    models = ops.ModelStore(spark, f"{scratch}/models")
    with pytest.raises(ValueError):
        models.classify(labelled)
    first, promoted, score = models.train(labelled)
    assert promoted and score > 0.9 and models.current() == first
    # Trained on labels that are the wrong way round, and judged by the right ones, it stays behind.
    swapped = labelled.withColumn(
        "type", F.when((F.pmod(F.xxhash64("id"), F.lit(5)) == 0) == (F.col("type") == "approprié"), "approprié").otherwise("inapproprié")
    )
    _, promoted, score = models.train(swapped)
    assert not promoted and score < 0.5 and models.current() == first
    got = {r.id: r.type for r in models.classify(labelled.withColumn("type", F.lit(""))).collect()}
    assert sum(got[r[0]] == r[2] for r in rows) > 190


def test_routes_change_and_unrouted_records_are_counted(spark, scratch):
    topics = FileTopics(f"{scratch}/topics")
    routes = RouteTable(spark, f"{scratch}/routes", {"a": ["x"], "b": []})
    assert RouteTable(spark, f"{scratch}/routes", {"a": ["z"]})() == {"a": ["x"], "b": []}
    rows = spark.createDataFrame([("k", "1", "a"), ("k", "2", "b"), ("k", "3", "c")], "key string, value string, topic string")
    outbox = Outbox(spark, topics, f"{scratch}/outbox")
    assert route_batch(rows, 0, routes(), outbox, changing=True) == {"records": 3, "unrouted": 2}
    routes.change({"a": None, "c": ["x", "y"]})
    assert route_batch(rows, 0, routes(), outbox, changing=True)["unrouted"] == 2
    assert route_batch(rows, 1, routes(), outbox, changing=True) == {"records": 3, "unrouted": 2}
    assert route_batch(rows, 2, {}, outbox) == {"records": 3, "unrouted": 3}
    assert sorted(v for _, v in replies(spark, topics, "x")) == ["1", "3"]
    assert [v for _, v in replies(spark, topics, "y")] == ["3"]
