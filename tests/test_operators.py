from __future__ import annotations

from collections import Counter
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from palabre import operators as ops
from palabre import schemas
from palabre.functions import amount, label_of, parse_time

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def message_rows(spark, *ids):
    rows = [(i, f"text {i}", T1, "u", "c", "") for i in ids]
    return spark.createDataFrame(rows, schemas.stored(schemas.MESSAGE))


def verdict_rows(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.MESSAGE_METADATA)


def expected_status(ids, verdicts):
    result = Counter()
    for i in ids:
        found = [v for m, v, _ in verdicts if m is not None and m == i]
        result.update((i, v or "false") for v in found or [None])
    return result


IDS = ["1", "2", "3", "4", None, None]
VERDICTS = [
    ("1", "true", T1),
    ("2", "true", T1),
    ("2", "false", T2),
    ("2", "true", T1),
    ("3", None, T1),
    ("9", "true", T1),
    (None, "true", T1),
] + [("4", "true", T1)] * 25


@pytest.mark.parametrize("many", [1, 2, 7, 100_000])
def test_messages_with_status(spark, many):
    df = ops.messages_with_status(
        message_rows(spark, *IDS), verdict_rows(spark, *VERDICTS), many=many
    )
    assert df.columns == ["message_id", *schemas.MESSAGE_WITH_STATUS.names]
    got = Counter((r["message_id"], r["valide"]) for r in df.collect())
    assert got == expected_status(IDS, VERDICTS)


def test_latest_verdict(spark):
    rows = [("1", "true", T1), ("1", "false", T2), ("2", "false", T1), ("2", "true", T2)]
    df = ops.messages_with_status(
        message_rows(spark, "1", "2", "3"), verdict_rows(spark, *rows), latest_only=True
    )
    got = {r["message_id"]: r["valide"] for r in df.collect()}
    assert got == {"1": "false", "2": "true", "3": "false"}


def test_status_counts(spark):
    df = ops.status_counts(message_rows(spark, *IDS), verdict_rows(spark, *VERDICTS))
    got = Counter()
    for r in df.collect():
        got[(r["message_id"], r["valide"])] += r["copies"]
    assert got == expected_status(IDS, VERDICTS)


def test_left_join_is_whole(spark):
    left = spark.createDataFrame([(i, f"l{i}") for i in IDS], "id string, l string")
    right = spark.createDataFrame([(m, v) for m, v, _ in VERDICTS], "key string, v string")
    df = ops.left_join(left, right, "id", "key")
    plain = left.join(right, left.id == right.key, "left")
    assert df.columns == plain.columns
    assert Counter(map(tuple, df.collect())) == Counter(map(tuple, plain.collect()))


def test_messages_left_join_prefixes_metadata(spark):
    df = ops.messages_left_join(message_rows(spark, *IDS), verdict_rows(spark, *VERDICTS))
    assert df.columns[-3:] == ["metadata_id_message", "metadata_valide", "metadata_date"]
    unjudged = df.filter("metadata_id_message IS NULL").collect()
    assert [r["id"] for r in unjudged] == [None, None]


def user_rows(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.USER)


@pytest.mark.parametrize(
    "tried, found",
    [
        ([("a@x", "pa")], 2),
        ([("a@x", "pb"), ("b@x", "pb")], 2),
        ([("a@x", "pb")], 0),
        ([(None, None), ("c@x", None)], 0),
        ([], 0),
    ],
)
def test_users_if_authenticated(spark, tried, found):
    users = user_rows(spark, ("A", "a@x", "pa", T1), ("B", "b@x", "pb", T1))
    credentials = spark.createDataFrame(tried, schemas.USER_LOGIN)
    df = ops.users_if_authenticated(users, credentials)
    assert df.columns == ["nom", "email", "date_inscription"]
    assert df.count() == found
    assert "password" in ops.users_if_authenticated(users, credentials, ["password"]).columns


def test_null_password_never_matches(spark):
    users = user_rows(spark, ("A", "a@x", None, T1))
    credentials = spark.createDataFrame([("a@x", None)], schemas.USER_LOGIN)
    assert ops.users_if_authenticated(users, credentials).count() == 0


def test_register_unique(spark):
    new = user_rows(
        spark,
        ("late", "a@x", "p", T2),
        ("early", "a@x", "p", T1),
        ("known", "k@x", "p", T1),
        ("nobody", None, "p", T2),
        ("blank", "", "p", T1),
    )
    existing = user_rows(spark, ("old", "k@x", "p", T1), ("old", "k@x", "p", T1))
    df = ops.register_unique(new, existing)
    assert df.columns == schemas.USER.names
    assert sorted(r["nom"] for r in df.collect()) == ["blank", "early"]


def test_normalize_message(spark):
    now = F.lit("2024-05-06 07:08:09").cast("timestamp")
    df = spark.createDataFrame(
        [(1, "u", None), (2, None, "hi")], "n int, user_id string, message string"
    )
    rows = sorted(map(tuple, ops.normalize_message(df, ["n"], now).drop("id").collect()))
    assert rows == [
        ("", "hi", "", "0", "2024-05-06 07:08:09"),
        ("u", "", "", "0", "2024-05-06 07:08:09"),
    ]
    bare = ops.normalize_message(spark.range(1), ["id"]).first()
    assert (bare["user_id"], bare["message"]) == ("", "")


def test_route(spark):
    df = spark.createDataFrame(
        [("ia_message",), ("send_message",), ("other",), (None,)], "topic string"
    )
    got = Counter(map(tuple, ops.route(df).collect()))
    assert got == Counter(
        [
            ("ia_message", "spark"),
            ("ia_message", "backend"),
            ("send_message", "classifier"),
            ("other", None),
            (None, None),
        ]
    )
    assert ops.route(df, {"other": ["x"]}).filter("destination = 'x'").count() == 1


def test_label_of_takes_the_first_of_equal_scores(spark):
    df = spark.createDataFrame(
        [([0.1, 0.9],), ([0.9, 0.1],), ([0.5, 0.5],), (None,)], "scores array<double>"
    )
    labels = [r[0] for r in df.select(label_of(F.col("scores"), schemas.MESSAGE_LABELS)).collect()]
    assert labels == ["approprié", "inapproprié", "inapproprié", None]


def test_pandas_scorer(spark):
    def load():
        return lambda texts: texts.map(lambda t: [float("moche" in (t or "")), 0.5])

    df = spark.createDataFrame([("t'es moche",), ("bonjour",), (None,)], "message string")
    out = ops.classify_messages(df, ops.pandas_scorer(load))
    assert [r["type"] for r in out.collect()] == ["inapproprié", "approprié", "approprié"]
    assert isinstance(load()(pd.Series(["a"])), pd.Series)


def test_train_classifier(spark):
    bad, good = schemas.MESSAGE_LABELS
    labelled = spark.createDataFrame(
        [("t'es moche", bad), ("moche et bête", bad), ("très joli", good), ("c'est joli", good)]
        * 5
        + [("moche", "unknown"), (None, bad)],
        "message string, type string",
    )
    model = ops.train_classifier(labelled, features=1 << 10)
    df = spark.createDataFrame(
        [(1, "MOCHE", ""), (2, "joli", ""), (3, None, "")], "n int, message string, type string"
    )
    out = ops.classify_with_model(df, model)
    assert out.columns == df.columns
    rows = {r["n"]: r for r in out.collect()}
    assert rows[1]["type"] == bad and rows[2]["type"] == good
    assert rows[3]["message"] is None and rows[3]["type"] in (bad, good)


PRODUCTS = [
    (1, "Smartphone", "Electronique", 599.99),
    (2, "Laptop", "Electronique", 1299.99),
    (3, "Casque audio", "Accessoires", 149.99),
    (4, "Livre", "Culture", 19.99),
    (5, "Chaussures de sport", "Mode", 89.99),
]


def test_purchases(spark):
    products = spark.createDataFrame(PRODUCTS, schemas.PRODUIT)
    rows = [
        (10, 4, "d", 1, 3, 59.97),
        (11, 1, "d", 1, 5, 2999.95),
        (12, 2, "d", 1, 2, 1.0),
        (13, 9, "d", 1, 2, 1.0),
        (14, 3, "d", 1, 1, None),
    ]
    purchases = spark.createDataFrame(rows, schemas.ACHAT)
    out = {r["achat_id"]: r for r in ops.enrich_purchases(purchases, products).collect()}
    assert set(out) == {10, 11, 12, 14}
    assert out[10]["montant_total"] == 59.97 and out[11]["montant_total"] == 2999.95
    assert out[12]["produit_details"]["nom"] == "Laptop"
    assert ops.enrich_purchases(purchases, products, how="left").count() == 5
    wrong = ops.amount_mismatches(purchases, products).collect()
    assert sorted((r["achat_id"], r["montant_attendu"]) for r in wrong) == [
        (12, 2599.98),
        (14, 149.99),
    ]


def test_amount_rounds_to_cents(spark):
    got = spark.range(1).select(amount(F.lit(19.999), F.lit(3))).first()[0]
    assert got == 60.0


def test_branch_and_filter_on_price(spark):
    products = spark.createDataFrame(PRODUCTS, schemas.PRODUIT)
    assert ops.filter_min_price(products).count() == 0
    assert ops.filter_min_price(products, 599.99).count() == 2
    dear = F.col("prix") >= 2000
    assert ops.branch_on_match(products, dear).first()["branch"] == "action2"
    more = products.union(spark.createDataFrame([(6, "TV", "E", 2000.0)], schemas.PRODUIT))
    assert ops.branch_on_match(more, dear).first()["branch"] == "action1"


def test_preview_is_ordered(spark):
    products = spark.createDataFrame(PRODUCTS, schemas.PRODUIT)
    rows = ops.preview_table(products, ["prix"], 2).collect()
    assert [r["produit_id"] for r in rows] == [4, 5]


def test_producer_time_zone(spark):
    df = spark.createDataFrame([("2024-07-01 12:00:00",), ("x",)], "t string")
    got = [r[0] for r in df.select(parse_time(F.col("t"), "Europe/Paris")).collect()]
    assert got == [datetime(2024, 7, 1, 10), None]
