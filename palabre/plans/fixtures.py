"""The data model's tables, viewed over the generated test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palabre.functions.values import format_time
from palabre.schemas import IA_MESSAGE
from palabre.sources.files import spread

# Fixed value: 2024-01-01 00:00:00 UTC, the origin of made-up times.
EPOCH = 1_704_067_200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as stored messages."""
    return table(spark, sf_dir, "documents").select(
        text("doc_id").alias("id"),
        F.col("text").alias("message"),
        F.timestamp_seconds(F.col("doc_id") + EPOCH).alias("Created_At"),
        F.col("source").alias("user_id"),
        F.col("lang").alias("chat_id"),
        F.lit("").alias("type"),
    )


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as moderation verdicts on the documents."""
    return table(spark, sf_dir, "labels").select(
        text("doc_id").alias("id_message"),
        F.when(F.col("toxic") == 0, "true").otherwise("false").alias("valide"),
        F.timestamp_seconds(F.col("doc_id") + EPOCH).alias("date"),
    )


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages, for messages with several verdicts."""
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("message"),
        F.col("o_orderdate").cast("timestamp").alias("Created_At"),
        text("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("chat_id"),
        F.lit("").alias("type"),
    )


def line_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as verdicts on the orders."""
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("id_message"),
        F.when(F.col("l_returnflag") == "R", "false").otherwise("true").alias("valide"),
        F.col("l_shipdate").cast("timestamp").alias("date"),
    )


def email(key: str) -> Column:
    return F.concat(F.lit("customer."), F.lpad(text(key), 9, "0"), F.lit("@example.com"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("nom"),
        email("c_custkey").alias("email"),
        F.concat(F.lit("pass"), text("c_custkey")).alias("password"),
        F.timestamp_seconds(F.col("c_custkey") + EPOCH).alias("date_inscription"),
    )


def credentials(spark: SparkSession, sf_dir: str, word: str = "pass") -> DataFrame:
    """The customer of each order logs in, with a wrong password for open orders."""
    right = F.when(F.col("o_orderstatus") == "O", "no").otherwise(word)
    return table(spark, sf_dir, "orders").select(
        email("o_custkey").alias("email"), F.concat(right, text("o_custkey")).alias("password")
    )


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order registers its customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request"),
        F.col("o_orderpriority").alias("nom"),
        email("o_custkey").alias("email"),
        F.col("o_orderdate").cast("timestamp").alias("date_inscription"),
    )


def known_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    building = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return building.select(email("c_custkey").alias("email"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("produit_id"),
        F.col("p_name").alias("nom"),
        F.col("p_brand").alias("categorie"),
        F.col("p_retailprice").alias("prix"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("int").alias("achat_id"),
        F.col("l_partkey").cast("int").alias("produit_id"),
        format_time(F.col("l_shipdate")).alias("date_achat"),
        F.col("l_suppkey").cast("int").alias("client_id"),
        F.col("l_quantity").cast("int").alias("quantite"),
        F.col("l_extendedprice").alias("montant_total"),
    )


def _json_text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def message_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic records, in the shapes that producers send.

    Clicks are complete; views spell the time's name differently; purchases have
    a number for a text and a bad time; signups lack the text; errors are cut
    off; the records of users below 10 have no value.
    """
    user, event, time = F.col("user_id"), F.col("event_id"), format_time(F.col("ts"))
    rest = ',"chat_id":"0","type":""}'
    raw = (
        F.when(user < 10, F.lit(None))
        .when(
            F.col("event_type") == "click",
            _json_text('{"message":"click ', event, '","Created_At":"', time, '","user_id":"', user, '"', rest),
        )
        .when(
            F.col("event_type") == "view",
            _json_text('{"message":"view ', event, '","created_at":"', time, '","user_id":"', user, '"', rest),
        )
        .when(
            F.col("event_type") == "purchase",
            _json_text('{"message":', event, ',"Created_At":"nope","user_id":', user, rest),
        )
        .when(F.col("event_type") == "signup", _json_text('{"user_id":"', user, '"', rest))
        .otherwise(_json_text('{"message":"error ', event, '","user_id":"', user))
    )
    return spread(table(spark, sf_dir, "events")).select(
        F.lit(None).cast("binary").alias("key"),
        raw.cast("binary").alias("value"),
        F.lit(IA_MESSAGE).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def product_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as topic records; large parts carry their number as text."""
    number = F.col("p_partkey").cast("string")
    raw = _json_text(
        '{"produit_id":',
        F.when(F.col("p_size") > 40, _json_text('"', number, '"')).otherwise(number),
        ',"nom":"', F.col("p_name"), '","categorie":"', F.col("p_brand"),
        '","prix":', F.col("p_retailprice"), "}",
    )
    return table(spark, sf_dir, "part").select(raw.alias("raw_data"))


def purchase_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as topic records; returned ones lack the purchase number."""
    number = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    raw = _json_text(
        "{",
        F.when(F.col("l_returnflag") == "R", "").otherwise(_json_text('"achat_id":', number, ",")),
        '"produit_id":', F.col("l_partkey"),
        ',"date_achat":"', format_time(F.col("l_shipdate")),
        '","client_id":', F.col("l_suppkey"),
        ',"quantite":', F.col("l_quantity").cast("int"),
        ',"montant_total":', F.col("l_extendedprice"),
        ',"produit_details":{"produit_id":', F.col("l_partkey"), "}}",
    )
    return spread(table(spark, sf_dir, "lineitem")).select(raw.alias("raw_data"))


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as user records of the retail job; errors lack the user number."""
    raw = _json_text(
        "{",
        F.when(F.col("event_type") == "error", "").otherwise(
            _json_text('"user_id":', F.col("user_id"), ",")
        ),
        '"nom":"', F.col("event_type"), '","email":"e', F.col("event_id"),
        '@example.com","date_inscription":"', format_time(F.col("ts")), '"}',
    )
    return spread(table(spark, sf_dir, "events")).select(
        raw.alias("raw_data"), F.col("ts").cast("timestamp").alias("timestamp")
    )
