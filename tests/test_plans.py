"""The plans Spark makes of the operators."""

from __future__ import annotations

import re
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from palabre import operators as ops
from palabre import schemas
from palabre.plans import fixtures as fx
from palabre.plans import platform
from palabre.plans.queries import QUERIES
from palabre.sources import read_table, write_batch
from tests.oracle import SF_DIR


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize(
    "key",
    [k for k in sorted(QUERIES) if not k.startswith("classify_with") and "stream" not in k],
)
def test_no_python_and_no_cross_join(spark, key):
    plan = QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_each_record_is_parsed_once(spark):
    records = fx.purchase_records(spark, SF_DIR)
    valid = ops.ingest_json(records, schemas.ACHAT, key="achat_id", with_id=False).valid
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"from_json", plan)) == 1


def test_price_filter_reaches_the_scan(spark):
    plan = QUERIES["products_min_price"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(p_retailprice,950.0)" in plan


def test_scan_reads_only_the_columns_used(spark):
    plan = QUERIES["message_status_counts"](spark, SF_DIR)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in text and "l_comment" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def test_verdicts_are_counted_before_the_join(spark, no_broadcast):
    messages, verdicts = fx.order_messages(spark, SF_DIR), fx.line_verdicts(spark, SF_DIR)
    plan = final_plan(ops.messages_with_status(messages, verdicts))
    assert plan.count("SortMergeJoin") == 1
    assert "partial_count" in plan


def test_left_join_counts_nothing_and_has_no_outer_join(spark, no_broadcast):
    plan = final_plan(QUERIES["messages_raw_left_join"](spark, SF_DIR))
    assert plan.count("SortMergeJoin") == 2 and "LeftOuter" not in plan and "count" not in plan
    assert "Broadcast" not in plan


def test_registration_cuts_before_the_shuffle(spark):
    plan = QUERIES["register_unique"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_bucketed_tables_join_without_a_shuffle(spark, no_broadcast):
    plan = final_plan(QUERIES["bucketed_roundtrip"](spark, SF_DIR))
    assert "Bucketed: true" in plan
    assert "Exchange hashpartitioning(id" not in plan


def test_small_credentials_are_broadcast(spark):
    users, credentials = fx.users(spark, SF_DIR), fx.credentials(spark, SF_DIR)
    matches = ops.login_matches(users, F.broadcast(credentials))
    plan = matches._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_existence_stops_at_the_first_match(spark):
    plan = QUERIES["branch_on_match"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "CollectLimit 1" in plan


def test_chat_tables_join_without_a_shuffle(spark, no_broadcast, scratch):
    """In the layout that the chat's own jobs create, neither side moves."""
    tables = []
    for job, rows in (
        (platform.MESSAGES, fx.messages(spark, SF_DIR)),
        (platform.METADATA, fx.verdicts(spark, SF_DIR).withColumn("id", F.col("id_message"))),
    ):
        name = f"t_{uuid.uuid4().hex[:12]}"
        job = replace(job, table=name, buckets=4, location=f"{scratch}/{name}")
        job.create_table(spark)
        write_batch(rows, name, 0, cluster_by=job.bucket_by)
        tables.append(read_table(spark, name))
    plan = final_plan(ops.messages_with_status(*tables))
    assert plan.count("Bucketed: true") >= 2 and "SortMergeJoin" in plan
    assert "Exchange hashpartitioning(id" not in plan
