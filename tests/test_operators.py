"""Operator-level checks: joins by measured size, predicate pushdown on physical
tables, partial aggregation on hot keys, intermediate tables."""

import os
import shutil
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from riskloom import session
from riskloom.plans import aml, lake
from riskloom.plans.registry import all_queries
from riskloom.sources.tables import load_domain


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for k, v in options.items():
            k = "spark.sql." + k.replace("__", ".")
            before.setdefault(k, spark.conf.get(k))
            spark.conf.set(k, v)

    yield put
    for k, v in before.items():
        spark.conf.set(k, v)


def test_aml_without_broadcasts_is_identical(spark, conf):
    dom = load_domain(spark, SF001)
    base = sorted(tuple(r) for r in aml.aml_structuring(dom.txns, dom.loans, dom.customers).collect())
    conf(autoBroadcastJoinThreshold="-1")
    got = sorted(tuple(r) for r in aml.aml_structuring(dom.txns, dom.loans, dom.customers).collect())
    assert got == base and base


def test_wide_flagged_rows_are_not_broadcast(spark, conf):
    """The flagged side is judged by its real size: 3,000 ids of 2 KB are over a 100 KB
    threshold, however few columns and rows that is."""
    dom = load_domain(spark, SF001)
    wide = lambda c: F.concat(F.col(c), *[F.sha2(F.concat(F.col(c), F.lit(i)), 512) for i in range(16)])
    loans = session.materialize(dom.loans.limit(3000).withColumn("loan_id", wide("loan_id")), "wide-loans")
    txns = dom.txns.limit(0).union(loans.select(
        F.col("loan_id").alias("transaction_id"), "loan_id", F.lit("Cash_Withdrawal"), F.lit(200000.0), F.lit("ATM"),
        F.lit(2021), F.lit(1), F.lit(1), F.lit(1), F.lit(0), F.lit("S")))
    conf(autoBroadcastJoinThreshold="100k")
    seen = []
    real = session.save_scratch

    def watch(df, name):
        out = real(df, name)
        if name == "flagged-loans":
            seen.append(_plan(df))
        return out

    session.save_scratch = watch
    try:
        aml.aml_structuring(txns, loans, dom.customers, min_txns=1).collect()
    finally:
        session.save_scratch = real
    assert seen and "BroadcastHashJoin" not in seen[0]


def test_filters_reach_the_scan_on_physical_tables(spark):
    dom = load_domain(spark, SF001)
    root = tempfile.mkdtemp(prefix="riskloom-push-")
    back = lake.build_lake(spark, lake.land(dom, root), root, "push_" + uuid.uuid4().hex[:8])
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = _plan(aml.aml_structuring_txn_only(back.txns))
    scan = [line for line in plan.split("\n") if "FileScan orc" in line][0]
    for needle in ["EqualTo(is_suspicious_flag,1)", "EqualTo(transaction_type,Cash_Withdrawal)",
                   "GreaterThan(amount,100000.0)"]:
        assert needle in scan, scan
    assert "ReadSchema: struct<transaction_id:string,loan_id:string,transaction_type:string," \
           "amount:double,is_suspicious_flag:int>" in scan


def test_hot_key_is_pre_aggregated(spark):
    """A loan holding a third of all transactions: the reversal report still
    aggregates map-side before the shuffle (partial + final aggregate)."""
    dom = load_domain(spark, SF001)
    hot = dom.txns.withColumn("loan_id", F.when(F.rand(7) < 0.34, F.lit("HOT")).otherwise(F.col("loan_id")))
    plan = _plan(aml.aml_reversals(hot))
    assert "partial_count" in plan and "partial_sum" in plan


def test_sizing_helpers():
    from riskloom.session import partitions_for

    assert partitions_for(0) == 8
    assert partitions_for(100 * (1 << 40)) == 1 << 19  # 100 TiB at 200 MiB per partition


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.ensure_checkpoint_dir(Cluster)


def test_scratch_can_be_released(spark):
    df, path = session.save_scratch(spark.range(5), "release")
    local = path.removeprefix("file:")
    assert df.count() == 5 and os.path.isdir(local)
    session.release_scratch(spark)
    assert not os.path.exists(local)


def test_new_files_are_seen(spark):
    """No listing is kept: a second file doubles the counts."""
    folder = tempfile.mkdtemp(prefix="riskloom-append-")
    for t in ("customer", "nation", "orders", "lineitem"):
        os.makedirs(f"{folder}/{t}.parquet")
        shutil.copy(f"{SF001}/{t}.parquet", f"{folder}/{t}.parquet/part-0.parquet")
    total = lambda: sum(r.total_transactions for r in all_queries()["channel_risk"](spark, folder).collect())
    first = total()
    shutil.copy(f"{SF001}/lineitem.parquet", f"{folder}/lineitem.parquet/part-1.parquet")
    assert total() == 2 * first
