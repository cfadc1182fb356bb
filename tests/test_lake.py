"""Landing CSV -> typed read -> partitioned ORC -> catalog round trip, the
positional-shift guard, partition discovery and pruning, CTAS, report sink."""

import glob
import os
import re
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from riskloom import schema as S
from riskloom.plans import lake
from riskloom.sources import landing, warehouse
from riskloom.sources.tables import conform, load_domain


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def built(spark):
    root = tempfile.mkdtemp(prefix="riskloom-lake-")
    dom = load_domain(spark, SF001)
    paths = lake.land(dom, root)
    db = "risk_" + uuid.uuid4().hex[:8]
    return dom, lake.build_lake(spark, paths, root, db), db, root, paths


def test_roundtrip_equals_input(built):
    dom, back, _, _, _ = built
    for t, a, b in [("customer_profiles", dom.customers, back.customers),
                    ("loan_applications", dom.loans, back.loans),
                    ("transactions", dom.txns, back.txns)]:
        assert conform(a, t).dtypes == b.dtypes
        assert _rows(conform(a, t)) == _rows(b), t


def test_partitions_discovered_and_pruned(spark, built):
    _, back, db, root, _ = built
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS `{db}`.`loan_applications`").collect()}
    years = {r[0] for r in back.loans.select(S.PARTITION_COLUMN).distinct().collect()}
    assert parts == {f"{S.PARTITION_COLUMN}={y}" for y in years}
    assert glob.glob(f"{root}/tables/loan_applications/load-*/{S.PARTITION_COLUMN}={min(years)}")
    q = spark.table(f"{db}.loan_applications").where(F.col(S.PARTITION_COLUMN) == min(years))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(disbursement_year" in plan
    assert q.count() == back.loans.where(F.col(S.PARTITION_COLUMN) == min(years)).count()


def test_catalog_inspection(spark, built):
    _, _, db, _, _ = built
    names = set(warehouse.list_tables(spark, db))
    assert {"customer_profiles", "loan_applications", "transactions", "transactions_raw"} <= names
    info = {r[0]: r[1] for r in warehouse.describe(spark, f"{db}.transactions").collect()}
    assert info.get("Provider", "").lower() == "orc"
    raw = spark.table(f"{db}.transactions_raw")
    assert raw.count() == spark.table(f"{db}.transactions").count()  # no header row leaks in
    assert raw.where("transaction_id = 'transaction_id'").count() == 0


def test_reports_run_on_the_lake(spark, built):
    from riskloom.plans import portfolio

    dom, back, _, _, _ = built
    assert _rows(portfolio.portfolio_by_loan_type(back.loans)) == \
        _rows(portfolio.portfolio_by_loan_type(dom.loans))


def test_header_order_is_checked(spark, built):
    """A loan CSV whose header does not match the declared file order is refused,
    never read with shifted columns."""
    dom, _, _, root, _ = built
    shifted = f"{root}/landing/shifted"
    cols = [f.name for f in S.LOAN_APPLICATIONS]
    moved = cols[:7] + cols[8:] + [cols[7]]  # partition column last, as in the DDL
    dom.loans.select(*moved).write.mode("overwrite").option("header", True).csv(shifted)
    with pytest.raises(Exception):
        landing.read_landing(spark, shifted, "loan_applications", mode="FAILFAST").collect()


def test_empty_landing_file_reads_as_no_rows(spark):
    d = tempfile.mkdtemp(prefix="riskloom-empty-")
    with open(f"{d}/part.csv", "w") as fh:
        fh.write("\r\n")
    assert landing.read_landing(spark, d, "transactions").count() == 0


def test_report_csv_sink(spark):
    from riskloom.plans import credit

    d = tempfile.mkdtemp(prefix="riskloom-sink-") + "/out"
    rep = credit.gross_npa_rate(load_domain(spark, SF001).loans)
    warehouse.write_report_csv(rep, d)
    files = [f for f in os.listdir(d) if f.endswith(".csv")]
    assert len(files) == 1
    back = spark.read.option("header", True).csv(d)
    assert back.columns == rep.columns and back.count() == rep.count()


def test_year_argument_prunes_partitions(spark, built):
    from riskloom.plans import credit

    _, back, db, _, _ = built
    loans = spark.table(f"{db}.loan_applications")
    years = sorted(r[0] for r in loans.select(S.PARTITION_COLUMN).distinct().collect())[:2]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    rep = credit.vintage_default_rate(loans, years=years)
    plan = rep._jdf.queryExecution().executedPlan().toString()
    part_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "disbursement_year" in part_filters and " IN (" in part_filters, part_filters
    assert [r.disbursement_year for r in rep.collect()] == years


def test_bucketed_lake_joins_without_shuffling_the_tables(spark):
    """Customers and loans bucketed on customer_id: the per-customer
    aggregation and the join read co-located buckets, so no exchange
    repartitions either table on customer_id; results are unchanged."""
    from riskloom.plans import portfolio, trends

    dom = load_domain(spark, SF001)
    root = tempfile.mkdtemp(prefix="riskloom-bucket-")
    db = "bkt_" + uuid.uuid4().hex[:8]
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle-join plan shape
    try:
        back = lake.build_lake(spark, lake.land(dom, root), root, db, buckets=4)
        for report in (lambda d: portfolio.segment_concentration(d.loans, d.customers),
                       lambda d: portfolio.geographic_concentration(d.loans, d.customers),
                       lambda d: trends.customer_exposure(d.loans, d.customers)):
            df = report(back)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"hashpartitioning\([^)]*customer_id", plan), plan
            assert _rows(df) == _rows(report(dom))
        from riskloom.plans import aml

        for report in (lambda d: aml.aml_reversals(d.txns),
                       lambda d: aml.aml_structuring_txn_only(d.txns)):
            df = report(back)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(loan_id" not in plan, plan
            assert _rows(df) == _rows(report(dom))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_report_runner_writes_one_folder_per_report(spark):
    from riskloom.__main__ import main

    out = tempfile.mkdtemp(prefix="riskloom-run-") + "/reports"
    assert main(["--sf-dir", SF001, "--out", out, "--reports", "kri_master,dpd_buckets"]) == 0
    assert sorted(os.listdir(out)) == ["dpd_buckets", "kri_master"]
    back = spark.read.option("header", True).csv(f"{out}/kri_master")
    assert back.count() == 6 and back.columns == ["kri_name", "kri_value", "unit"]
    assert main(["--sf-dir", SF001, "--out", out, "--reports", "no_such_report"]) == 2


def test_partitions_visible_only_after_recovery(spark, built):
    """A partitioned external table over existing year directories shows no
    rows until its partitions are registered (MSCK REPAIR TABLE)."""
    _, back, db, root, _ = built
    name = f"{db}.loans_unrepaired"
    warehouse.register_table(spark, name, warehouse.location_of(spark, f"{db}.loan_applications"),
                             warehouse.schema_ddl("loan_applications"), partition_by=[S.PARTITION_COLUMN])
    assert spark.table(name).count() == 0
    warehouse.recover_partitions(spark, name)
    assert spark.table(name).count() == back.loans.count() > 0


def _files(root, table):
    return glob.glob(f"{root}/tables/{table}/load-*/**/part-*", recursive=True)


def test_second_load_replaces_all_tables(spark):
    dom = load_domain(spark, SF001)
    db = "again_" + uuid.uuid4().hex[:8]
    root = tempfile.mkdtemp(prefix="riskloom-again-")
    for buckets in (None, 3):
        for keep in (0, 1):
            half = type(dom)(*[t.where(F.crc32(t.columns[0]) % 2 <= keep) for t in (dom.customers, dom.loans, dom.txns)])
            back = lake.build_lake(spark, lake.land(half, root), root, db, buckets=buckets)
            for a, b in [(half.customers, back.customers), (half.loans, back.loans), (half.txns, back.txns)]:
                assert b.count() == a.count() > 0
            for t in S.SCHEMAS:  # the files that were replaced are gone
                assert len(glob.glob(f"{root}/tables/{t}/load-*")) == 1


@pytest.mark.parametrize("tasks", [20])
def test_number_of_files_does_not_follow_the_tasks(spark, tasks):
    dom = load_domain(spark, SF001)
    dom = type(dom)(dom.customers.repartition(tasks), dom.loans.repartition(tasks), dom.txns.repartition(tasks))
    years = dom.loans.select("disbursement_year").distinct().count()
    for buckets in (None, 4):
        root = tempfile.mkdtemp(prefix="riskloom-files-")
        lake.build_lake(spark, lake.land(dom, root), root, "files_" + uuid.uuid4().hex[:8], buckets=buckets)
        assert len(_files(root, "loan_applications")) <= years * (buckets or 1) + (0 if buckets else 2)
        if buckets:
            assert len(_files(root, "transactions")) <= buckets


def test_malformed_rows_are_kept_and_quarantined(spark):
    dom = load_domain(spark, SF001)
    root = tempfile.mkdtemp(prefix="riskloom-bad-")
    paths = lake.land(dom, root)
    with open(f"{paths['transactions']}/part-zz.csv", "w") as f:
        f.write(",".join(S.SCHEMAS["transactions"].names) + "\n")
        f.write("B1,LN1,NEFT,abc,ATM,2021,1,2,0,0,S\nB2,LN1,NEFT,5.0\n")
    db = "bad_" + uuid.uuid4().hex[:8]
    back = lake.build_lake(spark, paths, root, db)
    assert back.txns.count() == dom.txns.count() + 2
    assert {r.transaction_id: (r.amount, r.channel) for r in back.txns.where("transaction_id in ('B1', 'B2')").collect()} == \
        {"B1": (None, "ATM"), "B2": (5.0, None)}
    assert lake.rejected(spark, db) == {"customer_profiles": 0, "loan_applications": 0, "transactions": 2}
    assert {r.raw_line for r in spark.table(f"{db}.transactions_rejected").collect()} == \
        {"B1,LN1,NEFT,abc,ATM,2021,1,2,0,0,S", "B2,LN1,NEFT,5.0"}
