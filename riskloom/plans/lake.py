"""Landing zone -> analytic tables (the ingestion pipeline).

1. landing CSV files with a header, columns in file order;
2. typed CSV reads (declared schema, header checked against it);
3. customers and transactions as ORC/Snappy tables, loans as ORC/Snappy
   partitioned by ``disbursement_year`` (one directory per year);
4. external catalog tables over those locations, loan partitions registered
   from the directory layout (``MSCK REPAIR TABLE``), transactions copied
   from its raw CSV table with CTAS.

All paths live under a caller-given root, normally a folder in the cluster's
shared storage (see ``riskloom.session.scratch_path``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schema as S
from riskloom.session import drop_scratch, scratch_path
from riskloom.sources import landing, warehouse
from riskloom.sources.tables import Domain, conform


def land(domain: Domain, root: str) -> dict[str, str]:
    """Write the three domain tables as landing CSV; returns the paths."""
    paths = {t: f"{root}/landing/{t}" for t in S.SCHEMAS}
    landing.write_landing(domain.customers, paths["customer_profiles"], "customer_profiles")
    landing.write_landing(domain.loans, paths["loan_applications"], "loan_applications")
    landing.write_landing(domain.txns, paths["transactions"], "transactions")
    return paths


def build_lake(spark: SparkSession, landing_paths: dict[str, str], root: str,
               database: str, buckets: int | None = None) -> Domain:
    """Typed landing reads -> columnar tables in ``database``; returns them.

    With ``buckets``, customers and loans are also hash-bucketed on
    customer_id (loans still partitioned by year) and transactions on
    loan_id, so the per-customer aggregations, the loan-customer joins and
    the per-loan AML aggregations run without shuffling these tables.

    Every load writes new files, then switches each table to them and deletes
    the files it replaces: loading again gives the new data in all tables.
    A row that cannot be read as declared stays, with NULL in the unreadable
    fields (as in a delimited-text table), and is copied with its raw line to
    the table's quarantine, ``<table>_rejected``; ``rejected`` counts those.
    """
    warehouse.create_database(spark, database, "Loan-portfolio risk tables", f"{root}/{database}.db")
    part, load = S.PARTITION_COLUMN, uuid.uuid4().hex[:12]
    place = lambda t: f"{root}/tables/{t}/load-{load}"
    replaced = [warehouse.location_of(spark, f"{database}.{t}{kind}") for t in S.SCHEMAS for kind in ("", "_rejected")]

    customers = landing.read_landing(spark, landing_paths["customer_profiles"], "customer_profiles")
    loans_csv = landing.read_landing(spark, landing_paths["loan_applications"], "loan_applications")
    cust_path, loan_path = place("customer_profiles"), place("loan_applications")
    if buckets:
        for t in ("customer_profiles", "loan_applications"):
            warehouse.drop_table(spark, f"{database}.{t}")
        warehouse.save_bucketed_table(customers, f"{database}.customer_profiles", cust_path,
                                      buckets, ["customer_id"])
        warehouse.save_bucketed_table(loans_csv, f"{database}.loan_applications", loan_path,
                                      buckets, ["customer_id"], partition_by=[part])
    else:
        warehouse.write_table_files(customers, cust_path)
        warehouse.register_table(spark, f"{database}.customer_profiles", cust_path,
                                 warehouse.schema_ddl("customer_profiles"))
        warehouse.write_table_files(loans_csv, loan_path, partition_by=[part])
        warehouse.register_table(spark, f"{database}.loan_applications", loan_path,
                                 warehouse.schema_ddl("loan_applications"), partition_by=[part])
        warehouse.recover_partitions(spark, f"{database}.loan_applications")

    # the raw landing table: header line skipped and checked against the schema
    warehouse.register_table(spark, f"{database}.transactions_raw", landing_paths["transactions"],
                             warehouse.schema_ddl("transactions"), fmt="csv",
                             options={"header": "true", "enforceSchema": "false"})
    warehouse.ctas(spark, f"{database}.transactions", f"{database}.transactions_raw",
                   place("transactions"), buckets=buckets, bucket_by=["loan_id"])

    for t in S.SCHEMAS:
        bad = landing.read_checked(spark, landing_paths[t], t).where(F.col(landing.RAW_LINE).isNotNull())
        warehouse.write_table_files(bad, place(f"{t}_rejected"))
        warehouse.register_table(spark, f"{database}.{t}_rejected", place(f"{t}_rejected"),
                                 warehouse.schema_ddl(t) + f", {landing.RAW_LINE} STRING")
    drop_scratch(spark, *[p for p in replaced if p])

    return Domain(
        customers=conform(spark.table(f"{database}.customer_profiles"), "customer_profiles"),
        loans=conform(spark.table(f"{database}.loan_applications"), "loan_applications"),
        txns=conform(spark.table(f"{database}.transactions"), "transactions"),
    )


def rejected(spark: SparkSession, database: str) -> dict[str, int]:
    """Rows in each table's quarantine."""
    return {t: spark.table(f"{database}.{t}_rejected").count() for t in S.SCHEMAS}


def ingested_tables(spark: SparkSession, domain: Domain) -> DataFrame:
    """The three tables through the whole ingestion (CSV landing, typed reads,
    partitioned ORC with partition repair, CTAS), read from the catalog: one row per
    ingested row with its id, state, year and main number."""
    root = scratch_path(spark, "lake")
    database = f"riskloom_{uuid.uuid4().hex[:12]}"
    lake = build_lake(spark, land(domain, root), root, database)
    row = lambda table, key, year, number: (
        F.lit(table).alias("table_name"), F.col(key).alias("row_id"), F.col("state"), F.col(year).alias("year"),
        F.col(number).cast("double").alias("number"))
    return (lake.customers.select(*row("customer_profiles", "customer_id", "onboarding_year", "credit_score"))
            .union(lake.loans.select(*row("loan_applications", "loan_id", "disbursement_year", "loan_amount")))
            .union(lake.txns.select(*row("transactions", "transaction_id", "transaction_year", "amount"))))


def report_through_csv(spark: SparkSession, report: DataFrame) -> DataFrame:
    """A report written by the CSV sink and read back with its own types."""
    path = scratch_path(spark, "report")
    warehouse.write_report_csv(report, path)
    return landing.read_csv(spark, path, report.schema, mode="FAILFAST")


def loan_lake_roundtrip(spark: SparkSession, domain: Domain, years: list[int] | None = None) -> DataFrame:
    """Loans through the whole landing path: CSV in file order -> typed read ->
    year-partitioned ORC/Snappy -> read back with partition discovery
    (and partition pruning when ``years`` is given)."""
    root = scratch_path(spark, "loan-lake")
    csv_path = f"{root}/landing/loan_applications"
    landing.write_landing(domain.loans, csv_path, "loan_applications")
    loans = landing.read_landing(spark, csv_path, "loan_applications", mode="FAILFAST")
    orc_path = f"{root}/tables/loan_applications"
    warehouse.write_table_files(loans, orc_path, partition_by=[S.PARTITION_COLUMN])
    back = spark.read.orc(orc_path)
    if years is not None:
        back = back.where(F.col(S.PARTITION_COLUMN).isin(years))
    return conform(back, "loan_applications")
