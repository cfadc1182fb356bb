"""Changes merged into the year-partitioned loan table.

Only the partitions that a change touches are rewritten, into a new folder; each is then switched to
its new files in the catalog.  A lost executor repeats its tasks into the new folder, a
merge that dies before the switch leaves the table as it was, and merging the same changes again
gives the same table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schema as S
from riskloom.operators.snapshots import multiset_difference
from riskloom.plans.portfolio_levels import earlier_load
from riskloom.session import materialize, scratch_path
from riskloom.sources import warehouse
from riskloom.sources.tables import conform

PART = S.PARTITION_COLUMN


def create_loan_table(spark: SparkSession, loans: DataFrame, name: str, root: str) -> None:
    """``loans`` as the year-partitioned external table ``name`` under ``root``."""
    path = f"{root}/loan_applications/load-{uuid.uuid4().hex[:12]}"
    warehouse.write_table_files(loans, path, partition_by=[PART])
    warehouse.register_table(spark, name, path, warehouse.schema_ddl("loan_applications"), partition_by=[PART])
    warehouse.recover_partitions(spark, name)


def merge_loans(spark: SparkSession, name: str, root: str, upserts: DataFrame, deleted: DataFrame | None = None) -> list[int | None]:
    """Put the rows of ``upserts`` in place of those with their loan_id, wherever these stand, and remove the loans
    of ``deleted`` (loan_id); returns the rewritten years.

    Rows of ``upserts`` that repeat a loan_id all enter; a loan in both is replaced; null loan ids of
    ``upserts`` are added and replace nothing; null ids in ``deleted`` remove nothing.
    """
    table = conform(spark.table(name), "loan_applications")
    upserts = materialize(conform(upserts, "loan_applications"), "merge-upserts")
    gone = upserts.select("loan_id") if deleted is None else upserts.select("loan_id").union(deleted.select("loan_id"))
    gone = materialize(gone.where("loan_id IS NOT NULL").distinct(), "merge-keys")
    # years: as many as the table has partitions
    stand = table.join(gone, "loan_id", "left_semi").select(PART)
    years = [r[0] for r in stand.union(upserts.select(PART)).distinct().orderBy(PART).collect()]
    if not years:
        return []
    touched = F.lit(False)
    for y in years:
        touched = touched | F.col(PART).eqNullSafe(F.lit(y))
    kept = table.where(touched).join(gone, "loan_id", "left_anti").select(*table.columns)
    path = f"{root}/loan_applications/merge-{uuid.uuid4().hex[:12]}"
    warehouse.write_table_files(kept.unionByName(upserts), path, partition_by=[PART])
    left = {r[0] for r in spark.read.schema(S.SCHEMAS["loan_applications"]).orc(path).select(PART).distinct().collect()}
    for y in years:
        spec = f"PARTITION ({PART} = {'NULL' if y is None else y})"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec}")
        if y in left:
            folder = "__HIVE_DEFAULT_PARTITION__" if y is None else y
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{path}/{PART}={folder}'")
        else:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")
    spark.catalog.refreshTable(name)
    return years


def merged_loans(spark: SparkSession, loans: DataFrame) -> DataFrame:
    """An earlier load of the portfolio, brought up to date by merging the rows that differ."""
    root, database = scratch_path(spark, "merge"), f"riskloom_{uuid.uuid4().hex[:12]}"
    warehouse.create_database(spark, database, "Loans under merge", f"{root}/{database}.db")
    old, name = earlier_load(loans), f"{database}.loan_applications"
    create_loan_table(spark, conform(old, "loan_applications"), name, root)
    diff = materialize(multiset_difference(old, loans), "merge-difference")
    merge_loans(spark, name, root, diff.where("copies > 0").drop("copies"), diff.where("copies < 0").select("loan_id"))
    return conform(spark.table(name), "loan_applications")
