"""Domain tables derived from the driver's parquet tables.

The loan-risk reports run over three tables (customer_profiles,
loan_applications, transactions).  In this repository they are *derived*
from the TPC-H style tables under an ``sf_dir`` with pure column
expressions (FIXTURES.md section 3):

    customer_profiles := customer JOIN nation
    loan_applications := orders
    transactions      := lineitem

Each derivation is a narrow projection that Catalyst fuses into the parquet
scan (column pruning and filter pushdown pass straight through it).  Only the
customer derivation has a join; ``nation`` is a fixed 25-row dimension, and the
planner broadcasts it through ``spark.sql.autoBroadcastJoinThreshold`` (a
size check on the relation) rather than through a hint.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schema as S

# Declared schemas of the source tables: reading with them needs no job over the file footers.
SOURCES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SOURCES[name]) if name in SOURCES else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def padded_id(prefix: str, key: Column, width: int) -> Column:
    """prefix + key zero-padded to ``width`` digits; longer keys are kept whole
    (a plain LPAD would truncate them and make distinct keys collide)."""
    s = key.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0")))


def _case_lt(x: Column, arms: list[tuple[int, str]], other: str) -> Column:
    expr = None
    for bound, label in arms:
        expr = F.when(x < bound, F.lit(label)) if expr is None else expr.when(x < bound, F.lit(label))
    return expr.otherwise(F.lit(other))


def _case_eq(x: Column, values: list, other) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(x == i, F.lit(v)) if expr is None else expr.when(x == i, F.lit(v))
    return expr.otherwise(F.lit(other))


def customer_profiles(customer: DataFrame, nation: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    emp = (k * 37) % 100
    return (
        customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "inner")
        .select(
            padded_id("CUST", k, 6).alias("customer_id"),
            (22 + (k * 7) % 43).cast("int").alias("age"),
            F.col("n_name").alias("state"),
            _case_lt(emp, [(50, "Salaried"), (70, "Self-Employed"), (85, "Business Owner"),
                           (93, "Freelancer")], "Government").alias("employment_type"),
            F.col("c_mktsegment").alias("segment"),
            (15000 + (k * 7919) % 235000).cast("bigint").alias("monthly_income"),
            (480 + F.floor((F.col("c_acctbal") + 1000) * 400 / 11000)).cast("int").alias("credit_score"),
            ((k * 13) % 20).cast("int").alias("years_with_bank"),
            ((k * 11) % 5).cast("int").alias("existing_loans"),
            (2005 + (k * 17) % 19).cast("int").alias("onboarding_year"),
        )
    )


def loan_applications(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    status_draw = (k * 7919) % 997
    dpd_draw = (k * 104729) % 991
    dpd = (F.when(status_draw >= 550, F.lit(0))
           .when(dpd_draw < 694, F.lit(0))
           .when(dpd_draw < 793, F.lit(30))
           .when(dpd_draw < 872, F.lit(60))
           .when(dpd_draw < 931, F.lit(90))
           .when(dpd_draw < 961, F.lit(120))
           .when(dpd_draw < 981, F.lit(180))
           .otherwise(F.lit(240)))
    return orders.select(
        padded_id("LN", k, 7).alias("loan_id"),
        padded_id("CUST", F.col("o_custkey"), 6).alias("customer_id"),
        _case_lt((k * 41) % 100, [(30, "Personal"), (55, "Home"), (70, "Vehicle"),
                                  (85, "Business"), (95, "Education")], "Credit Card").alias("loan_type"),
        F.floor(F.col("o_totalprice") * 10).cast("bigint").alias("loan_amount"),
        _case_eq(k % 9, [12, 24, 36, 48, 60, 84, 120, 180], 240).cast("int").alias("loan_tenure_months"),
        ((750 + (k * 29) % 1651).cast("double") / F.lit(100).cast("double")).alias("interest_rate"),
        _case_lt(status_draw, [(550, "Active"), (750, "Closed"), (870, "Default"),
                               (920, "NPA"), (945, "Written-Off")], "Restructured").alias("loan_status"),
        F.year("o_orderdate").cast("int").alias("disbursement_year"),
        F.month("o_orderdate").cast("int").alias("disbursement_month"),
        (F.floor(F.col("o_totalprice") * 1000).cast("double")
         / (100 * (12 + (k * 31) % 229)).cast("double")).alias("emi_amount"),
        dpd.cast("int").alias("dpd_days"),
        F.concat(F.lit("NATION_"), ((k * 23) % 25).cast("string")).alias("state"),
        F.concat(F.lit("BR"), F.lpad((1 + (k * 19) % 499).cast("string"), 4, "0")).alias("branch_code"),
    )


def transactions(lineitem: DataFrame, *more: Column) -> DataFrame:
    """The transactions table; ``more`` are columns of lineitem to carry along."""
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    ttype = (part * 31 + supp * 7) % 100
    return lineitem.select(
        F.concat(F.lit("TXN"), F.col("l_orderkey").cast("string"), F.lit("-"), line.cast("string"),
                 F.lit("-"), part.cast("string")).alias("transaction_id"),
        padded_id("LN", F.col("l_orderkey"), 7).alias("loan_id"),
        _case_lt(ttype, [(40, "Cash_Withdrawal"), (65, "EMI_Payment"), (80, "UPI_Transfer"),
                         (87, "NEFT"), (91, "Card_Payment"), (94, "RTGS"),
                         (96, "Loan_Disbursement"), (98, "Interest_Credit")], "Reversal")
        .alias("transaction_type"),
        (F.col("l_extendedprice") * 5).alias("amount"),
        _case_eq(supp % 6, ["Mobile_App", "Net_Banking", "ATM", "Branch", "POS"], "UPI").alias("channel"),
        F.year("l_shipdate").cast("int").alias("transaction_year"),
        F.month("l_shipdate").cast("int").alias("transaction_month"),
        ((part * line + supp) % 24).cast("int").alias("transaction_hour"),
        F.when((F.col("l_extendedprice") > 40000) & (F.col("l_discount") >= 0.05), F.lit(1))
        .otherwise(F.lit(0)).alias("is_suspicious_flag"),
        F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)).alias("reversal_flag"),
        F.concat(F.lit("NATION_"), ((supp * 23) % 25).cast("string")).alias("state"),
        *more,
    )


def timed_transactions(lineitem: DataFrame) -> DataFrame:
    """transactions with ``txn_time``: the hour of the day they ran."""
    day = transactions(lineitem, F.col("l_shipdate").alias("txn_time"))
    return day.withColumn("txn_time", F.timestamp_add("HOUR", F.col("transaction_hour"), F.col("txn_time")))


class Domain:
    """The three report inputs as lazily derived DataFrames.  Each is a frame or a
    function that makes one, called when a report first asks for it."""

    def __init__(self, customers, loans, txns):
        self._made = {"customers": customers, "loans": loans, "txns": txns}

    def _frame(self, name: str) -> DataFrame:
        made = self._made[name]
        return made if isinstance(made, DataFrame) else made()

    @cached_property
    def customers(self) -> DataFrame:
        return self._frame("customers")

    @cached_property
    def loans(self) -> DataFrame:
        return self._frame("loans")

    @cached_property
    def txns(self) -> DataFrame:
        return self._frame("txns")


def load_domain(spark: SparkSession, sf_dir: str) -> Domain:
    """Derive the three domain tables from the driver tables in ``sf_dir``: lazy plans; a
    table's files are listed when a report asks for it, anew for each domain."""
    table = lambda name: read_table(spark, sf_dir, name)
    return Domain(
        customers=lambda: customer_profiles(table("customer"), table("nation")),
        loans=lambda: loan_applications(table("orders")),
        txns=lambda: transactions(table("lineitem")),
    )


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` onto the declared schema of a domain table (names, order, types)."""
    schema = S.SCHEMAS[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema])
