"""The AML channel and off-hours reports, maintained incrementally.

The batch reports recompute over the whole transaction table.  For a landing
folder that keeps receiving files, the same reports can run as Structured
Streaming queries: each micro-batch adds its rows to per-key running sums kept
in the state store (one row per channel / hour, so the state is bounded by
the vocabulary, not by the data), and the exact rates are derived from those
sums on output.  Results equal the batch report over all files seen so far.

State and progress live under ``checkpoint_location``, which must be in shared
storage on a cluster (by default a folder under ``spark.checkpoint.dir``), so
a restarted query resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions import avg_money, money_parts, off_hours_list, pct, sum_money
from riskloom.session import scratch_path
from riskloom.sources.tables import timed_transactions, transactions


def transaction_stream(spark: SparkSession, lineitem: str,
                       max_files_per_trigger: int | None = None,
                       schema: T.StructType | None = None, timed: bool = False) -> DataFrame:
    """Streaming source over lineitem-shaped parquet files (a folder of them, or
    one file), derived to the transactions table (``timed``: with ``txn_time``).  ``schema`` is needed when
    the folder is still empty; otherwise it is read from the files present."""
    if schema is None:
        schema = spark.read.parquet(lineitem).schema
    reader = spark.readStream.schema(schema)
    path = spark._jvm.org.apache.hadoop.fs.Path(lineitem)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        # a stream reads folders: take the file's, and that file alone
        reader = reader.option("pathGlobFilter", path.getName())
        lineitem = path.getParent().toString()
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (timed_transactions if timed else transactions)(reader.parquet(lineitem))


def channel_risk_running(txns: DataFrame) -> DataFrame:
    """Running per-channel totals and rates (stateful aggregation)."""
    exact, plain, odd = money_parts("amount")
    agg = txns.groupBy("channel").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("is_suspicious_flag").alias("suspicious_transactions"),
        exact.alias("_exact"), plain.alias("_plain"), odd.alias("_odd"),
        F.count("amount").alias("_n"),
    )
    return agg.select(
        "channel", "total_transactions", "suspicious_transactions",
        avg_money("_exact", "_plain", "_odd", "_n", 2).alias("avg_txn_amount"),
        pct("suspicious_transactions", "total_transactions", 2).alias("suspicion_rate_pct"),
    )


def off_hours_running(txns: DataFrame) -> DataFrame:
    """Running per-hour totals inside the off-hours window (stateful aggregation)."""
    agg = (txns.where(F.col("transaction_hour").isin(off_hours_list()))
           .groupBy("transaction_hour").agg(
               F.count(F.lit(1)).alias("txn_count"),
               sum_money("amount", 2).alias("total_amount"),
               F.sum("is_suspicious_flag").alias("suspicious_count")))
    return agg.select(
        "transaction_hour", "txn_count",
        "total_amount",
        "suspicious_count",
        pct("suspicious_count", "txn_count", 2).alias("suspicion_rate_pct"),
    )


def start(report: DataFrame, name: str, checkpoint_location: str | None = None,
          sink: str = "memory", available_now: bool = True,
          interval: str | None = None) -> StreamingQuery:
    """Start a running report.  ``complete`` output mode re-emits the (small,
    bounded) result table on every trigger.  ``available_now`` processes what
    has landed and stops; otherwise ``interval`` (e.g. "1 minute") sets a
    processing-time trigger for continuous monitoring."""
    spark = report.sparkSession
    location = checkpoint_location or scratch_path(spark, f"stream-{name}")
    writer = (report.writeStream.outputMode("complete").format(sink)
              .option("checkpointLocation", location))
    if sink == "memory":
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def run_available(report: DataFrame, name: str) -> DataFrame:
    """Run a running report over everything that has landed, wait for it,
    and return its result table (bounded: one row per key of the report)."""
    query_name = f"{name}_{uuid.uuid4().hex[:8]}"
    start(report, query_name).awaitTermination()
    return report.sparkSession.table(query_name)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_to_table(report: DataFrame, name: str, out: str | None = None, checkpoint_location: str | None = None) -> DataFrame:
    """Run an appending report over everything that has landed, with its state in RocksDB; return the
    table of all rows it has told so far.  Run again with the same ``out`` and
    ``checkpoint_location``, it goes on where it stopped."""
    spark = report.sparkSession
    out = out or scratch_path(spark, name)
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a query keeps the settings it was started with
    try:
        query = (report.writeStream.format("parquet").outputMode("append").option("path", out)
                 .option("checkpointLocation", checkpoint_location or scratch_path(spark, f"stream-{name}"))
                 .trigger(availableNow=True).start())
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)
    query.awaitTermination()
    return spark.read.schema(report.schema).parquet(out)
