"""Alarm for loans that draw cash and then do not pay, with state and timers.

A loan's watch opens with a cash withdrawal and closes with its next EMI payment.  A watch that is ``days`` days old
without a payment raises one alarm, which tells what was withdrawn meanwhile; nothing more is said about
the loan until it has paid.  Time is counted in slots of an hour: a payment settles all withdrawals of its own slot.

As a stream (``unpaid_withdrawals_running``), transactions are first added up per loan and slot.  Such a row comes
when the watermark has passed its slot, so a loan's rows come in time order whatever the order in which
transactions arrive, and a loan with a third of all transactions has one row per slot.  A loan has a
watch in the state only between a withdrawal and the next payment.  Loans are dealt out to buckets by their hash: a bucket's
watches are one state, and its timer stands at the first slot in which one of their payments is
due.  A transaction that comes after its slot was closed is left out.  Restarted from its checkpoint, the query goes on with
the watches that were open.

As a batch (``unpaid_withdrawals``), a loan's slots are gone through in one order, with running sums; alarms that
are not yet due by the latest time less ``delay`` are not told, as in the stream.

Null loans are one loan; transactions without a time count nowhere; an amount that is null adds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom import constants as K
from riskloom.session import shuffle_partitions

SLOT = timedelta(hours=1)
ALARM = "loan_id string, since timestamp, due timestamp, withdrawals long, total_amount double"
MONEY = "decimal(32,6)"


def _moves(txns: DataFrame) -> DataFrame:
    """Withdrawals and payments, with a time."""
    return txns.where(F.col("transaction_type").isin("Cash_Withdrawal", "EMI_Payment") & F.col("txn_time").isNotNull()).select(
        "loan_id", F.col("txn_time").cast("timestamp").alias("txn_time"), F.col("transaction_type") == "EMI_Payment", "amount"
    ).toDF("loan_id", "txn_time", "pays", "amount")


def _sums(moves: DataFrame, *keys) -> DataFrame:
    """Payments, withdrawals and their amount."""
    drawn = F.when(~F.col("pays"), F.col("amount").cast(MONEY))
    return moves.groupBy(*keys).agg(
        F.count_if("pays").alias("payments"), F.count_if(~F.col("pays")).alias("drawn"), F.coalesce(F.sum(drawn), F.lit(0).cast(MONEY)).alias("amount"))


def unpaid_withdrawals(txns: DataFrame, days: int = K.ALARM_DAYS, delay_days: int = K.ALARM_DELAY_DAYS,
                       task_rows: int = 1 << 20) -> DataFrame:
    """Every alarm of the table: loan_id, since (the slot of the first withdrawal), due, withdrawals, total_amount.
    Tasks have about ``task_rows`` transactions."""
    moves = _moves(txns)
    # the stream's watermark: the latest time in whole milliseconds, less the delay
    known = moves.agg(F.unix_micros(F.date_trunc("millisecond", F.max("txn_time"))).alias("latest"), F.count(F.lit(1)).alias("n")).first()
    parts, latest = max(shuffle_partitions(txns.sparkSession), -(-known.n // task_rows)), F.timestamp_micros(F.lit(known.latest).cast("long"))
    # narrow rows: a slot is the second at which it begins
    begins = F.unix_seconds(F.window("txn_time", "1 hour").start).alias("at")
    slots = _sums(moves.select("loan_id", begins, "pays", "amount"), "loan_id", "at").select(
        "loan_id", F.timestamp_seconds("at").alias("at"), F.col("payments") > 0, "drawn", "amount").toDF("loan_id", "at", "paid", "drawn", "amount")
    in_time = Window.partitionBy("loan_id").orderBy("at")
    upto = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one order serves both steps: sums from the loan's first slot on, then what they were when the watch opened
    told = slots.repartition(parts, "loan_id").select(
        "loan_id", "at", "paid", (~F.col("paid") & F.coalesce(F.lag("paid").over(in_time), F.lit(True))).alias("opens"), "drawn", "amount",
        F.sum(F.when(~F.col("paid"), F.col("drawn"))).over(upto).alias("all_drawn"),
        F.sum(F.when(~F.col("paid"), F.col("amount"))).over(upto).alias("all_amount"),
        F.lead("at").over(in_time).alias("next_at"), F.lead("paid").over(in_time).alias("next_paid"))
    opened = F.struct("at", (F.col("all_drawn") - F.col("drawn")).alias("drawn"), (F.col("all_amount") - F.col("amount")).alias("amount"))
    watched = told.withColumn("watch", F.last(F.when(F.col("opens"), opened), ignorenulls=True).over(upto)).select(
        "*", F.col("watch.at").alias("since")).withColumn("due", F.col("since") + F.expr(f"INTERVAL {days} DAY"))
    # the last slot in time, with no payment in time after it
    last = ~F.col("paid") & (F.col("at") <= F.col("due")) & (F.col("next_at").isNull() | (F.col("next_at") > F.col("due")))
    closed = F.col("due") + F.expr("INTERVAL 1 HOUR") <= latest - F.expr(f"INTERVAL {delay_days} DAY")
    return watched.where(last & closed).select(
        "loan_id", "since", "due", (F.col("all_drawn") - F.col("watch.drawn")).alias("withdrawals"),
        (F.col("all_amount") - F.col("watch.amount")).cast("double").alias("total_amount"))


class Watch(StatefulProcessor):
    """The watches of a bucket of loans: (loan, since, told, withdrawals, amount), times as UTC seconds.  Calls to the
    state store cost far more than rows, so a bucket has one state and one timer, at the first of its loans' dues."""

    def __init__(self, days: int) -> None:
        self.wait = int(timedelta(days=days).total_seconds())
        self.slot = int(SLOT.total_seconds())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.watches = handle.getValueState(
            "watches", f"watches array<struct<loan_id string, since long, told boolean, withdrawals long, amount {MONEY}>>")

    def _alarm(self, loan: str | None, since: int, withdrawals: int, amount) -> Row:
        at = lambda s: datetime.fromtimestamp(s, timezone.utc)
        return Row(loan_id=loan, since=at(since), due=at(since + self.wait), withdrawals=withdrawals, total_amount=float(amount))

    def _closes(self, since: int) -> int:
        """The millisecond from which on no payment in time can come any more."""
        return (since + self.wait + self.slot) * 1000

    def _held(self) -> dict:
        held = self.watches.get()
        return {w[0]: tuple(w)[1:] for w in held[0]} if held else {}

    def _timer(self, watches: dict) -> int | None:
        """When the first watch that has not told closes."""
        return min((self._closes(w[0]) for w in watches.values() if not w[1]), default=None)

    def _tell(self, watches: dict, watermark: int) -> Iterator[Row]:
        """Alarms of the watches that have closed."""
        for loan, (since, told, withdrawals, amount) in list(watches.items()):
            if not told and self._closes(since) <= watermark:
                yield self._alarm(loan, since, withdrawals, amount)
                watches[loan] = (since, True, withdrawals, amount)

    def _keep(self, held: dict, watches: dict) -> None:
        if watches and watches != held:
            self.watches.update(([(loan, *w) for loan, w in watches.items()],))
        elif held and not watches:
            self.watches.clear()

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self._held()
        watches = dict(held)
        for r in sorted(rows, key=lambda r: r["at"]):
            loan, at = r["loan_id"], r["at"]
            now = watches.get(loan)
            if now and not now[1] and at > now[0] + self.wait:
                yield self._alarm(loan, now[0], now[2], now[3])
                now = watches[loan] = (now[0], True, now[2], now[3])
            if r["payments"]:
                watches.pop(loan, None)
            elif now is None:
                watches[loan] = (at, False, r["drawn"], r["amount"])
            elif not now[1]:
                watches[loan] = (now[0], False, now[2] + r["drawn"], now[3] + r["amount"])
        yield from self._tell(watches, timerValues.getCurrentWatermarkInMs())
        was, waits = self._timer(held), self._timer(watches)
        if was != waits:
            if was is not None:
                self.handle.deleteTimer(was)
            if waits is not None:
                self.handle.registerTimer(waits)
        self._keep(held, watches)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held()
        watches = dict(held)
        yield from self._tell(watches, max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()))
        waits = self._timer(watches)
        if waits is not None:
            self.handle.registerTimer(waits)
        self._keep(held, watches)

    def close(self) -> None:
        pass


def unpaid_withdrawals_running(txns: DataFrame, days: int = K.ALARM_DAYS, delay_days: int = K.ALARM_DELAY_DAYS,
                               buckets: int = 1 << 16) -> DataFrame:
    """``unpaid_withdrawals`` of a stream: an alarm comes out once, when the watermark has passed the slot in
    which the payment was due.  Loans share states by ``buckets`` of their hash; a checkpoint goes on with the number it was begun with.
    Needs the RocksDB state store (``aml_monitor.run_to_table`` sets it)."""
    slots = _sums(_moves(txns).withWatermark("txn_time", f"{delay_days} days"), "loan_id", F.window("txn_time", "1 hour").alias("w"))
    rows = slots.select(F.pmod(F.xxhash64("loan_id"), F.lit(buckets)).alias("bucket"), "loan_id", F.window_time("w").alias("ends"),
                        F.unix_seconds("w.start").alias("at"), "payments", "drawn", "amount")
    return rows.groupBy("bucket").transformWithState(Watch(days), ALARM, "append", "eventTime")
