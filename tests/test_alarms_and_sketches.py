"""The unpaid-withdrawal alarm, batch and stream, against a walk over the rows; kept sketches against exact figures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskloom.plans import portfolio_sketches as ps
from riskloom.sources.tables import load_domain
from riskloom.streaming import aml_monitor, loan_alarm
from tests.conftest import SF01, SF001

DAY0 = dt.datetime(2020, 1, 1)
SCHEMA = "loan_id string, transaction_type string, txn_time timestamp, amount double, state int"


def moves(n=600, seed=5):
    """(loan, type, minutes, amount): loan A has most rows; times and rows repeat, loans, times and amounts may be null."""
    rng = random.Random(seed)
    rows = [(rng.choice(["A", "A", "A", "A", "B", "C", None]), rng.choice(["Cash_Withdrawal", "Cash_Withdrawal", "EMI_Payment", "NEFT"]),
             rng.choice([None] + [rng.randint(0, 400) * 30 * 24] * 15), rng.choice([None, 10.5, 7.25])) for _ in range(n)]
    rows += [(f"L{i}", "Cash_Withdrawal", i * 700, 1.0) for i in range(60)]  # never pay
    return rows + rows[:9]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, None if m is None else DAY0 + dt.timedelta(minutes=m), a, 1) for k, t, m, a in rows], SCHEMA)


def walk(rows, days, delay):
    """Alarms by going through each loan's slots."""
    known = [(k, t, m, a) for k, t, m, a in rows if m is not None and t in ("Cash_Withdrawal", "EMI_Payment")]
    final = max((m for _, _, m, _ in known), default=0) - delay * 1440
    out = []
    for loan in {k for k, *_ in known}:
        slots = {}
        for _, t, m, a in (r for r in known if r[0] == loan):
            slots.setdefault(m // 60, []).append((t, a or 0))
        watch = None
        for s in [*sorted(slots), 10 ** 9]:
            if watch and not watch[3] and s > watch[0] + days * 24:
                watch[3] = True
                if (watch[0] + days * 24 + 1) * 60 <= final:
                    out.append((loan, watch[0], watch[1], watch[2]))
            here = slots.get(s, [])
            if any(t == "EMI_Payment" for t, _ in here):
                watch = None
            elif here and watch is None:
                watch = [s, len(here), sum(a for _, a in here), False]
            elif here and not watch[3]:
                watch[1] += len(here)
                watch[2] += sum(a for _, a in here)
    return sorted(out, key=str)


def told(df):
    hours = F.floor((F.unix_seconds("since") - int(DAY0.replace(tzinfo=dt.timezone.utc).timestamp())) / 3600).alias("h")
    rows = df.select("loan_id", hours, "withdrawals", "total_amount", (F.unix_seconds("due") - F.unix_seconds("since")).alias("wait")).collect()
    return sorted([tuple(r)[:4] for r in rows], key=str), {r.wait for r in rows}


@pytest.mark.parametrize("days, delay", [(3, 2), (10, 0), (1, 30), (90, 2)])
def test_batch_against_walking(spark, days, delay):
    rows = moves()
    got, waits = told(loan_alarm.unpaid_withdrawals(frame(spark, rows), days, delay))
    assert got == walk(rows, days, delay)
    assert waits <= {days * 86400}


def test_batch_tasks_follow_the_rows_and_sort_once(spark):
    rows = moves()
    df = loan_alarm.unpaid_withdrawals(frame(spark, rows), 10, 0, task_rows=10)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    n = sum(r[2] is not None and r[1] != "NEFT" for r in rows)
    assert f", {-(-n // 10)}), REPARTITION_BY_NUM" in plan
    final = df._jdf.queryExecution().executedPlan().toString()
    assert final.count("Sort [") == 1 and final.count("HashAggregate(") == 2  # the slots' sums alone
    assert told(df)[0] == walk(rows, 10, 0)


def test_empty_and_paid(spark):
    assert loan_alarm.unpaid_withdrawals(frame(spark, [])).collect() == []
    rows = [("A", "Cash_Withdrawal", 0, 1.0), ("A", "EMI_Payment", 59, 1.0), ("B", "EMI_Payment", 1, 1.0), ("C", "NEFT", 999_999, 1.0)]
    assert loan_alarm.unpaid_withdrawals(frame(spark, rows), 0, 0).collect() == []


def _land(spark, rows, folder):
    frame(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def _run(spark, tmp_path, days, delay):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "land"))
    running = loan_alarm.unpaid_withdrawals_running(stream, days, delay)
    return told(aml_monitor.run_to_table(running, "alarm", str(tmp_path / "out"), str(tmp_path / "ckpt")))[0]


def test_stream_over_restarts_gives_the_batch(spark, tmp_path):
    """Rows land in three runs, in time order but for a delay's worth of disorder; each run starts from the checkpoint."""
    rows, days, delay = moves(), 20, 5
    at = lambda r: r[2] if r[2] is not None else 0
    rng = random.Random(1)
    shuffled = sorted(rows, key=lambda r: at(r) + rng.randint(0, delay * 1440 - 61))
    seen = []
    for i in range(0, len(shuffled), 250):
        _land(spark, shuffled[i:i + 250], str(tmp_path / "land"))
        got = _run(spark, tmp_path, days, delay)
        seen.append(len(got))
        assert got == walk(shuffled[:i + 250], days, delay)
    assert 0 < seen[0] < seen[-1] and spark.conf.get(aml_monitor.STATE_STORE) != aml_monitor.ROCKSDB


def test_a_timer_alone_raises_the_alarm_and_late_rows_do_not_count(spark, tmp_path):
    land = str(tmp_path / "land")
    _land(spark, [("A", "Cash_Withdrawal", 0, 5.0), ("B", "Cash_Withdrawal", 0, 6.0)], land)
    assert _run(spark, tmp_path, 10, 1) == []
    _land(spark, [("Z", "EMI_Payment", 5 * 1440, 1.0), ("B", "EMI_Payment", 5 * 1440, 1.0)], land)
    assert _run(spark, tmp_path, 10, 1) == []  # B has paid
    _land(spark, [("Z", "EMI_Payment", 30 * 1440, 1.0)], land)
    assert _run(spark, tmp_path, 10, 1) == [("A", 0, 1, 5.0)]  # no row of A came
    _land(spark, [("A", "EMI_Payment", 60, 1.0), ("A", "Cash_Withdrawal", 90, 1.0), ("Z", "EMI_Payment", 90 * 1440, 1.0)], land)
    assert _run(spark, tmp_path, 10, 1) == [("A", 0, 1, 5.0)]  # late, and told once


@pytest.mark.parametrize("buckets", [1, 7])
def test_loans_that_share_a_state(spark, tmp_path, buckets):
    """The alarms of the batch, over restarts, with many loans in a state and one timer for them."""
    rows, days, delay = moves(400, 8), 20, 5
    rows.sort(key=lambda r: r[2] if r[2] is not None else 0)
    for i in range(0, len(rows), 160):
        _land(spark, rows[i:i + 160], str(tmp_path / "land"))
        running = loan_alarm.unpaid_withdrawals_running(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "land")), days, delay, buckets)
        got = aml_monitor.run_to_table(running, "alarm", str(tmp_path / "out"), str(tmp_path / "ckpt"))
        assert told(got)[0] == walk(rows[:i + 160], days, delay)


def test_a_state_serves_many_loans(spark):
    """State calls of a bucket: one to read, one to write, one timer, whatever its number of loans."""
    calls = []

    class Store:
        def get(self):
            calls.append("get")

        def update(self, value):
            calls.append(len(value[0]))

    class Handle:
        def getValueState(self, *_):
            return Store()

        def registerTimer(self, at):
            calls.append(("timer", at))

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0

    watch = loan_alarm.Watch(1)
    watch.init(Handle())
    rows = [dict(loan_id=f"L{i}", at=3600 * (i + 1), payments=0, drawn=1, amount=1) for i in range(100)]
    told_now = list(watch.handleInputRows((0,), iter(rows), Times()))
    assert told_now == [] and calls == ["get", ("timer", (3600 + 86400 + 3600) * 1000), 100]


def test_sketches_merge_to_what_the_whole_gives(spark, tmp_path):
    loans = load_domain(spark, SF01).loans.cache()
    kept = ps.keep(loans, str(tmp_path / "kept"))
    n = loans.count()
    by_state, whole = ps.estimates(ps.merge(ps.merge(kept, ["state"]))).first(), ps.estimates(ps.merge(kept)).first()
    exact = loans.select("customer_id").distinct().count()
    for got in (by_state, whole):
        assert got.loans == n and abs(got.borrowers - exact) <= 4 * ps.HLL_ERROR * exact
        for p in (50, 95):
            below, upto = (loans.where(f"loan_amount {op} {got[f'p{p}_amount']}").count() / n for op in ("<", "<="))
            assert below - 3 * ps.KLL_ERROR <= p / 100 <= upto + 3 * ps.KLL_ERROR


def test_only_the_loaded_years_are_replaced(spark, tmp_path):
    loans, path = load_domain(spark, SF001).loans, str(tmp_path / "kept")
    ps.keep(loans, path)
    year = loans.agg(F.max("disbursement_year")).first()[0]
    for _ in range(2):  # repeated, it is the same
        ps.keep(loans.where(F.col("disbursement_year") == year).limit(10), path)
    got = {r.disbursement_year: r.loans for r in ps.merge(spark.read.parquet(path), ["disbursement_year"]).collect()}
    want = {r.disbursement_year: r["count"] for r in loans.groupBy("disbursement_year").count().collect()}
    assert got == want | {year: 10}


def test_sketches_of_odd_rows(spark, tmp_path):
    schema = "customer_id string, loan_amount long, disbursement_year int, state string"
    rows = [("a", 5, 2020, None), ("a", 5, 2020, None), (None, None, 2020, "x"), (None, None, 2021, "x"), ("b", 1, None, "x")]
    loans = spark.createDataFrame(rows, schema)
    kept = ps.keep(loans, str(tmp_path / "kept"))
    got = {r.disbursement_year: tuple(r)[1:] for r in ps.estimates(ps.merge(kept, ["disbursement_year"])).collect()}
    assert got == {2020: (3, 1, 5, 5), 2021: (1, 0, None, None), None: (1, 1, 1, 1)}
    assert {r.disbursement_year: tuple(r)[3:] for r in ps.sketch_audit(loans, kept).collect()} == {y: (True,) * 4 for y in (2020, 2021, None)}
    assert ps.keep(spark.createDataFrame([], schema), str(tmp_path / "none")).collect() == []


def test_sketch_merging_reads_no_loans(spark, tmp_path):
    kept = ps.keep(load_domain(spark, SF001).loans, str(tmp_path / "kept"))
    plan = ps.estimates(ps.merge(kept.where("disbursement_year >= 1995"), ["state"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(disbursement_year" in plan and "customer_id" not in plan
    assert plan.count("ObjectHashAggregate") == 2  # partial and final
